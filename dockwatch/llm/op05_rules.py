"""Quality rules as a short-circuit cascade.

Each rule is a named reason to reject and reads some metrics of the text. On a bounded sample the cost of every rule
(work of the metrics it needs that no earlier rule has computed) and its rejections are estimated; the cascade then
greedily runs the rule with most rejections per cost first, and a later rule sees only texts that passed the earlier ones:
metrics are computed on the texts still alive, gathered into one array.
The order changes the work, never the verdict. Work is counted, not timed, so the same sample gives the same order on any machine.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwatch.llm.common import hashed_sample, lean, repeat_rows, utf8_array
from dockwatch.llm.textscan import slices, span_hashes, windows, words
from dockwatch.llm.tokens import ragged

#: Rows whose metrics order the rules; of each only the metrics leave its task, whatever its length.
SAMPLE_ROWS = 512
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
LETTERS_UP = np.zeros(256, bool)
LETTERS_UP[0x41:0x5B] = True
LETTERS_LOW = np.zeros(256, bool)
LETTERS_LOW[0x61:0x7B] = True
_HAS_WORD = re.compile(rb"[^\x20\x09-\x0D]")


class Texts:
    """Metrics of some texts, computed when first asked for, for the rows then alive, and kept."""

    def __init__(self, data, offsets):
        self.data, self.offsets = data, offsets
        self.rows = len(offsets) - 1
        self._made, self._spans, self._part = {}, None, (None, None)

    def texts(self, at):
        return self.data[self.offsets[at]:self.offsets[at + 1]]

    def spans(self):
        if self._spans is None:
            self._spans = words(self.data, self.offsets)
        return self._spans

    def only(self, rows):
        """These rows as texts of their own; their words are taken over if they are known."""
        if self._part[0] is None or not np.array_equal(self._part[0], rows):
            size = np.diff(self.offsets)[rows]
            part = Texts(self.data[ragged(self.offsets[rows], size)], np.concatenate([[0], np.cumsum(size)]))
            if self._spans is not None:
                starts, ends, first = self._spans
                n = np.diff(first)[rows]
                at, moved = ragged(first[rows], n), np.repeat(part.offsets[:-1] - self.offsets[rows], n)
                part._spans = starts[at] + moved, ends[at] + moved, np.concatenate([[0], np.cumsum(n)])
            self._part = rows, part
        return self._part[1]

    def metric(self, name, alive):
        values, known = self._made.setdefault(name, (np.zeros(self.rows, np.int64), np.zeros(self.rows, bool)))
        todo = np.flatnonzero(alive & ~known)
        if len(todo):
            values[todo] = METRICS[name](self if len(todo) == self.rows else self.only(todo))
            known[todo] = True
        return values


def _count(mask, offsets):
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return np.diff(total[offsets])


def _n_words(t):
    return np.diff(t.spans()[2])


def _word_chars(t):
    spaces = (t.data == 0x20) | ((t.data >= 0x09) & (t.data <= 0x0D))
    return _count(((t.data & 0xC0) != 0x80) & ~spaces, t.offsets)


def _n_symbols(t):
    return _count(SYMBOLS[t.data], t.offsets)


def _n_upper(t):
    return _count(LETTERS_UP[t.data], t.offsets)


def _n_lower(t):
    return _count(LETTERS_LOW[t.data], t.offsets)


def _n_lines(t):
    return np.array([sum(1 for line in t.texts(i).tobytes().split(b"\n") if _HAS_WORD.search(line)) for i in range(t.rows)], np.int64)


def _n_dup_lines(t):
    out = np.zeros(t.rows, np.int64)
    for i in range(t.rows):
        lines = t.texts(i).tobytes().split(b"\n")
        if len(lines) > 1:
            lines = [line for line in lines if _HAS_WORD.search(line)]
            out[i] = len(lines) - len(set(lines))
    return out


def _n_repeat_words(t):
    out = np.zeros(t.rows, np.int64)
    starts, ends, first = t.spans()
    for i in range(t.rows):
        a, b = first[i], first[i + 1]
        if b - a < 4:  # two windows of three words need four words
            continue
        seen = windows(span_hashes(t.data, starts[a:b], ends[a:b]), 3)
        order = np.argsort(seen)
        same = seen[order][1:] == seen[order][:-1]
        twice = np.zeros(len(seen), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        marked = np.zeros(b - a, bool)
        for j in range(3):
            marked[j:j + len(twice)] |= twice
        out[i] = marked.sum()
    return out


METRICS = {"n_words": _n_words, "word_chars": _word_chars, "n_symbols": _n_symbols, "n_upper": _n_upper, "n_lower": _n_lower,
           "n_lines": _n_lines, "n_dup_lines": _n_dup_lines, "n_repeat_words": _n_repeat_words}
#: Work of a metric per text and per byte, in nanoseconds as measured once; what counts is their proportion.
WORK = {"n_words": (200, 9), "word_chars": (50, 5), "n_symbols": (50, 4), "n_upper": (50, 4), "n_lower": (50, 4), "n_lines": (1500, 2),
        "n_dup_lines": (1500, 2), "n_repeat_words": (20_000, 25)}

#: name -> (metrics, rejects(metrics of the living rows)); whole numbers only, so that any engine agrees.
BASE_RULES = {
    "few_words": (("n_words",), lambda n: n < 50),
    "repeated_windows": (("n_repeat_words", "n_words"), lambda r, n: 100 * r > 50 * n),
}
RULES = {
    **BASE_RULES,
    "symbols": (("n_symbols", "n_words"), lambda s, n: 100 * s > 20 * n),
    "repeated_lines": (("n_dup_lines", "n_lines"), lambda d, n: 100 * d > 40 * n),
    "shouting": (("n_upper", "n_lower"), lambda u, w: (u + w >= 20) & (100 * u > 60 * (u + w))),
    "word_length": (("word_chars", "n_words"), lambda c, n: (c < 2 * n) | (c > 20 * n)),
}


def run_cascade(texts, rules, order, alive=None):
    """Index in ``order`` of the first rule that rejects each row, -1 where none does."""
    verdict = np.full(texts.rows, -1, np.int64)
    alive = np.ones(texts.rows, bool) if alive is None else alive.copy()
    for k, name in enumerate(order):
        if not alive.any():
            break
        needs, rejects = rules[name]
        at = np.flatnonzero(alive)
        bad = at[rejects(*(texts.metric(m, alive)[at] for m in needs))]
        verdict[bad] = k
        alive[bad] = False
    return verdict


def order_rules(sizes, metrics, rules) -> list[str]:
    """Greedy order: at each step the rule with most rejections per work among the rows still alive.

    ``sizes``: bytes of the sampled texts; ``metrics``: name -> values of all of them. Ties go to the rule named first.
    """
    left, order, made = dict(rules), [], set()
    alive = np.ones(len(sizes), bool)
    while left:
        best = None
        for name, (needs, rejects) in left.items():
            at = np.flatnonzero(alive)
            bad = at[rejects(*(metrics[m][at] for m in needs))] if len(at) else at
            # what earlier rules computed costs nothing more
            work = sum(per_text * len(at) + per_byte * int(sizes[at].sum()) for per_text, per_byte in (WORK.get(m, (1000, 10)) for m in needs if m not in made))
            rate = len(bad) / (work + 1)
            if best is None or rate > best[0]:
                best = (rate, name, bad)
        _, name, bad = best
        order.append(name)
        made.update(left.pop(name)[0])
        alive[bad] = False
    return order


def plan_order(df: DataFrame, id_col, text_col, rules, sample_rows=SAMPLE_ROWS) -> list[str]:
    """The order of the rules, from the metrics of at most ``sample_rows`` rows; their texts stay in the tasks."""
    names = sorted({m for needs, _ in rules.values() for m in needs})
    shown = ("size", *names)

    def run(batches):
        for batch in batches:
            data, offsets = utf8_array(batch.column(1))
            for a, b in slices(offsets):
                texts = Texts(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                values = [pa.array(texts.metric(m, np.ones(b - a, bool))) for m in names]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(offsets[a:b + 1])), *values], ["id", *shown])

    given = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("t"))
    ids = hashed_sample(given.select("id").where("id is not null").distinct(), "id", sample_rows)
    rows = given.join(F.broadcast(ids), "id").mapInArrow(lean(run), "id string, " + ", ".join(f"{c} long" for c in shown))
    one = rows.groupBy("id").agg(F.min(F.struct(*shown)).alias("m")).select("m.*").toArrow()  # of a repeated id one text counts
    columns = {c: one[c].to_numpy() for c in shown}
    return order_rules(columns["size"], columns, rules)


def quality_rules(df: DataFrame, id_col="doc_id", text_col="text", rules=None, report=(), order=None) -> DataFrame:
    """Judge every whole text: ``id_col``, the ``report`` metrics, ``kept`` and ``rule`` (the rule that rejected, else null).

    Metrics in ``report`` are computed for all rows, others only as far as the cascade needs them. A null text has no
    words and is judged as an empty one; a null id stays null; repeated rows are judged each; other columns are ignored;
    an empty table gives an empty result.
    """
    rules = dict(RULES if rules is None else rules)
    order = plan_order(df, id_col, text_col, rules) if order is None else list(order)
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, " + "".join(f"{m} bigint, " for m in report) + "kept boolean, rule string"

    def judge(batches):
        for batch in batches:
            data, offsets = utf8_array(batch.column(1))
            for a, b in slices(offsets):
                texts = Texts(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                everyone = np.ones(texts.rows, bool)
                shown = [pa.array(texts.metric(m, everyone)) for m in report]
                verdict = run_cascade(texts, rules, order)
                names = pa.array([None if v < 0 else order[v] for v in verdict], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *shown, pa.array(verdict < 0), names],
                    [id_col, *report, "kept", "rule"])

    return df.select(id_col, F.col(text_col).cast("string").alias(text_col)).mapInArrow(lean(judge), schema)


def keep_passing(df: DataFrame, id_col="doc_id", text_col="text", rules=None, order=None) -> DataFrame:
    """The rows of ``df`` that no rule rejects, all columns unchanged."""
    rules = dict(RULES if rules is None else rules)
    order = plan_order(df, id_col, text_col, rules) if order is None else list(order)
    return repeat_rows(df, text_col, lambda data, offsets: run_cascade(Texts(data, offsets), rules, order) < 0)

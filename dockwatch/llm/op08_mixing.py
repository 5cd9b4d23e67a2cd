"""Mixing to target weights by soft membership.

A classifier learnt from a labelled table gives every document a posterior over domains, so a document counts for each domain
in part and unlabelled documents count too. Document rates (how often a document is read per epoch) start at 1 and follow projected
gradients of the least squares

    sum over domains of miss^2, where miss = sum over documents of rate x tokens x posterior - target.

In the metric of token counts the gradient of a document is its posterior times the misses, so an iteration is one vector over the domains:
every rate becomes max(0, rate - posterior x vector), and documents with equal posteriors keep equal rates whatever their length.
The gradient itself always descends if its length is the inverse of the largest eigenvalue of the sum of tokens x posterior x posterior'.
Rare domains make that slow, so it is also tried preconditioned with the inverse of this matrix, over all documents and over those with a rate
above 0, in several lengths, all in one pass over the documents; the vector after which the misses are least is taken.
Iterations end when every total is within the tolerance, or at the least squares. Targets that no rates >= 0 meet would drag all
rates with them, so the target that is missed most is then given up and the others, in proportion, are fitted again; what every
target reached is reported.

Rates become whole numbers of copies by seeded rounding whose mean is the rate.
"""

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwatch.llm.common import hashed_sample, lean, materialise, repeat_rows, utf8_array
from dockwatch.llm.textscan import mix, slices, span_hashes, words

#: Labelled rows that teach at most; the posteriors then cover all documents.
TRAIN_ROWS = 4000
WORD_SLOTS = 1 << 14
EPOCHS = 60
#: Miss of a domain's tokens, as a share of all tokens, that counts as met.
TOLERANCE = 1e-3
#: Lengths of a step that are tried in one pass: of the gradient (in units that always descend), of the preconditioned gradient.
PLAIN_LENGTHS, LENGTHS = (1.0,), (1.0, 0.5, 0.25, 0.0625)
#: Iterations at most, and the descent (share of the squares over STALL_STEPS iterations) below which the least squares count as reached.
MOST_STEPS, STALLED = 80, 0.1
#: So many iterations are compared for that.
STALL_STEPS = 6
_KIND = np.full(256, 9, np.uint8)
for _n, _chars in enumerate((b" \t\n\v\f\r", bytes(range(0x61, 0x7B)), bytes(range(0x41, 0x5B)), b"0123456789", b"|", b"!", b"#*$%&<>", b".,", bytes(range(128, 256)))):
    _KIND[list(_chars)] = _n
KINDS = 10


def token_counts(data, offsets):
    return np.diff(words(data, offsets)[2])


def inputs(data, offsets):
    """Sparse rows: slot, value and text number; shares of byte kinds, then distinct words by hash."""
    n = len(offsets) - 1
    data = data[:offsets[-1]]
    starts, ends, first = words(data, offsets)
    tokens = np.diff(first)
    owner = np.repeat(np.arange(n), tokens)
    slot = (span_hashes(data, starts, ends, lower=True) % np.uint64(WORD_SLOTS)).astype(np.int64)
    cell = np.unique(owner * WORD_SLOTS + slot)
    text, slot = cell // WORD_SLOTS, cell % WORD_SLOTS
    distinct = np.bincount(text, minlength=n)
    shares = np.bincount(np.repeat(np.arange(n), np.diff(offsets)) * KINDS + _KIND[data], minlength=n * KINDS).reshape(n, KINDS)
    shares = np.sqrt(shares / np.maximum(np.diff(offsets), 1)[:, None])
    return shares, (slot, word_values(distinct)[text], text), tokens


def word_values(distinct):
    """What each distinct word of a text counts."""
    return 3.0 / np.sqrt(np.maximum(distinct, 1))


class DomainModel:
    """Multinomial logistic regression on the inputs."""

    def __init__(self, domains):
        self.domains = list(domains)

    def fit(self, rows, labels, rate=0.3, ridge=1e-4):
        shares, (slot, value, text), _ = rows
        k = len(self.domains)
        goal = np.eye(k)[labels]
        share = (goal.sum(0) + 1) / (len(labels) + k)
        self.bias, self.kinds, self.words = np.log(share), np.zeros((KINDS, k)), np.zeros((WORD_SLOTS, k))
        past = [np.full(w.shape, 1e-8) for w in (self.bias, self.kinds, self.words)]
        for _ in range(EPOCHS if k > 1 and len(labels) else 0):
            miss = (self.posteriors(rows) - goal) / len(labels)
            pulled = np.stack([np.bincount(slot, value * miss[text, j], WORD_SLOTS) for j in range(k)], 1)
            steps = [miss.sum(0), shares.T @ miss + ridge * self.kinds, pulled + ridge * self.words]
            for weight, step, seen in zip((self.bias, self.kinds, self.words), steps, past):
                seen += step**2
                weight -= rate * step / np.sqrt(seen)
        return self

    def posteriors(self, rows):
        shares, (slot, value, text), _ = rows
        z = self.bias + shares @ self.kinds
        for j in range(len(self.domains)):
            z[:, j] += np.bincount(text, value * self.words[slot, j], len(shares))
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def fit_domains(df: DataFrame, labelled: DataFrame, id_col: str, text_col: str, rows=TRAIN_ROWS) -> DomainModel:
    """``labelled``: ``id_col, domain``; of an id's repeated labels and texts the smallest counts."""
    known = labelled.select(F.col(id_col).cast("long").alias("id"), F.col("domain").cast("string").alias("domain")).where("id is not null and domain is not null")
    known = known.groupBy("id").agg(F.min("domain").alias("domain"))
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    known = materialise(hashed_sample(known.join(texts.select("id").distinct(), "id", "left_semi"), "id", rows), "known")

    def run(batches):  # a text of any length is KINDS numbers and at most WORD_SLOTS slots to the driver
        for batch in batches:
            data, offsets = utf8_array(batch.column(1))
            for a, b in slices(offsets):
                shares, (slot, _, text), _ = inputs(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                ends = np.searchsorted(text, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * KINDS), pa.array(shares.ravel())),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(slot.astype(np.int32)))], ["id", "shares", "slots"])

    described = texts.join(known.select("id"), "id", "left_semi").mapInArrow(lean(run), "id long, shares array<double>, slots array<int>")
    smallest = described.groupBy("id").agg(F.min(F.struct("shares", "slots")).alias("x"))
    found = smallest.join(known, "id").select("id", "x.shares", "x.slots", "domain").orderBy("id").toArrow()
    domains, n = found["domain"].to_pylist(), len(found)
    slots = found["slots"].combine_chunks()
    shares = np.array(found["shares"].to_pylist(), float).reshape(n, KINDS)
    distinct = np.array([len(x) for x in slots], np.int64)
    text = np.repeat(np.arange(n), distinct)
    names = sorted(set(domains))
    sparse = slots.flatten().to_numpy(zero_copy_only=False).astype(np.int64), word_values(distinct)[text], text
    return DomainModel(names).fit((shares, sparse, None), np.array([names.index(d) for d in domains], np.int64))


def rates(posteriors, steps, tokens=None, cap=np.inf):
    """Rates of documents after the given steps (one vector over the domains each), never below 0 or above ``cap``.

    Documents without ``tokens`` count for no domain and keep rate 1.
    """
    r = np.ones(len(posteriors))
    for step in steps:
        r = np.clip(r - posteriors @ step, 0, cap)
    return r if tokens is None else np.where(np.asarray(tokens) > 0, r, 1.0)


def fit_rates(table: DataFrame, shares: list[float], tolerance=TOLERANCE, most=MOST_STEPS, cap=np.inf, free=()):
    """The steps that lead to the targets, from ``table`` of ``tokens, posterior``, the totals they reach and the targets.

    Domains at the places ``free`` have no target. One pass over the table per iteration; a few numbers per domain come back from it.
    No step if rates of 1 meet the targets.
    """
    k = len(shares)
    bound = np.array([i not in free for i in range(k)])

    def measured(steps, tried):
        """Totals, and products of documents with a rate above 0, after ``steps`` and each of ``tried``."""
        m = len(tried)

        def run(batches):
            sums, gram = np.zeros((m, k)), np.zeros((m, k, k))
            for batch in batches:
                t = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
                p = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
                p, t = p[t > 0], t[t > 0]
                so_far = rates(p, steps, cap=cap)
                for n, step in enumerate(tried):
                    r = np.clip(so_far - p @ step, 0, cap)
                    sums[n] += (r * t) @ p
                    gram[n] += (p * (t * (r > 0))[:, None]).T @ p
            row = np.concatenate([sums.ravel(), gram.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(row))), pa.array(row)], ["i", "v"])

        row = np.zeros(m * (k + k * k))
        for r in table.select("tokens", "posterior").mapInArrow(lean(run), "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():  # one per number
            row[r.i] = r.v
        return row[:m * k].reshape(m, k), row[m * k:].reshape(m, k, k)

    steps = []
    (now,), (active,) = measured(steps, [np.zeros(k)])
    every = now.sum()
    target = np.where(bound, shares, 0.0) / max(np.where(bound, shares, 0.0).sum(), 1e-300) * every

    def inverse(gram):
        return np.linalg.pinv(gram * np.outer(bound, bound), 1e-12, hermitian=True)

    whole, largest = inverse(active), max(np.linalg.eigvalsh(active)[-1], 1e-300) if k else 1.0
    past = []
    while every:
        miss = np.where(bound, now - target, 0.0)
        past.append(miss @ miss)
        stalled = len(past) > STALL_STEPS and past[-1] > (1 - STALLED) * past[-1 - STALL_STEPS]
        if np.abs(miss).max() <= tolerance * every or len(steps) >= most or stalled:
            break
        tried = [x / largest * miss for x in PLAIN_LENGTHS]
        for matrix in (whole, inverse(active)):
            tried += [x * (matrix @ miss) for x in LENGTHS]
        sums, grams = measured(steps, tried)
        squares = (np.where(bound, sums - target, 0.0) ** 2).sum(1)
        at = int(np.argmin(squares))
        if not squares[at] < past[-1]:
            break
        steps.append(tried[at])
        now, active = sums[at], grams[at]
    return steps, now, target


def _uniform(ids, seed):
    """A number in [0, 1) per id."""
    ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return (mix(ids * np.uint64(2) + mix(np.uint64(seed))) >> np.uint64(11)).astype(float) / 2.0**53


REPORT = "domain: string, wanted: double, reached: double"


def fit_mixture(df: DataFrame, labelled: DataFrame, targets: dict, id_col="doc_id", text_col="text", taught_by: DataFrame = None, cap=np.inf):
    """Classifier, table ``id, tokens, posterior`` of all documents, the fitted steps and a report.

    ``taught_by`` holds the texts of the labelled ids, by default ``df``; ``cap`` bounds every rate. The report has a row per target: its
    domain and its share of the tokens as wanted and as reached. Domains without a labelled text have no posterior and reach nothing;
    targets that cannot be met are given up one by one, the one that is missed most first; the others keep their proportions.
    Labels of other domains are ignored. A warning, too, names targets that are missed.
    """
    labelled = labelled.where(F.col("domain").isin([str(d) for d in targets]))
    model = fit_domains(df if taught_by is None else taught_by, labelled, id_col, text_col)
    k = len(model.domains)

    def run(batches):
        for batch in batches:
            data, offsets = utf8_array(batch.column(1))
            for a, b in slices(offsets):
                rows = inputs(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                p = model.posteriors(rows) if k else np.zeros((b - a, 0))
                ends = np.arange(b - a + 1, dtype=np.int32) * k
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(rows[2]), pa.ListArray.from_arrays(pa.array(ends), pa.array(p.ravel()))], ["id", "tokens", "posterior"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    table = materialise(rows.mapInArrow(lean(run), "id long, tokens long, posterior array<double>"), "posteriors")
    steps, got = [], {}
    if k:
        shares, free = [targets[d] for d in model.domains], []
        while True:
            steps, now, target = fit_rates(table, shares, cap=cap, free=free)
            short = [(target[i] - now[i]) / target[i] if i not in free and target[i] else 0.0 for i in range(k)]
            if len(free) == k - 1 or np.abs(np.where(target > 0, now - target, 0)).max() <= TOLERANCE * target.sum() or max(short) <= 0:
                break
            free.append(int(np.argmax(short)))
        got = dict(zip(model.domains, (now / (target.sum() or 1)).tolist()))
    total = sum(targets.values()) or 1
    report = [(str(d), w / total, got.get(str(d), 0.0)) for d, w in targets.items()]
    missed = [f"{d} {b:.4f} instead of {a:.4f}" for d, a, b in report if abs(a - b) > 2 * TOLERANCE]
    if missed:
        warnings.warn(f"targets are missed; tokens as shares of all: {', '.join(missed)}", RuntimeWarning, stacklevel=2)
    return model, table, steps, report


def _copies(r, u):
    return np.floor(r).astype(np.int64) + (u < r - np.floor(r))


def mixture_rates(df: DataFrame, labelled: DataFrame, targets: dict, seed=31, id_col="doc_id", text_col="text", taught_by: DataFrame = None, cap=np.inf) -> DataFrame:
    """``id_col, tokens, domains, posterior, rate, copies, report`` of every row of ``df``; the report names every target, see ``fit_mixture``.

    ``targets``: domain -> weight; together they share as many tokens (words) as ``df`` has. ``copies`` is the rate rounded up or down
    so that its mean is the rate; it depends on id and seed only. A null text has no tokens; a null id rounds as id 0;
    repeated rows count each; rows without tokens keep rate 1; other columns are ignored; without labels every rate is 1; an empty table gives an empty result.
    """
    model, table, steps, report = fit_mixture(df, labelled, targets, id_col, text_col, taught_by, cap)
    k = len(model.domains)

    def run(batches):
        for batch in batches:
            p = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, k)
            r = rates(p, steps, batch.column(1), cap)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(r), pa.array(_copies(r, _uniform(batch.column(0), seed)))], ["id", "tokens", "posterior", "rate", "copies"])

    names = F.array(*[F.lit(d) for d in model.domains]).cast("array<string>")
    out = table.mapInArrow(lean(run), "id long, tokens long, posterior array<double>, rate double, copies long")
    told = F.array(*[F.struct(F.lit(d).alias("domain"), F.lit(a).alias("wanted"), F.lit(b).alias("reached")) for d, a, b in report])
    return out.select(F.col("id").alias(id_col), "tokens", names.alias("domains"), "posterior", "rate", "copies", told.cast(f"array<struct<{REPORT}>>").alias("report"))


def mix_rows(df: DataFrame, labelled: DataFrame, targets: dict, seed=31, id_col="doc_id", text_col="text", taught_by: DataFrame = None, cap=np.inf, report_path: str = None) -> DataFrame:
    """The rows of ``df`` as often as their copies, all columns unchanged; see ``mixture_rates``.

    The report of wanted and reached shares is written as a table to the new folder ``report_path``, if one is given.
    """
    model, _, steps, report = fit_mixture(df, labelled, targets, id_col, text_col, taught_by, cap)
    if report_path:
        df.sparkSession.createDataFrame(report, REPORT).coalesce(1).write.parquet(report_path)
    if not steps:
        return df

    def counts(data, offsets, ids):
        rows = inputs(data, offsets)
        return _copies(rates(model.posteriors(rows), steps, rows[2], cap), _uniform(ids.cast(pa.int64()), seed))

    return repeat_rows(df, text_col, counts, [id_col])

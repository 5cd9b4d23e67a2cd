"""Quality classifier: generalised additive model with pairwise interactions.

Features are whole-text statistics. A model is a lookup table per feature (over quantile bins) and per chosen pair of features
(over coarser bins); a score is the logistic of the sum of the looked-up values. Cyclic boosting learns the tables: round
after round each feature gets one shallow tree fitted to what the model still misses, added to its table at a small rate;
then the pairs with the largest remaining gain get their own rounds. A part of the sample decides how many rounds stay.

The fit uses at most TRAIN_ROWS labelled rows (those with the smallest hashes of the id) on the driver; features and scores
of all texts are computed by Spark.
"""

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwatch.llm.common import hashed_sample, lean, materialise, repeat_rows, utf8_array
from dockwatch.llm.op05_rules import Texts
from dockwatch.llm.textscan import slices, span_hashes

TRAIN_ROWS = 20_000
FEATURES = ("words", "word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "pipes", "exclamations", "stops", "commas",
            "distinct", "top_word", "lines", "non_ascii", "longest", "capitalised", "no_letter", "closing_mark", "other_marks")
_CLASS = np.zeros((7, 256), bool)
for _row, _chars in enumerate((b"0123456789", b"|", b"!", b".", b",", bytes(range(128, 256)), b"?:;\"'()[]{}@/\\_=+~^`-")):
    _CLASS[_row, list(_chars)] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True


def _per_text(values, first):
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return np.diff(total[first])


def features(data, offsets):
    """One row of FEATURES per text."""
    t = Texts(data, offsets)
    every = np.ones(t.rows, bool)
    n, chars, symbols, upper, lower, lines, dup, repeats = (
        t.metric(m, every).astype(float) for m in ("n_words", "word_chars", "n_symbols", "n_upper", "n_lower", "n_lines", "n_dup_lines", "n_repeat_words"))
    counts = [_per_text(c[data], offsets) for c in _CLASS]
    starts, ends, first = t.spans()
    size = ends - starts
    hashes = span_hashes(data, starts, ends, lower=True)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data], dtype=np.int64)])
    without = _per_text(letters[ends] == letters[starts], first)
    capital = _per_text(_UPPER[data[starts]], first) if len(starts) else np.zeros(t.rows)
    closing = _per_text(~_LETTER[data[ends - 1]], first) if len(starts) else np.zeros(t.rows)
    distinct, top, longest = np.zeros(t.rows), np.zeros(t.rows), np.zeros(t.rows)
    for i in np.flatnonzero(n):
        _, c = np.unique(hashes[first[i]:first[i + 1]], return_counts=True)
        distinct[i], top[i], longest[i] = len(c), c.max(), size[first[i]:first[i + 1]].max()
    words, length = np.maximum(n, 1), np.maximum(np.diff(offsets), 1)
    digits, pipes, bangs, stops, commas, high, marks = counts
    return np.stack([
        np.log1p(n), chars / words, symbols / words, dup / np.maximum(lines, 1), repeats / words, upper / np.maximum(upper + lower, 1),
        digits / length, pipes / words, bangs / words, stops / words, commas / words, distinct / words, top / words, lines / words,
        high / length, np.log1p(longest), capital / words, without / words, closing / words, marks / words], 1)


def feature_table(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            data, offsets = utf8_array(batch.column(1))
            for a, b in slices(offsets):
                x = features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]).astype(np.float32)
                rows = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), rows], ["id", "x"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lean(run), "id long, x array<float>")


def _best_cut(g, h, ridge):
    """Best cut of ordered bins into two: gain and number of bins on the left (0: no cut)."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - g.sum()**2 / (h.sum() + ridge)
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def shallow_tree(g, h, ridge, depth=2):
    """Leaf values per ordered bin of a tree of at most ``depth`` levels."""
    if depth:
        gain, k = _best_cut(g, h, ridge)
        if gain > 1e-9:
            return np.concatenate([shallow_tree(g[:k], h[:k], ridge, depth - 1), shallow_tree(g[k:], h[k:], ridge, depth - 1)])
    return np.full(len(g), g.sum() / (h.sum() + ridge))


def pair_tree(g, h, ridge):
    """Leaf values on a grid: one cut of the first feature, then one cut of the second on either side; and the gain."""
    best = None
    total = g.sum()**2 / (h.sum() + ridge)
    for k in range(1, len(g)):
        gain, out = -total, np.empty_like(g)
        for side in (slice(0, k), slice(k, None)):
            gs, hs = g[side].sum(0), h[side].sum(0)
            tree = shallow_tree(gs, hs, ridge, 1)
            out[side] = tree
            for v in np.unique(tree):
                leaf = tree == v
                gain += gs[leaf].sum()**2 / (hs[leaf].sum() + ridge)
        if best is None or gain > best[0]:
            best = (gain, out)
    return best if best is not None else (0.0, np.zeros_like(g))


class AdditiveModel:
    """Lookup tables per feature and per pair; scoring only adds looked-up values."""

    def __init__(self, bins=32, pair_bins=8, pairs=6, rounds=160, pair_rounds=40, rate=0.1, ridge=5.0):
        self.bins, self.pair_bins, self.pairs = bins, pair_bins, pairs
        self.rounds, self.pair_rounds, self.rate, self.ridge = rounds, pair_rounds, rate, ridge
        self.intercept, self.edges, self.coarse, self.tables, self.grids = 0.0, [], [], [], []

    @staticmethod
    def _edges(column, bins):
        return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) if len(column) else np.zeros(0)

    @staticmethod
    def _binned(x, edges):
        return [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)]

    def fit(self, x, y):
        """Labels 0 and 1; one class or no rows give a constant score."""
        x, y = np.asarray(x, float), np.asarray(y, float)
        share = (y.sum() + 1) / (len(y) + 2)
        self.intercept = float(np.log(share / (1 - share)))
        if not len(y) or y.min() == y.max():
            return self
        self.edges = [self._edges(x[:, f], self.bins) for f in range(x.shape[1])]
        self.coarse = [self._edges(x[:, f], self.pair_bins) for f in range(x.shape[1])]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        fine, rough = self._binned(x, self.edges), self._binned(x, self.coarse)
        held = np.arange(len(y)) % 6 == 5  # decides the number of rounds
        total = np.full(len(y), self.intercept)

        def rest():
            p = 1 / (1 + np.exp(-total))
            return np.where(held, 0, y - p), np.where(held, 0, p * (1 - p))

        def loss():
            z = total[held] if held.any() else total
            t = y[held] if held.any() else y
            return float(np.mean(np.logaddexp(0, z) - t * z))

        def boost(tables, step, rounds):
            nonlocal total
            kept = (loss(), [t.copy() for t in tables], total.copy())
            for r in range(rounds):
                for f in range(len(tables)):
                    change, where = step(f)
                    tables[f] += change
                    total = total + change[where]
                now = loss()
                if now < kept[0]:
                    kept = (now, [t.copy() for t in tables], total.copy())
            total = kept[2]
            return kept[1]

        def feature_step(f):
            g, h = rest()
            n = len(self.tables[f])
            return self.rate * shallow_tree(np.bincount(fine[f], g, n), np.bincount(fine[f], h, n), self.ridge), fine[f]

        self.tables = boost(self.tables, feature_step, self.rounds)

        def grid(a, b):
            g, h = rest()
            shape = len(self.coarse[a]) + 1, len(self.coarse[b]) + 1
            cell = rough[a] * shape[1] + rough[b]
            n = shape[0] * shape[1]
            return np.bincount(cell, g, n).reshape(shape), np.bincount(cell, h, n).reshape(shape), cell

        ranked = []
        for a in range(x.shape[1]):
            for b in range(a + 1, x.shape[1]):
                g, h, _ = grid(a, b)
                ranked.append((pair_tree(g, h, self.ridge)[0], -a, -b))
        chosen = [(-a, -b) for gain, a, b in sorted(ranked, reverse=True)[:self.pairs] if gain > 0]
        tables = [np.zeros((len(self.coarse[a]) + 1) * (len(self.coarse[b]) + 1)) for a, b in chosen]

        def pair_step(f):
            g, h, cell = grid(*chosen[f])
            return self.rate * pair_tree(g, h, self.ridge)[1].ravel(), cell

        self.grids = list(zip(chosen, boost(tables, pair_step, self.pair_rounds)))
        return self

    def score(self, x):
        x = np.asarray(x, float)
        total = np.full(len(x), self.intercept)
        for f, e in enumerate(self.edges):
            total += self.tables[f][np.searchsorted(e, x[:, f], "right")]
        for (a, b), table in self.grids:
            width = len(self.coarse[b]) + 1
            total += table[np.searchsorted(self.coarse[a], x[:, a], "right") * width + np.searchsorted(self.coarse[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-total))


def fit_quality(df: DataFrame, labels: DataFrame, label_col="quality", id_col="doc_id", text_col="text", rows=TRAIN_ROWS) -> AdditiveModel:
    """Fit on at most ``rows`` labelled ids; of an id's repeated labels and texts the smallest counts; null labels are ignored."""
    known = labels.where(~held_out(F.col(id_col))).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
    known = known.where("id is not null and y in (0, 1)").groupBy("id").agg(F.min("y").alias("y"))
    ids = df.select(F.col(id_col).cast("long").alias("id")).distinct()
    known = materialise(hashed_sample(known.join(ids, "id", "left_semi"), "id", rows), "known")
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).join(known.select("id"), "id", "left_semi")
    found = feature_table(texts, "id", "text").groupBy("id").agg(F.min("x").alias("x")).join(known, "id").orderBy("id").toArrow()
    x = np.array(found["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    order = np.random.default_rng(11).permutation(len(x))
    return AdditiveModel().fit(x[order], found["y"].to_numpy()[order])


def held_out(id_column):
    """Rows that never teach: crc32 of the id as text divisible by 5; a null id counts as an empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def quality_scores(df: DataFrame, labels: DataFrame, label_col="quality", id_col="doc_id", text_col="text", threshold=0.3) -> DataFrame:
    """``id_col, held_out, score, predicted`` of every row of ``df``; ``labels`` teaches except for held-out ids.

    Scores depend on the text only: null and empty texts share one score, repeated rows score alike, other columns are
    ignored. Without labels the score is constant (0.5). An empty table gives an empty result.
    """
    model = fit_quality(df, labels, label_col, id_col, text_col)

    def run(batches):
        for batch in batches:
            data, offsets = utf8_array(batch.column(1))
            for a, b in slices(offsets):
                x = features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(model.score(x))], ["id", "score"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = rows.mapInArrow(lean(run), "id long, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(df: DataFrame, labels: DataFrame, label_col="quality", id_col="doc_id", text_col="text", threshold=0.3, taught_by: DataFrame = None) -> DataFrame:
    """The rows of ``df`` whose text scores at least ``threshold``, all columns unchanged.

    ``taught_by`` holds the texts of the labelled ids, by default ``df``. An earlier filter may have taken all texts of one
    label out of ``df``: hand in the table before it, or the model learns nothing, which a warning tells.
    """
    model = fit_quality(df if taught_by is None else taught_by, labels, label_col, id_col, text_col)
    if not model.tables:
        warnings.warn("labelled texts of one quality only: the classifier keeps or drops all rows alike", RuntimeWarning, stacklevel=2)
    return repeat_rows(df, text_col, lambda data, offsets: model.score(features(data, offsets)) >= threshold)

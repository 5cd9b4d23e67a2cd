"""Importance resampling towards a target distribution.

Features of a text are its runs of one to three words, hashed into buckets; ``word_automaton`` finds the words and composes
their payloads to buckets. One pass over the corpus and one over the target texts count the buckets. The gain of a bucket is the logarithm
of its smoothed share in the target over its share in the corpus; a second pass over the corpus adds up the gains of every text and
disturbs the sum by Gumbel noise from the id, so that the highest scores are a sample without replacement by importance.

Counts are vectors of fixed length, added per task before they are shuffled; what reaches the driver and the tasks is one number per
bucket. The order of scores is made by ranges, with numbers per part and sums of earlier parts.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwatch.llm.common import lean, materialise, utf8_array
from dockwatch.llm.ordered import in_order, with_place
from dockwatch.llm.textscan import slices
from dockwatch.llm.word_automaton import dictionary, feature_buckets, line_of, run_crcs

BUCKETS = 10_000
#: Bytes of a long text that are scanned at once (to the next delimiter).
WINDOW = 1 << 20


def _long_text(data, buckets, window):
    """Buckets and number of words of the windows of one text; a run counts in the window of its last word."""
    at, last = 0, len(data)
    held = np.zeros(0, np.uint32), np.zeros(0, np.uint32), np.zeros(0, np.int64)
    while at < last:
        stop = min(at + window, last)
        while stop < last:  # a word is never cut
            line, _ = line_of(data[stop:stop + 4096], np.array([0, min(4096, last - stop)]))
            gap = np.flatnonzero(line[1:-2] == 0x20)
            if len(gap):
                stop += int(gap[0])
                break
            stop = min(stop + 4096, last)
        line, _ = line_of(data[at:stop], np.array([0, stop - at]))
        _, *payload = dictionary().scan(line)
        n, old = len(payload[0]), len(held[0])
        held = tuple(np.concatenate([a, b]) for a, b in zip(held, payload))
        one, two, three = run_crcs(*held)
        new = np.concatenate([one[old:], two[max(old - 1, 0):], three])  # at most two words are held: all runs of three are new
        yield new.astype(np.int64) % buckets, n
        held = tuple(x[-2:] for x in held)
        at = stop


def scanned(data, offsets, buckets, window=WINDOW):
    """For pieces of bounded size: first text, last text, bucket of every feature, its text (from the first), words per text."""
    for a, b in slices(offsets):
        if offsets[b] - offsets[a] > 2 * window:
            for found, n in _long_text(data[offsets[a]:offsets[b]], buckets, window):
                yield a, b, found, np.zeros(len(found), np.int64), np.array([n])
        else:
            yield a, b, *feature_buckets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], buckets)


def bucket_counts(df: DataFrame, text_col="text", buckets=BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all texts of ``df``."""

    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, found, _, _ in scanned(*utf8_array(batch.column(0)), buckets):
                counts += np.bincount(found, minlength=buckets)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["bucket", "n"])

    parts = df.select(F.col(text_col).cast("string").alias("text")).mapInArrow(lean(run), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket
        out[row.bucket] = row.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of every bucket in thousandths."""
    b, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b)))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id, seed) -> int:
    """Gumbel noise in thousandths from the id; a null id counts as an empty text."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def resample(df: DataFrame, target: DataFrame, percent=5, min_words=20, seed=42, buckets=BUCKETS, id_col="doc_id", text_col="text",
             target_col="text") -> DataFrame:
    """``id_col, n_features, weight, score, rank`` of every row of ``df``; ``rank`` counts the drawn rows from 1, others have none.

    Of the rows with at least ``min_words`` words, ``percent`` in a hundred (rounded down) with the highest scores are drawn, ties to the smaller
    id, null ids first. Null and empty texts have no features, weight 0 and are never drawn; repeated rows are drawn each; texts
    of any length are scanned whole; without target texts all gains come from the corpus alone; other columns are ignored; an
    empty table gives an empty result.
    """
    gains = bucket_gains(bucket_counts(df, text_col, buckets), bucket_counts(target, target_col, buckets))

    def run(batches):
        for batch in batches:
            rows = batch.num_rows
            n_words, weight = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            for a, b, found, owner, n in scanned(*utf8_array(batch.column(1)), buckets):
                n_words[a:b] += n
                total = np.concatenate([[0], np.cumsum(gains[found[np.argsort(owner, kind="stable")]])])
                weight[a:b] += np.diff(total[np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=b - a))])])
            noises = np.array([noise(i, seed) for i in batch.column(0).to_pylist()], np.int64)
            features = n_words + np.maximum(n_words - 1, 0) + np.maximum(n_words - 2, 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (n_words, features, weight, weight + noises))],
                                             ["id", "n_words", "n_features", "weight", "score"])

    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = texts.mapInArrow(lean(run), "id long, n_words long, n_features long, weight long, score long")
    scored = materialise(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    may = materialise(scored.where(F.col("n_words") >= min_words), "may")
    placed = with_place(in_order(may, [F.desc("score"), F.asc_nulls_first("id"), F.asc("row")], "by_score"), [])
    drawn = F.when(F.col("place") < F.floor(F.lit(percent) * F.col("of") / 100), F.col("place") + 1)
    shown = ["n_features", "weight", "score"]
    out = placed.select("id", *shown, drawn.alias("rank"))
    rest = scored.where(F.col("n_words") < min_words).select("id", *shown, F.lit(None).cast("long").alias("rank"))
    return out.unionByName(rest).withColumnRenamed("id", id_col)

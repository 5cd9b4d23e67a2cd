"""Approximate nearest neighbours with a hash-prefix forest (LSH forest).

Every tree gives each vector a long hash string (signs against random directions) and keeps the strings in one sorted array;
a prefix of a string is a range of that array. A query descends in every tree to the longest prefix that any row matches,
then all trees ascend one bit at a time, in step, until the ranges together hold enough rows. Those rows are scored exactly
on the original vectors.

The rows are dealt into blocks of bounded size and each block holds its own forest over all its rows; the stated queries
visit every block and the best of the blocks are merged, so no task holds more than a block and a slice of queries. Blocks and slices
are as large as a task can hold, since a block is sent once per slice and a slice once per block; while either is few,
slices are smaller so that all cores have work.

How many rows the ascent gathers is measured: on a bounded sample of rows, forests are searched exactly and with growing
shares of candidates, and the smallest share that finds TARGET_RECALL of the true neighbours is taken.
Equal vectors are folded into one entry that carries its smallest ids, so that copies neither fill the candidates nor
gather in one task; no row that could be among the nearest is lost by that.

The directions are drawn from a seed; nothing is fitted to data.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockwatch.llm.common import materialise

BITS = 32
TREES = 64
#: Shares of a block's entries that the ascent may gather before it stops (and a least number); the sample decides which.
SHARES = (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.65, 0.8, 1.0)
LEAST_CANDIDATES = 256
TARGET_RECALL = 0.95
#: Entries and queries of the sample.
SAMPLE_ROWS, SAMPLE_QUERIES = 1 << 13, 200
#: Entries of a block, queries that visit it as one slice, and queries whose candidates are held at once.
BLOCK_ROWS = 1 << 16
QUERY_ROWS = 1 << 14
HELD_QUERIES = 256


def directions(dim: int, trees: int, bits: int, seed: int):
    return np.random.default_rng([seed, dim]).standard_normal((dim, trees * bits), dtype=np.float32)


class PrefixForest:
    """Sorted arrays of hash strings over the rows of one block."""

    def __init__(self, vectors, trees=TREES, bits=BITS, seed=0):
        self.trees, self.bits = trees, bits
        self.planes = directions(vectors.shape[1], trees, bits, seed)
        codes = self.codes(vectors)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, axis=1)

    def codes(self, vectors):
        """Hash strings as whole numbers, first sign as highest bit: one row per tree."""
        weights = np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64)
        out = np.empty((self.trees, len(vectors)), np.uint64)
        for a in range(0, len(vectors), 4096):
            signs = (vectors[a:a + 4096] @ self.planes > 0).reshape(-1, self.trees, self.bits)
            out[:, a:a + 4096] = (signs * weights).sum(2, dtype=np.uint64).T
        return out

    def ranges(self, codes, level):
        """Range of each tree's array whose strings share ``level`` leading signs with the query."""
        rest = np.uint64((1 << (self.bits - level)) - 1)
        low = np.stack([np.searchsorted(s, c & ~rest) for s, c in zip(self.sorted, codes)])
        high = np.stack([np.searchsorted(s, c | rest, "right") for s, c in zip(self.sorted, codes)])
        return low, high

    def candidates(self, queries, wanted):
        """For every query the row numbers found when at least ``wanted`` different rows are gathered, or all rows."""
        n = self.order.shape[1]
        wanted = min(wanted, n)
        codes = self.codes(queries)
        found = [None] * len(queries)
        waiting = np.arange(len(queries))
        for level in range(self.bits, -1, -1):  # all trees ascend together
            if not len(waiting):
                break
            if level == 0:
                for q in waiting:
                    found[q] = np.arange(n)
                break
            low, high = self.ranges(codes[:, waiting], level)
            enough = (high - low).sum(0) >= wanted
            seen = np.zeros(n, bool)
            still = []
            for k, q in enumerate(waiting):
                if enough[k]:
                    seen[:] = False
                    for t in range(self.trees):
                        seen[self.order[t, low[t, k]:high[t, k]]] = True
                    rows = np.flatnonzero(seen)
                    if len(rows) >= wanted:
                        found[q] = rows
                        continue
                still.append(q)
            waiting = np.array(still, int)
        return found


def unit_rows(vectors):
    """Vectors of length 1 in single precision, and the lengths."""
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    return (vectors / norms[:, None]).astype(np.float32), norms


def nearest_in_block(entries, owners, queries, query_ids, k, trees, bits, seed, share, least):
    """Best ``k`` (query number, id, cosine) of one block; ``owners``: ids per entry, ascending."""
    unit, norms = unit_rows(entries)
    unit_queries, query_norms = unit_rows(queries)
    forest = PrefixForest(unit, trees, bits, seed)
    out = []
    for first in range(0, len(queries), HELD_QUERIES):
        found = forest.candidates(unit_queries[first:first + HELD_QUERIES], max(int(share * len(entries)), least))
        for q, rows in enumerate(found, first):
            rough = unit[rows] @ unit_queries[q]
            # one entry may hold only the query itself, so k + 1 entries; the margin covers the rounding of the rough scores
            cut = np.partition(rough, len(rough) - k - 1)[len(rough) - k - 1] - 1e-4 if len(rough) > k + 1 else -np.inf
            rows = rows[rough >= cut]
            # each row is summed alike in double precision
            scores = np.einsum("ij,j->i", entries[rows], queries[q]) / (norms[rows] * query_norms[q])
            best = [(-score, owner) for row, score in zip(rows, scores) for owner in owners[row] if owner != query_ids[q]]
            out += [(q, owner, -score) for score, owner in sorted(best)[:k]]
    return out


def measured_share(vectors, k, trees, bits, seed, least, target=TARGET_RECALL, shares=SHARES):
    """The smallest of ``shares`` whose candidates hold ``target`` of the true ``k`` nearest of a sample; 1 if none does."""
    if len(vectors) <= max(least, k + 1):
        return 1.0
    unit, _ = unit_rows(vectors)
    forest, asked = PrefixForest(unit, trees, bits, seed), unit[:SAMPLE_QUERIES]
    scores = asked @ unit.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    true = np.argpartition(-scores, k, axis=1)[:, :k]
    for share in shares:
        found = forest.candidates(asked, max(int(share * len(unit)), least))
        if np.mean([np.isin(t, rows).mean() for t, rows in zip(true, found)]) >= target:
            return share
    return 1.0


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Distinct ``id, vec`` (doubles) that can take part: no null id, no null or non-finite component, not zero."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return rows.where(
        "id is not null and vec is not null and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        " and exists(vec, x -> x <> 0)").distinct()


def nearest(df: DataFrame, is_query, k=5, id_col="vec_id", vec_col="embedding", trees=TREES, bits=BITS, seed=0,
            share=None, least=LEAST_CANDIDATES, block_rows=BLOCK_ROWS, query_rows=QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found by cosine for every row that ``is_query`` names.

    ``is_query``: a condition on the column ``id``. ``share`` of a block's entries are gathered; by default it is measured, once for
    vectors of each length. Candidates are all rows but those with the query's own id; fewer than
    ``k`` give fewer rows. Ties go to the smaller id. Null ids and vectors that are null, empty, zero or hold a null or
    non-finite component take no part; only vectors of equal length are compared; a repeated row counts once; an id with
    several vectors asks once for each; other columns are ignored; an empty table gives an empty result.
    """
    rows = materialise(valid_vectors(df, id_col, vec_col), "vectors")
    order = Window.partitionBy(F.xxhash64("vec"), "vec").orderBy("id")
    # only the k + 1 smallest ids of equal vectors can be among the nearest; Spark applies this limit before the shuffle
    few = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    entries = materialise(few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")), "entries")
    queries = rows.where(is_query)
    blocks = max(1, -(-entries.count() // block_rows))
    cores = df.sparkSession.sparkContext.defaultParallelism
    asking = queries.count()
    parts = max(1, -(-asking // query_rows), min(-(-2 * cores // blocks), -(-asking // HELD_QUERIES)))
    picked = {}
    if share is None:
        sample = entries.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE_ROWS).toArrow()["vec"].combine_chunks()
        sizes = np.diff(sample.offsets.to_numpy()) if len(sample) else np.zeros(0, int)
        lists = sample.to_pylist()
        picked = {int(d): measured_share(np.array([lists[i] for i in np.flatnonzero(sizes == d)], float), k, trees, bits, seed, least) for d in np.unique(sizes)}

    def each(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    dealt = entries.select(F.pmod(F.xxhash64("vec"), F.lit(blocks)).cast("int").alias("block"), each(parts).alias("part"),
                           F.size("vec").alias("dim"), F.lit(0).alias("kind"), "vec", "ids")
    asked = queries.select(F.lit(0).alias("block"), F.pmod(F.xxhash64("id", "vec"), F.lit(parts)).cast("int").alias("part"),
                           F.size("vec").alias("dim"), F.lit(1).alias("kind"), "vec", F.array("id").alias("ids"))
    asked = asked.withColumn("block", each(blocks))

    def search(table):
        table = table.combine_chunks()
        kind = table["kind"].to_numpy()
        dim = table["dim"][0].as_py() if len(table) else 0
        vectors = table["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(table), dim)
        owners = table["ids"].to_pylist()
        e, q = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
        best = []
        if len(e) and len(q):
            best = nearest_in_block(vectors[e], [owners[i] for i in e], vectors[q], [owners[i][0] for i in q], k, trees, bits, seed, picked.get(dim, 1.0) if share is None else share, least)
        return pa.table({
            "query_id": pa.array([owners[q[b[0]]][0] for b in best], pa.int64()), "query_vec": pa.array([vectors[q[b[0]]] for b in best], pa.list_(pa.float64())),
            "vec_id": pa.array([b[1] for b in best], pa.int64()), "score": pa.array([b[2] for b in best], pa.float64())})

    found = dealt.unionByName(asked).groupBy("block", "part", "dim").applyInArrow(
        search, "query_id long, query_vec array<double>, vec_id long, score double")
    # an id can own several vectors: its best one counts
    found = found.groupBy("query_id", F.xxhash64("query_vec").alias("which"), "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id", "which").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

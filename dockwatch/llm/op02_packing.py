"""Packing into length buckets of least padding.

The global histogram of token lengths is small: lengths up to EXACT count one by one, longer ones are rounded up by less
than one part in 128, so it has EXACT + 128 rows per doubling at most, whatever the corpus. Dynamic programming over it finds the bucket
bounds with the least padded tokens. Inside a bucket, documents in a seeded random order form batches of as many
documents as fit the token budget when each is padded to the bucket's bound.

Numbers within a bucket are made in two levels (cells of the order, then rows of a cell), so that a bucket with a third of
all documents is spread over many tasks.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockwatch.llm.common import lean, materialise, utf8_array
from dockwatch.llm.op09_shards import BUCKET_ROWS, MAX_BUCKETS, with_offset
from dockwatch.llm.tokens import encoder as encoder_of

BUCKETS = 16
TOKEN_BUDGET = 32_768
EXACT = 1024


def rounded_up(length):
    """Histogram edge of a length column: itself up to EXACT, above that a multiple of 2^(bits - 8)."""
    unit = F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(length, F.lit(1)))) - 7)
    return F.when(length <= EXACT, length).otherwise((F.ceil(length / unit) * unit).cast("long"))


def best_bounds(edges, counts, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least sum of bound x documents; the last is the largest edge."""
    edges, counts = np.asarray(edges, np.int64), np.asarray(counts, np.int64)
    n = len(edges)
    before = np.concatenate([[0], np.cumsum(counts)])
    infinite = np.iinfo(np.int64).max // 4
    cost = np.full(n + 1, infinite)
    cost[0] = 0
    back = []
    for _ in range(min(buckets, n)):
        fresh, source = np.full(n + 1, infinite), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            total = cost[:j] + edges[j - 1] * (before[j] - before[:j])
            source[j] = np.argmin(total)
            fresh[j] = total[source[j]]
        back.append(source)
        cost = fresh
    bounds, j = [], n
    for source in reversed(back):
        if j == 0:
            break
        bounds.append(int(edges[j - 1]))
        j = int(source[j])
    return bounds[::-1]


def token_lengths(df: DataFrame, tokenizer: str, id_col: str, text_col: str) -> DataFrame:
    """``id, n_tokens``: tokens of every whole text and one end token."""

    def run(batches):
        encoder = encoder_of(tokenizer)
        for batch in batches:
            data, offsets = utf8_array(batch.column(1))
            for a, b, _, at in encoder.encode_texts(data, offsets):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(at) + 1)], ["id", "n_tokens"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(lean(run), "id long, n_tokens long")


def pack(lengths: DataFrame, buckets=BUCKETS, budget=TOKEN_BUDGET, seed=29, bucket_rows=BUCKET_ROWS) -> DataFrame:
    """``id, n_tokens, bucket, padded_to, batch, slot`` of every row ``id, n_tokens``.

    Batches count from 0 within a bucket, slots from 0 within a batch. A batch holds ``budget div padded_to`` documents, one
    at least, so only a document longer than the budget exceeds it, alone in its batch. A null length is 0. Null ids and
    repeated rows are packed each; an empty table gives an empty result.
    """
    rows = lengths.select("id", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"))
    histogram = rows.groupBy(rounded_up(F.col("n_tokens")).alias("edge")).agg(F.count("*").alias("n")).orderBy("edge").collect()
    bounds = best_bounds([r.edge for r in histogram], [r.n for r in histogram], buckets) or [0]
    total = sum(r.n for r in histogram)
    cells = max(8, min(MAX_BUCKETS, -(-total // bucket_rows)))
    array = f"array({', '.join(f'{b}L' for b in bounds)})"
    rows = rows.withColumn("bucket", F.expr(f"size(filter({array}, b -> b < n_tokens))"))
    rows = rows.withColumn("padded_to", F.expr(f"{array}[bucket]"))
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("")), "n_tokens"))
    rows = rows.withColumn("c", F.expr(f"cast(shiftrightunsigned(h, 33) * {cells} div 2147483648 as int)"))
    before = with_offset(rows.groupBy("bucket", "c").agg(F.count("*").alias("n")), ["bucket"], "c").drop("n")
    place = F.row_number().over(Window.partitionBy("bucket", "c").orderBy("h", "id"))
    placed = rows.withColumn("r", place).join(before, ["bucket", "c"]).withColumn("r", F.col("r") + F.col("before") - 1)
    fit = f"greatest(1L, {budget} div greatest(padded_to, 1L))"
    return placed.select("id", "n_tokens", "bucket", "padded_to", F.expr(f"r div {fit}").alias("batch"), F.expr(f"cast(r % {fit} as int)").alias("slot"))


def pack_documents(df: DataFrame, tokenizer: str, id_col="doc_id", text_col="text", buckets=BUCKETS, budget=TOKEN_BUDGET) -> DataFrame:
    """Tokenise every whole text of ``df`` (null: empty, one end token) and pack the documents; see ``pack``."""
    lengths = materialise(token_lengths(df, tokenizer, id_col, text_col), "lengths")
    return pack(lengths, buckets, budget).withColumnRenamed("id", id_col)

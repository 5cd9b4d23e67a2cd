"""Sharding by proportional stratified interleaving; DataFrame functions only.

Rows are put in a seeded random order within their source; row number r of n in its source has the fractional rank
(r - u) / n, where u is a seeded number between 0 and 1 per source that keeps small sources from rounding in step. Sorted by
it, the sources interleave in proportion, so any contiguous piece has the mixture of the whole, and the sorted rows are cut
into shards whose row counts differ by at most one.

Both numberings are done in two levels, numbers within buckets plus the counted rows of earlier buckets, so that
neither a source with a third of all rows nor the global order meets in one task. Only narrow rows are shuffled.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockwatch.llm.common import materialise

#: Rows that one window holds, about.
BUCKET_ROWS = 200_000
MAX_BUCKETS = 1 << 16


def with_offset(counts: DataFrame, keys: list, cell: str) -> DataFrame:
    """Rows of the earlier cells of the same keys, from one row per cell."""
    earlier = Window.partitionBy(*keys).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def interleaved_shards(df: DataFrame, shards: int, seed=17, id_col="doc_id", text_col="text", source_col="source", bucket_rows=BUCKET_ROWS) -> DataFrame:
    """``id_col, size, text_crc32, source, shard, slot``: every row of ``df`` in one of ``shards`` shards.

    ``size``: UTF-8 bytes of the text (null: none) plus 16. Slots count from 0 without gaps in every shard; shards after the
    last row stay empty when there are fewer rows than shards. A null source is a source of its own; null ids and repeated
    rows are placed like any other (rows equal in id and text take neighbouring ranks in any order, which gives the same
    set of rows); other columns are ignored; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("src"),
        (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"))
    rows = rows.withColumn("nosrc", F.col("src").isNull()).withColumn("src", F.coalesce("src", F.lit("")))
    rows = materialise(rows.withColumn("h", F.xxhash64(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("")), "crc", "size")), "rows")
    total = rows.count()
    cells = max(64, min(MAX_BUCKETS, -(-total // bucket_rows)))
    rows = rows.withColumn("b", F.expr(f"cast(shiftrightunsigned(h, 33) * {cells} div 2147483648 as int)"))

    key = ["nosrc", "src"]
    counted = with_offset(rows.groupBy(*key, "b").agg(F.count("*").alias("n")), key, "b")
    counted = counted.withColumn("of", F.sum("n").over(Window.partitionBy(*key))).drop("n")
    within = F.row_number().over(Window.partitionBy(*key, "b").orderBy("h", "id", "crc", "size"))
    ranked = rows.withColumn("r", within).join(counted, [*key, "b"]).withColumn("r", F.col("r") + F.col("before"))
    ranked = ranked.withColumn("u", F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1023)) + 1)
    ranked = ranked.select("id", "size", "crc", *key, "r", F.expr("(1024 * r - u) / (1024 * of)").alias("f"),
                           F.expr(f"cast((1024 * r - u) * {cells} div (1024 * of) as int)").alias("g"))
    ranked = materialise(ranked, "ranked")

    # one row per cell: at most MAX_BUCKETS rows meet in this window
    starts = with_offset(ranked.groupBy("g").agg(F.count("*").alias("n")), [F.lit(0)], "g").drop("n")
    place = F.row_number().over(Window.partitionBy("g").orderBy("f", "nosrc", "src", "r"))
    placed = ranked.withColumn("p", place).join(starts, "g").withColumn("p", F.col("p") + F.col("before") - 1)
    small, larger = divmod(total, shards)
    cut, wide = larger * (small + 1), max(small, 1)
    p = F.col("p")
    shard = F.when(p < cut, F.expr(f"p div {small + 1}")).otherwise(F.expr(f"{larger} + (p - {cut}) div {wide}"))
    slot = F.when(p < cut, F.expr(f"p % {small + 1}")).otherwise(F.expr(f"(p - {cut}) % {wide}"))
    return placed.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
        F.when(~F.col("nosrc"), F.col("src")).alias("source"), shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))

"""Global order and place numbers without a task that holds a key, a group or the whole order."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockwatch.llm.common import materialise

#: Rows that one sorted part holds, about.
PART_ROWS = 1 << 20
_PART_BITS = 33  # how Spark composes these numbers: part above, row below


def in_order(df: DataFrame, order: list[Column], name: str, part_rows=PART_ROWS) -> DataFrame:
    """``df`` stored in the given order, with its position ``_at``: ascending, with gaps between the sorted parts.

    ``df`` is a stored table and ``order`` ends in a column without ties, so that equal rows, too, are dealt over parts.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // part_rows))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return materialise(dealt.withColumn("_at", F.monotonically_increasing_id()), name)


def with_place(ordered: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``place`` (from 0) and ``of`` (rows) per value of ``keys`` to a table from ``in_order``, whose order begins with ``keys``.

    Counts per part, one row per part and key, are summed in order; windows see those counts only. Keys hold no nulls.
    """
    ordered = ordered.withColumn("_part", F.shiftrightunsigned("_at", _PART_BITS))
    counts = ordered.groupBy(*keys, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns({"_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)), "of": F.sum("_n").over(group)})
    placed = ordered.join(counts.drop("_n"), [*keys, "_part"])
    return placed.withColumn("place", F.col("_at") - F.col("_first") + F.col("_before")).drop("_part", "_at", "_first", "_before")

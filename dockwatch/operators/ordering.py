"""Latest row, de-duplication, neighbours and top-k, written to hold when one key has most rows."""

from pyspark.sql import DataFrame, Window, functions as F

from dockwatch.session import materialise

# rows of one instant are cut into blocks of at most this many row ids (a power of two)
BLOCK_ROWS = 1 << 20


def _pick(df: DataFrame, keys, order, chooser) -> DataFrame:
    """One row per key, chosen by an order-by aggregate: each task reduces its share of a heavy key
    before anything is shuffled, which a ranking window cannot do."""
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[F.col(c) for c in order]) if len(order) > 1 else F.col(order[0])
    best = df.groupBy(*keys).agg(chooser(F.struct(*rest), ranked).alias("row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in df.columns])


def latest_by(df: DataFrame, keys, order) -> DataFrame:
    """The row with the greatest ``order`` columns per key."""
    return _pick(df, list(keys), list(order), F.max_by)


def first_by(df: DataFrame, keys, order) -> DataFrame:
    """The row with the smallest ``order`` columns per key."""
    return _pick(df, list(keys), list(order), F.min_by)


def dedup(df: DataFrame, keys=("station_id", "collected_at"), order=("row_id",)) -> DataFrame:
    """One row per key; the lowest ``order`` survives, so a rerun keeps the same rows."""
    return first_by(df, keys, order)


def keep_lowest(df: DataFrame, keys, row_id="row_id") -> DataFrame:
    """Delete every row that has a twin (same non-null keys) with a lower id.

    Rows with a NULL key never equal another row and are all kept.
    """
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    # a row with a NULL key is a group of its own, so one pass serves both kinds
    alone = df.withColumn("alone", F.when(~complete, F.col(row_id)))
    return first_by(alone, [*keys, "alone"], [row_id]).drop("alone")


def repeated_keys(df: DataFrame, keys, row_id="row_id") -> DataFrame:
    """Keys that occur more than once and the lowest row id of each (``kept_id``).

    Only the keys and ids are shuffled, reduced by each task first.
    """
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(row_id).alias("kept_id"))
    return groups.filter(F.col("n") > 1).drop("n")


def surplus_rows(df: DataFrame, repeated: DataFrame, keys, row_id="row_id") -> DataFrame:
    """Row ids to delete so that one row per key is left, given the stored list of repeated keys."""
    narrow = df.select(*keys, row_id)
    return narrow.join(repeated, list(keys)).filter(F.col(row_id) > F.col("kept_id")).select(row_id)


def latest_per_key(df: DataFrame, key: str, time: str) -> DataFrame:
    """Rows at their key's greatest time, ties kept.

    The rows are matched on (key, time): a heavy key spreads over its many times.
    """
    newest = df.groupBy(key).agg(F.max(time).alias(time))
    return df.join(newest, [key, time], "left_semi")


def _around_missing(narrow: DataFrame) -> DataFrame:
    """Rows of the days on which a key has a row without a value, and of the key's last day before and first day after each.

    Its neighbours lie there. Days are found from one row per key and day; the list is stored, so that the rows are not shuffled while it is short.
    """
    dated = narrow.withColumn("day", F.to_date("t"))
    by_day = Window.partitionBy("k").orderBy("day")
    days = dated.groupBy("k", "day").agg(F.max(F.col("v").isNull()).alias("lost"))
    near = days.withColumn("near", F.col("lost") | F.lag("lost", 1, False).over(by_day) | F.lead("lost", 1, False).over(by_day)).filter("near")
    near = materialise(near.select(F.col("k").alias("nk"), F.col("day").alias("nd")), "near")
    return dated.join(near, F.col("k").eqNullSafe(F.col("nk")) & F.col("day").eqNullSafe(F.col("nd")), "left_semi").drop("day")


def with_neighbours(df: DataFrame, value: str, key="station_id", time="collected_at", row_id="row_id",
                    previous="previous_value", following="next_value", only_missing: bool = False, current: str = None) -> DataFrame:
    """Value of the row just before and just after, per key by (time, row id); NULLs are not skipped.

    Returns (row_id, previous, following), with ``only_missing`` just for rows without a value, with ``current`` the row's
    own value under that name too.
    Equal to ``lag``/``lead`` over one window per key, but no window holds a whole key: rows are
    compared inside one (key, time, id block), blocks inside one (key, day), days inside one key.
    Row ids must be unique. With ``only_missing`` only the days around the rows without a value are compared.
    """
    narrow = df.select(
        F.col(key).alias("k"), F.col(time).alias("t"), F.col(row_id).alias("id"), F.col(value).alias("v"),
        F.shiftright(F.col(row_id), BLOCK_ROWS.bit_length() - 1).alias("b"),
    )
    if only_missing:
        narrow = _around_missing(narrow)
    rows = Window.partitionBy("k", "t", "b").orderBy("id")
    inside = narrow.select(
        "k", "t", "b", "id", "v",
        F.lag("v").over(rows).alias("row_prev"), F.lead("v").over(rows).alias("row_next"),
        F.lag("id").over(rows).isNotNull().alias("row_has_prev"),
        F.lead("id").over(rows).isNotNull().alias("row_has_next"),
        F.last("v").over(rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("last_v"),
    )
    # the first row of a block stands for it: same shuffle as the rows
    blocks = inside.filter(~F.col("row_has_prev")).select(
        "k", "t", "b", F.col("v").alias("first_v"), "last_v", F.to_date("t").alias("day"))
    if only_missing:
        inside = inside.filter(F.col("v").isNull())
    in_day = Window.partitionBy("k", "day").orderBy("t", "b")
    chained = blocks.select(
        F.col("k").alias("bk"), F.col("t").alias("bt"), F.col("b").alias("bb"), "day",
        F.lag("last_v").over(in_day).alias("block_prev"), F.lead("first_v").over(in_day).alias("block_next"),
        F.lag("b").over(in_day).isNotNull().alias("block_has_prev"),
        F.lead("b").over(in_day).isNotNull().alias("block_has_next"),
    )
    days = blocks.groupBy("k", "day").agg(
        F.min_by("first_v", F.struct("t", "b")).alias("first_v"), F.max_by("last_v", F.struct("t", "b")).alias("last_v")
    )
    by_day = Window.partitionBy("k").orderBy("day")
    across = days.select(
        F.col("k").alias("dk"), F.col("day").alias("dd"),
        F.lag("last_v").over(by_day).alias("day_prev"), F.lead("first_v").over(by_day).alias("day_next"),
    )
    # every row has its block and every block its day: inner joins, so that a few wanted rows can be broadcast
    joined = inside.join(
        chained, F.col("k").eqNullSafe(F.col("bk")) & F.col("t").eqNullSafe(F.col("bt")) & (F.col("b") == F.col("bb"))
    ).join(across, F.col("k").eqNullSafe(F.col("dk")) & F.col("day").eqNullSafe(F.col("dd")))
    return joined.select(
        F.col("id").alias(row_id), *([F.col("v").alias(current)] if current else []),
        F.when(F.col("row_has_prev"), F.col("row_prev")).when(F.col("block_has_prev"), F.col("block_prev"))
        .otherwise(F.col("day_prev")).alias(previous),
        F.when(F.col("row_has_next"), F.col("row_next")).when(F.col("block_has_next"), F.col("block_next"))
        .otherwise(F.col("day_next")).alias(following),
    )


def top_k(df: DataFrame, order, k: int) -> DataFrame:
    """The ``k`` first rows; give a tie-break so the result is fixed."""
    return df.orderBy(*order).limit(k)


def rank_of(column: str, ranks):
    """Place of a value in a fixed order of values, others last."""
    rank = F.lit(len(ranks))
    for position, value in reversed(list(enumerate(ranks))):
        rank = F.when(F.col(column) == value, F.lit(position)).otherwise(rank)
    return rank


def order_by_rank(df: DataFrame, column: str, ranks, *then) -> DataFrame:
    """Sort by a fixed order of values (others last), then by ``then``."""
    return df.orderBy(rank_of(column, ranks), *then)


def with_position(df: DataFrame, *order, name="position") -> DataFrame:
    """Number all rows from 1 in the given order, whose columns tell every two rows apart.

    Rows are sorted in ranges, each range numbers its own, and the counts of earlier ranges, one row per range, are added: no
    task holds more than a range.
    """
    marked = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    marked = materialise(marked, "ordered").withColumn("_range", F.shiftrightunsigned("_at", 33))
    counts = marked.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    counts = counts.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return marked.join(counts, "_range").withColumn(name, place).drop("_at", "_range", "_before")


def with_earlier_sum(df: DataFrame, value: str, *order, name: str) -> DataFrame:
    """Add the sum of ``value`` over all rows before each one in the given order, whose columns tell every two rows apart.

    Rows are dealt to ranges, each range sums its own, and the sums of earlier ranges, one row per range, are added.
    """
    marked = materialise(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ordered")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sums = marked.groupBy("_range").agg(F.sum(value).alias("_sum")).select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(value).over(inside), F.lit(0))
    return marked.join(sums, "_range").withColumn(name, F.col("_before") + within).drop("_range", "_before")

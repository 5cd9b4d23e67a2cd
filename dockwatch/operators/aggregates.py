"""Counting building blocks of the checks and reports."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from dockwatch.operators.ordering import with_neighbours


def anomaly_count(condition: Column) -> Column:
    """Rows where the condition is true; NULL is not an anomaly."""
    return F.count_if(condition)


def tuple_distinct(df: DataFrame, *columns) -> DataFrame:
    """Rows and distinct tuples, tuples with NULLs included.

    Grouping first lets each task drop its copies before the shuffle.
    """
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"), F.count(F.lit(1)).alias("n_tuples")
    )


def majority_groups(df: DataFrame, key: str, condition: Column, *extra) -> DataFrame:
    """Groups in which the condition holds for more than half of the rows."""
    grouped = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_if(condition).alias("n_true"), *extra)
    return grouped.filter(F.col("n_true") * 2 > F.col("n"))


def multi_valued(df: DataFrame, key: str, value: str) -> DataFrame:
    """Non-null keys and how many of them have more than one non-null value."""
    pairs = df.filter(F.col(key).isNotNull()).groupBy(key, value).agg(F.lit(1).alias("one"))
    per_key = pairs.groupBy(key).agg(F.count(value).alias("n_values"))
    return per_key.agg(F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col("n_values") > 1).alias("n_multi"))


def table_counts(tables: dict) -> DataFrame:
    """Row count of each table, in one frame."""
    out = None
    for name, frame in tables.items():
        one = frame.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def under_capacity(tables: dict) -> DataFrame:
    """Readings whose bikes and free docks stay below the station's capacity; readings need type rows."""
    bikes = tables["reading_bikes"].groupBy("reading_id").agg(F.sum("bikes").alias("bikes"))
    joined = tables["reading"].join(bikes, "reading_id").join(tables["station"], "station_id")
    total = F.col("bikes") + F.col("docks_free")
    return joined.filter(total < F.col("capacity")).select(
        "station_code", "station_name", "collected_at", "capacity", total.cast("bigint").alias("observed")
    )


def incomplete_children(readings: DataFrame, children: DataFrame, expected: int = 2) -> DataFrame:
    """Readings whose number of type rows differs from ``expected``, none included.

    The ids of both tables are counted by one grouping, without a sort; readings that have more columns meet only the ids that differ.
    """
    ids = readings.select("reading_id", F.lit(1).alias("own"), F.lit(0).alias("child")).unionByName(
        children.select("reading_id", F.lit(0).alias("own"), F.lit(1).alias("child"))).filter(F.col("reading_id").isNotNull())
    counted = ids.groupBy("reading_id").agg(F.sum("child").alias("n_children"), F.sum("own").alias("copies"))
    differ = counted.filter((F.col("copies") > 0) & (F.col("n_children") != expected))
    # a reading without an id has no type rows
    lost = readings.filter(F.col("reading_id").isNull()).withColumn("n_children", F.lit(0).cast("bigint")).filter(F.col("n_children") != expected)
    if readings.columns == ["reading_id"]:
        found = differ.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    else:
        found = readings.join(differ, "reading_id")
    return found.select(*lost.columns).unionByName(lost)


def missing_slots(df: DataFrame, time="collected_at", cadence="minute") -> DataFrame:
    """Expected and missing collections between the first and last, one per ``cadence`` unit."""
    slots = df.groupBy(F.date_trunc(cadence, time).alias("slot")).agg(F.lit(1).alias("one"))
    ends = slots.agg(F.min("slot").alias("first"), F.max("slot").alias("last"), F.count("slot").alias("seen"))
    expected = F.timestamp_diff(cadence.upper(), F.col("first"), F.col("last")) + 1
    return ends.select(
        expected.cast("bigint").alias("expected"), (expected - F.col("seen")).cast("bigint").alias("missing")
    )


def changed_without_update(readings: DataFrame) -> DataFrame:
    """Readings whose counts differ from the station's previous reading while its update time does not."""
    bundled = readings.withColumn(
        "bundle", F.struct("updated_at", "bikes_mechanical", "bikes_electric")
    )
    both = with_neighbours(bundled, "bundle", previous="p", following="f", current="c").filter(F.col("p").isNotNull())
    changed = ~F.col("c.bikes_mechanical").eqNullSafe(F.col("p.bikes_mechanical")) | ~F.col("c.bikes_electric").eqNullSafe(
        F.col("p.bikes_electric")
    )
    # only the ids of the changed rows meet the readings again
    return readings.join(both.filter((F.col("c.updated_at") == F.col("p.updated_at")) & changed).select("row_id"), "row_id", "left_semi")


def reference_changes(versions: DataFrame, attributes=("station_name", "capacity", "town_code")) -> DataFrame:
    """Codes whose attributes differ from the version before: code, version, old and new attributes."""
    coded = versions.filter(F.col("station_code").isNotNull())
    # one row per code and version, so a window never holds more rows than there are versions
    single = coded.groupBy("station_code", "version_ts").agg(F.max(F.struct(*attributes)).alias("now"))
    by_code = Window.partitionBy("station_code").orderBy("version_ts")
    compared = single.withColumn("was", F.lag("now").over(by_code))
    return compared.filter(F.col("was").isNotNull() & ~F.col("now").eqNullSafe(F.col("was"))).select(
        "station_code", "version_ts",
        *[F.col(f"was.{a}").alias(f"{a}_before") for a in attributes],
        *[F.col(f"now.{a}").alias(f"{a}_after") for a in attributes],
    )

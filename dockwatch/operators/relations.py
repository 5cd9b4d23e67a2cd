"""Joins between readings, dimensions and lists."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def enrich_latest(messages: DataFrame, newest: DataFrame) -> DataFrame:
    """Left join of flattened messages with the newest reference rows; unmatched messages are kept.

    Messages without a code cannot match, so whole collections without codes pass by the join.
    """
    attributes = newest.select(
        "station_code", "station_name", "capacity", "coordinates", "town_name", "town_code", F.lit(True).alias("matched")
    )
    coded = messages.filter(F.col("station_code").isNotNull()).join(attributes, "station_code", "left")
    lost = messages.filter(F.col("station_code").isNull())
    both = coded.unionByName(lost, allowMissingColumns=True)
    return both.withColumn("matched", F.coalesce("matched", F.lit(False)))


def unmatched_count(enriched: DataFrame) -> DataFrame:
    """Messages written and messages without a reference row, in one pass."""
    return enriched.agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(~F.col("matched")).alias("unmatched")
    )


def network_state(view: DataFrame, time="collected_at") -> DataFrame:
    """Every station at the latest collection of the whole network.

    The latest time is a scalar subquery: it is found first and then filters the scan.
    """
    return view.filter(F.col(time) == view.agg(F.max(time)).scalar())


def latest_state(tables: dict, zero_missing: bool = True) -> DataFrame:
    """Every station at the latest collection of the stored network, read from one day of the facts.

    The newest day comes from the partition column, the newest time from that day's readings; both are scalar
    subqueries that cut the facts before the flat view is built.
    """
    reading = tables["reading"]
    day = reading.agg(F.max("date")).scalar()
    time = reading.filter(F.col("date") == day).agg(F.max("collected_at")).scalar()
    cut = {
        "reading": reading.filter((F.col("date") == day) & (F.col("collected_at") == time)),
        "reading_bikes": tables["reading_bikes"].filter(F.col("date") == day),
    }
    return star_join({**tables, **cut}, zero_missing)


def without_readings(stations: DataFrame, readings: DataFrame) -> DataFrame:
    """Stations that have no reading."""
    return stations.join(readings.select("station_id").distinct(), "station_id", "left_anti")


def not_in_list(df: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null key is absent from the list; NULLs in the list are ignored."""
    known = listed.select(key).filter(F.col(key).isNotNull()).distinct()
    return df.filter(F.col(key).isNotNull()).join(known, key, "left_anti")


def group_with_zero(parents: DataFrame, children: DataFrame, key: str, child_id: str, summed: str,
                    count_as="stations", sum_as="docks") -> DataFrame:
    """Children counted and summed per parent; a parent without children counts 0 and sums to NULL.

    Children are reduced per key before the join, so only one row per parent is matched.
    """
    totals = children.groupBy(key).agg(F.count(child_id).alias(count_as), F.sum(summed).alias(sum_as))
    joined = parents.join(totals, key, "left")
    return joined.withColumn(count_as, F.coalesce(count_as, F.lit(0).cast("bigint")))


def update_from(df: DataFrame, source: DataFrame, keys, columns, when=None) -> DataFrame:
    """Take ``columns`` from the matching source row (optionally only where ``when`` holds)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    incoming = source.select(*keys, *[F.col(c).alias(f"new_{c}") for c in columns], F.lit(True).alias("has_new"))
    joined = df.join(incoming, keys, "left")
    applies = F.col("has_new").isNotNull()
    if when is not None:
        applies = applies & when
    return joined.select(
        *[F.when(applies, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def compare_on(before: DataFrame, after: DataFrame, keys, columns) -> DataFrame:
    """Same-key rows of two frames side by side: ``<column>_before`` and ``<column>_after``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    left = before.select(*keys, *[F.col(c).alias(f"{c}_before") for c in columns])
    right = after.select(*keys, *[F.col(c).alias(f"{c}_after") for c in columns])
    return left.join(right, keys)


def stack(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(DataFrame.unionByName, frames)


def distinct_keys(df: DataFrame, *columns) -> DataFrame:
    return df.select(*columns).distinct()


def _fact_key(table: DataFrame) -> list:
    """Facts stored by day are matched day by day, so that a filter on the day reaches both tables."""
    return ["date", "reading_id"] if "date" in table.columns else ["reading_id"]


def pivot_types(children: DataFrame, types: DataFrame, keep_null: bool = True) -> DataFrame:
    """Type rows back to one row per reading: mechanical and electric counts."""
    typed = children.join(types.select("bike_type_id", "type_code"), "bike_type_id")
    def total(code):
        return F.sum(F.when(F.col("type_code") == code, F.col("bikes")))
    out = typed.groupBy(*_fact_key(children)).agg(
        total("mechanical").alias("bikes_mechanical"), total("ebike").alias("bikes_electric"),
        F.sum("bikes").alias("bikes_total"),
    )
    return out if keep_null else out.fillna(0, ["bikes_mechanical", "bikes_electric"])


def unpivot_types(readings: DataFrame, ids) -> DataFrame:
    """Two rows per reading: type code and number of bikes."""
    values = [F.col("bikes_mechanical").alias("mechanical"), F.col("bikes_electric").alias("ebike")]
    return readings.select(*ids, *values).unpivot(ids, ["mechanical", "ebike"], "type_code", "bikes")


def star_join(tables: dict, zero_missing: bool = True) -> DataFrame:
    """Flat reading rows: reading -> station -> town, with the bike types in columns.

    A reading without type rows is kept. With ``zero_missing`` absent types count 0 (the reporting
    view); without it only the total does (the audit read-back). Facts stored by ``date`` keep it: a filter on the
    view's date then prunes both fact tables before they are joined.
    """
    key = _fact_key(tables["reading_bikes"]) if "date" in tables["reading"].columns else ["reading_id"]
    counts = pivot_types(tables["reading_bikes"], tables["bike_type"])
    flat = (
        tables["reading"].join(tables["station"], "station_id")
        .join(tables["town"].select("town_code", "town_name"), "town_code")
        .join(counts, key, "left")
    )
    split = ["bikes_mechanical", "bikes_electric"]
    return flat.fillna(0, ["bikes_total"] + (split if zero_missing else [])).select(
        *key, "collected_at", "updated_at", "station_id", "station_code", "station_name", "latitude", "longitude",
        "capacity", "town_code", "town_name", "bikes_total", *split, "docks_free", "is_installed",
    )

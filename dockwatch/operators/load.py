"""Dimensional load: towns, stations, readings and their type rows, without a MERGE statement."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from dockwatch import schemas as S
from dockwatch.functions import text as X
from dockwatch.operators.ordering import dedup, first_by, latest_by
from dockwatch.operators.relations import star_join, unpivot_types
from dockwatch.session import fixed_rows
from dockwatch.sources.lake import write_batch

STATION_COLUMNS = ["station_id", "station_code", "station_name", "latitude", "longitude", "capacity", "town_code"]
READING_COLUMNS = [
    "reading_id", "station_id", "collected_at", "updated_at", "docks_free", "is_installed", "is_renting", "is_returning",
]
# a reading id is the station id followed by 18 digits: microseconds since the start of the year 1
ID_TIME_DIGITS = 18
MICROS_TO_1970 = 62_135_596_800_000_000
READING_ID = "decimal(38,0)"


def seed_types(spark: SparkSession) -> DataFrame:
    """The two bike types."""
    return fixed_rows(spark, S.BIKE_TYPES, {"bike_type_id": "int", "type_code": "string", "type_label": "string"})


def insert_absent(target: DataFrame, new: DataFrame, key: str, order) -> DataFrame:
    """Target plus the new keys it lacks; known keys stay as they are."""
    first = first_by(new, [key], order)
    absent = first.join(target.select(key), key, "left_anti")
    return target.unionByName(absent.select(*target.columns))


def towns_of(staged: DataFrame) -> DataFrame:
    """Town rows seen in staged readings."""
    return staged.select(
        "town_code", "town_name", X.dept_of("town_code").alias("dept_code"),
        F.lit(None).cast("int").alias("population"), F.lit(None).cast("decimal(10,2)").alias("area_ha"),
    ).distinct()


def upsert_latest(target: DataFrame, new: DataFrame, key: str, order, columns) -> DataFrame:
    """Newest new row per key: inserted when the key is absent, else it replaces ``columns`` only.

    With a column ``seen_at`` (time of the row the values come from) a stored row is only replaced by one that is not
    older, so a batch that arrives late leaves newer values alone. The first of ``order`` is the time of a new row.
    """
    timed = "seen_at" in target.columns
    if timed:
        new = new.withColumn("seen_at", F.col(order[0]))
        columns = [*columns, "seen_at"]
    newest = latest_by(new.select(*dict.fromkeys([*target.columns, *order])), [key], order)
    incoming = newest.select(F.col(key), *[F.col(c).alias(f"new_{c}") for c in target.columns if c != key], F.lit(True).alias("has_new"))
    existing = target.withColumn("has_old", F.lit(True))
    merged = existing.join(incoming, key, "full_outer")

    def value(column):
        if column == key:
            return F.col(key)
        takes_new = F.col("has_old").isNull()
        if column in columns:
            takes_new = F.col("has_new").isNotNull()
            if timed:
                takes_new = takes_new & (F.col("seen_at").isNull() | (F.col("new_seen_at") >= F.col("seen_at")))
        return F.when(takes_new, F.col(f"new_{column}")).otherwise(F.col(column)).alias(column)

    return merged.select(*[value(c) for c in target.columns])


def batch_days(new: DataFrame) -> list:
    """Calendar days present in a batch: at most one driver value per day."""
    return [r[0] for r in new.select(F.to_date("collected_at")).distinct().collect()]


def insert_new_readings(target: DataFrame, new: DataFrame, order=("row_id",)) -> DataFrame:
    """Rows of ``new`` whose (station, collection) is not in the target yet, one row per key.

    When the target is partitioned by ``date`` only the days of the batch are read.
    """
    if "date" in target.columns:
        target = target.filter(F.col("date").isin(batch_days(new)))
    keys = ["station_id", "collected_at"]
    return dedup(new, keys, order).join(target.select(*keys), keys, "left_anti")


def insert_children(inserted: DataFrame, types: DataFrame, ids=("reading_id",)) -> DataFrame:
    """Type rows of inserted readings only: two per reading."""
    ids = list(ids)
    return unpivot_types(inserted, ids).join(types.select("bike_type_id", "type_code"), "type_code").select(
        ids[0], "bike_type_id", "bikes", *ids[1:]
    )


def with_reading_id(df: DataFrame) -> DataFrame:
    """Reproducible key: station id and collection time written one after the other in one decimal.

    Every BIGINT station id and every time of the years 1 to 9999, to the microsecond, has its own id; unlike a
    64-bit hash, two readings with different keys never meet. Only a reading without station or time has no id.
    """
    time = (F.unix_micros(F.col("collected_at").cast("timestamp")) + MICROS_TO_1970).cast(f"decimal({ID_TIME_DIGITS},0)")
    place = F.lit(f"1{'0' * ID_TIME_DIGITS}").cast(f"decimal({ID_TIME_DIGITS + 1},0)")
    station = F.col("station_id").cast("decimal(19,0)")
    return df.withColumn("reading_id", (station * place + time).cast(READING_ID))


def build_station_dim(valid_reference: DataFrame, seen: DataFrame) -> DataFrame:
    """Station dimension from the reference, so that stations without readings stay.

    Capacity is filtered before the latest version is chosen: an older usable version is kept
    when the newest one has capacity 0.
    """
    usable = valid_reference.filter((F.col("capacity") > 0) & F.col("station_code").isNotNull())
    columns = ["station_code", "version_ts", "station_name", "latitude", "longitude", "capacity", "town_code", "town_name"]
    newest = latest_by(usable.select(*columns), ["station_code"], ["version_ts", "station_name"])
    ids = seen.filter(F.col("station_code").isNotNull()).groupBy("station_code").agg(F.min("station_id").alias("station_id"))
    return newest.join(ids, "station_code").select(*STATION_COLUMNS, "town_name")


def build_town_dim(stations: DataFrame) -> DataFrame:
    """Distinct (code, name, department); a code with two names shows up in the key check."""
    return towns_of(stations)


def build_facts(clean: DataFrame, types: DataFrame, raw: DataFrame = None):
    """Readings and type rows from cleaned rows.

    The renting/returning flags travel with the cleaned rows; when they do not, they are taken
    from the raw rows by row id.
    """
    if raw is not None:
        flags = raw.select("row_id", X.flag01("is_renting").alias("is_renting"), X.flag01("is_returning").alias("is_returning"))
        clean = clean.drop("is_renting", "is_returning").join(flags, "row_id")
    numbered = with_reading_id(clean)
    return numbered.select(*READING_COLUMNS), insert_children(numbered, types)


def cascade_delete(tables: dict, station_ids: DataFrame) -> dict:
    """Delete stations with their readings and type rows."""
    gone = tables["reading"].join(station_ids.select("station_id"), "station_id", "left_semi").select("reading_id")
    return {
        **tables,
        "station": tables["station"].join(station_ids, "station_id", "left_anti"),
        "reading": tables["reading"].join(station_ids, "station_id", "left_anti"),
        "reading_bikes": tables["reading_bikes"].join(gone, "reading_id", "left_anti"),
    }


def flat_view(tables: dict) -> DataFrame:
    """The reporting view: one row per reading with station, town and both bike types, and the day of stored facts."""
    return star_join(tables, zero_missing=True)


def enrich_towns(towns: DataFrame, admin: DataFrame) -> DataFrame:
    """Fill population and surface from the administrative town file (code, population, area_ha)."""
    extra = admin.select(
        F.col("code").alias("town_code"), F.col("population").cast("int").alias("new_population"),
        F.col("surface").cast("decimal(10,2)").alias("new_area"),
    )
    return towns.join(extra, "town_code", "left").select(
        "town_code", "town_name", "dept_code",
        F.coalesce("new_population", "population").alias("population"), F.coalesce("new_area", "area_ha").alias("area_ha"),
    )


def station_from_feeds(information: DataFrame, reference: DataFrame) -> DataFrame:
    """Station dimension from the station-information feed, town code from the reference file."""
    towns = reference.filter(F.col("station_code").isNotNull()).groupBy("station_code").agg(F.max("town_code").alias("town_code"))
    feed = information.select(
        F.col("station_id").cast("bigint").alias("station_id"), F.col("stationCode").alias("station_code"),
        F.col("name").alias("station_name"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
        F.col("capacity").cast("bigint").alias("capacity"),
    )
    return feed.join(towns, "station_code", "left").select(*STATION_COLUMNS)


def record_run(spark: SparkSession, path: str, row: dict | DataFrame) -> None:
    """Add one line, or a frame of lines in one write, to the run log, kept by day of the run; a run recorded again replaces its own line."""
    if isinstance(row, DataFrame):
        lines = row.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.RUN_LOG])
        write_batch(lines.withColumn("date", F.to_date("started_at")), path, F.col("run_id"))
        return
    line = spark.createDataFrame([tuple(row[f.name] for f in S.RUN_LOG)], S.RUN_LOG).coalesce(1)
    write_batch(line.withColumn("date", F.to_date("started_at")), path, row["run_id"])


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run log; of a run recorded on several days the last line counts."""
    lines = spark.read.schema(S.RUN_LOG).parquet(path).select(S.RUN_LOG.fieldNames())
    return latest_by(lines, ["run_id"], ["started_at"])

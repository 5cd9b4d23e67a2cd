"""Typing of text rows into readings, validity split and run accounting."""

from pyspark.sql import DataFrame, Observation, functions as F

from dockwatch import schemas as S
from dockwatch.functions import text as X


def type_readings(df: DataFrame, zero_missing: bool = True) -> DataFrame:
    """Aggregated-zone text rows to typed readings.

    ``zero_missing`` counts an absent bike type as 0, as the live path does; the audited path
    keeps NULL and lets the repair rules impute it.
    """
    lat, lon = X.split_coords("coordinates")
    out = df.select(
        X.soft_int("station_id").alias("station_id"),
        F.trim("station_code").alias("station_code"),
        X.squash_ws("station_name").alias("station_name"),
        lat.alias("latitude"), lon.alias("longitude"),
        X.soft_int("capacity").alias("capacity"),
        X.pad_code("town_code").alias("town_code"),
        F.trim("town_name").alias("town_name"),
        X.iso_ts("collected_at").alias("collected_at"),
        X.epoch_ts("updated_at").alias("updated_at"),
        X.soft_int("bikes_mechanical").alias("bikes_mechanical"),
        X.soft_int("bikes_electric").alias("bikes_electric"),
        X.soft_int("docks_free").alias("docks_free"),
        X.flag01("is_installed").alias("is_installed"),
        X.flag01("is_renting").alias("is_renting"),
        X.flag01("is_returning").alias("is_returning"),
    )
    return fill_counts(out) if zero_missing else out


def fill_counts(df: DataFrame) -> DataFrame:
    """An absent count of a bike type means none of that type."""
    return df.fillna(0, ["bikes_mechanical", "bikes_electric"])


def type_raw(df: DataFrame) -> DataFrame:
    """Raw-zone text rows to typed readings, codes untouched and NULL counts kept."""
    return df.select(
        "row_id",
        X.soft_int("station_id").alias("station_id"), "station_code",
        X.iso_ts("collected_at").alias("collected_at"),
        X.epoch_ts("updated_at").alias("updated_at"),
        *[X.soft_int(c).alias(c) for c in ("bikes_total", "bikes_mechanical", "bikes_electric", "docks_free")],
        *[(F.col(c) == "1").alias(c) for c in ("is_installed", "is_renting", "is_returning")],
    )


REQUIRED = ["station_id", "collected_at", "updated_at", "town_code", "station_name", "latitude", "longitude", "is_installed"]


def is_valid():
    """Usable reading: mandatory fields present, capacity above zero, counts not negative."""
    condition = (F.col("capacity") > 0)
    for c in ("docks_free", "bikes_mechanical", "bikes_electric"):
        condition = condition & (F.col(c) >= 0)
    for c in REQUIRED:
        condition = condition & F.col(c).isNotNull()
    return F.coalesce(condition, F.lit(False))


def within_model():
    """Lengths, integer ranges and coordinates that the target tables accept, as one SQL condition."""
    town, station, reading = (S.TARGET_MODEL[t] for t in ("town", "station", "reading"))
    limits = {**town["max_length"], **station["max_length"], "town_code": town["exact_length"]["town_code"]}
    small = [*station["smallint"], *reading["smallint"], "bikes_mechanical", "bikes_electric"]
    parts = [f"length(rtrim({c})) <= {n}" for c, n in limits.items()]
    parts += [f"{c} BETWEEN -32768 AND 32767" for c in small]
    parts += [station["checks"]["latitude range"], station["checks"]["longitude range"]]
    return F.expr(" AND ".join(f"({p})" for p in parts))


def loadable():
    """Further conditions the target tables set: without them one bad row would fail a whole batch."""
    return F.coalesce(
        F.col("is_renting").isNotNull() & F.col("is_returning").isNotNull()
        & F.col("station_code").isNotNull() & F.col("town_name").isNotNull() & within_model(), F.lit(False)
    )


def silent(hours: int = 24):
    """The station had not reported for more than ``hours`` when it was polled."""
    return F.expr(silent_sql(hours))


def silent_sql(hours: int = 24) -> str:
    return f"updated_at < collected_at - INTERVAL {int(hours)} HOURS"


def reject_reason(drop_silent: bool = False):
    """Why a reading is refused, NULL when it is usable."""
    reason = F.when(~is_valid(), "invalid").when(~loadable(), "not loadable")
    return reason.when(F.coalesce(silent(), F.lit(False)), "silent") if drop_silent else reason


def split_valid(df: DataFrame, drop_silent: bool = False):
    """(usable readings, rejected readings with their reason)."""
    marked = df.withColumn("reason", reject_reason(drop_silent))
    return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())


def observe_run(df: DataFrame, name: str = "run", drop_silent: bool = False):
    """Count raw and rejected rows while the frame is consumed: (frame, observation)."""
    seen = Observation(name)
    rejected = F.count_if(reject_reason(drop_silent).isNotNull())
    return df.observe(seen, F.count(F.lit(1)).alias("rows_raw"), rejected.alias("rows_rejected")), seen


def run_counts(typed: DataFrame, loaded: DataFrame) -> DataFrame:
    """Raw, rejected, duplicate and loaded rows; what was loaded before counts as duplicate."""
    raw = typed.select(F.lit(1).alias("raw"), F.when(reject_reason().isNotNull(), 1).otherwise(0).alias("rejected"), F.lit(0).alias("loaded"))
    done = loaded.select(F.lit(0).alias("raw"), F.lit(0).alias("rejected"), F.lit(1).alias("loaded"))
    totals = raw.unionByName(done).agg(*[F.sum(c).alias(f"rows_{c}") for c in ("raw", "rejected", "loaded")])
    return totals.withColumn("rows_duplicate", F.col("rows_raw") - F.col("rows_rejected") - F.col("rows_loaded"))

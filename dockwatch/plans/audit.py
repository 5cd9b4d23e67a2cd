"""The eighteen quality checks: one pass for the row checks and one narrow pass per grouped check."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from dockwatch import schemas as S
from dockwatch.functions import text as X
from dockwatch.operators.ordering import order_by_rank, repeated_keys
from dockwatch.operators.relations import not_in_list
from dockwatch.plans.readings import silent_sql
from dockwatch.session import fixed_rows

RESULT_COLUMNS = ["phase", "check_id", "dimension", "label", "n_checked", "n_anomalies", "rate_pct"]


def late_update(minutes: int = S.CLOCK_TOLERANCE_MINUTES):
    """The station reports an update later than its collection."""
    return F.expr(late_update_sql(minutes))


def late_update_sql(minutes: int = S.CLOCK_TOLERANCE_MINUTES) -> str:
    return f"updated_at > collected_at + INTERVAL {int(minutes)} MINUTES"


OVER_CAPACITY = "bikes_total + docks_free > capacity"


def over_capacity():
    return F.expr(OVER_CAPACITY)


def _any_null(*columns):
    return " OR ".join(f"{c} IS NULL" for c in columns)


# check id -> (rows counted, anomaly), as SQL conditions; a NULL condition is never an anomaly
ROW_CHECKS = {
    "C1": ("true", _any_null("station_code")),
    "C2": ("true", _any_null("bikes_mechanical", "bikes_electric")),
    "C3": ("true", _any_null("station_name", "capacity", "latitude", "longitude", "town_code", "town_name")),
    "V1": ("capacity IS NOT NULL", "capacity <= 0"),
    "V2": ("true", "bikes_total < 0 OR bikes_mechanical < 0 OR bikes_electric < 0 OR docks_free < 0"),
    "V3": ("latitude IS NOT NULL", "latitude NOT BETWEEN {}D AND {}D OR longitude NOT BETWEEN {}D AND {}D".format(
        *S.LATITUDE_RANGE, *S.LONGITUDE_RANGE)),
    "V4": ("town_code IS NOT NULL", "NOT rlike(town_code, r'^\\d{{5}}$') OR left(town_code, 2) NOT IN ({})".format(
        ", ".join(f"'{d}'" for d in S.DEPARTMENTS))),
    "V5": ("station_name IS NOT NULL", r"station_name <> trim(station_name) OR rlike(station_name, r'\s{2,}')"),
    "V6": ("true", late_update_sql()),
    "K1": ("bikes_mechanical IS NOT NULL AND bikes_electric IS NOT NULL", "bikes_total <> bikes_mechanical + bikes_electric"),
    "K2": ("capacity IS NOT NULL", OVER_CAPACITY),
    "K3": ("true", silent_sql(S.SILENT_HOURS)),
    "I2": ("true", _any_null("station_id", "station_code", "town_code")),
}


def _row_results(df: DataFrame) -> DataFrame:
    counts = []
    for check, (rows, bad) in ROW_CHECKS.items():
        counts += [F.expr(f"count_if({rows}) AS {check}_n"), F.expr(f"count_if({bad}) AS {check}_bad")]
    return _unfold(df.agg(*counts), list(ROW_CHECKS))


def _unfold(counted: DataFrame, ids) -> DataFrame:
    """One wide row of <id>_n / <id>_bad columns to one row per check."""
    rows = ", ".join(f"'{i}', CAST({i}_n AS BIGINT), CAST({i}_bad AS BIGINT)" for i in ids)
    return counted.selectExpr(f"stack({len(ids)}, {rows}) AS (check_id, n_checked, n_anomalies)")


def _collection_results(df: DataFrame, cadence: str) -> DataFrame:
    """U1 and C4 in one shuffle: distinct (station, collection) first, then their time slots."""
    tuples = df.groupBy("station_id", "collected_at").agg(F.count(F.lit(1)).alias("n"))
    slots = tuples.groupBy(F.date_trunc(cadence, "collected_at").alias("slot")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("tuples")
    )
    ends = slots.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("U1_n"),
        F.coalesce(F.sum("n") - F.sum("tuples"), F.lit(0)).alias("U1_bad"),
        F.coalesce(F.timestamp_diff(cadence.upper(), F.min("slot"), F.max("slot")) + 1, F.lit(0)).alias("C4_n"),
        F.count("slot").alias("seen"),
    )
    return _unfold(ends.withColumn("C4_bad", F.col("C4_n") - F.col("seen")), ["U1", "C4"])


def _code_results(df: DataFrame, reference_codes: DataFrame) -> DataFrame:
    """U2 and I1 from one list of (code, station id) pairs."""
    pairs = df.filter(F.col("station_code").isNotNull()).groupBy("station_code", "station_id").agg(F.count(F.lit(1)).alias("n"))
    codes = pairs.groupBy("station_code").agg(F.count("station_id").alias("ids"), F.sum("n").alias("n"))
    known = reference_codes.select("station_code").filter(F.col("station_code").isNotNull()).distinct()
    marked = codes.join(known.withColumn("known", F.lit(True)), "station_code", "left")
    return _unfold(
        marked.agg(
            F.count(F.lit(1)).alias("U2_n"), F.count_if(F.col("ids") > 1).alias("U2_bad"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("I1_n"),
            F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("I1_bad"),
        ),
        ["U2", "I1"],
    )


def _town_results(df: DataFrame) -> DataFrame:
    """K4: town codes with more than one name."""
    pairs = df.filter(F.col("town_code").isNotNull()).groupBy("town_code", "town_name").agg(F.lit(1).alias("one"))
    names = pairs.groupBy("town_code").agg(F.count("town_name").alias("names"))
    return _unfold(names.agg(F.count(F.lit(1)).alias("K4_n"), F.count_if(F.col("names") > 1).alias("K4_bad")), ["K4"])


def catalogue(spark: SparkSession) -> DataFrame:
    """The check catalogue."""
    columns = ("check_id", "dimension", "label", "criticality", "target", "action")
    return fixed_rows(spark, S.CHECKS, dict.fromkeys(columns, "string"))


def audit(df: DataFrame, reference_codes: DataFrame, phase: str, cadence: str = "minute") -> DataFrame:
    """All eighteen checks of one phase, one row each.

    The frame is read four times, each time with the few columns that pass needs: hand in a
    stored table rather than a plan that recomputes its joins.
    """
    results = (
        _row_results(df).unionByName(_collection_results(df, cadence))
        .unionByName(_code_results(df, reference_codes)).unionByName(_town_results(df))
    )
    labels = catalogue(df.sparkSession).select("check_id", "dimension", "label")
    return results.join(labels, "check_id").select(
        F.lit(phase).alias("phase"), "check_id", "dimension", "label", "n_checked", "n_anomalies",
        X.pct("n_anomalies", "n_checked").alias("rate_pct"),
    )


def add_catalogue(results: DataFrame) -> DataFrame:
    """Criticality, target and verdict for each result."""
    joined = results.join(catalogue(results.sparkSession).drop("dimension", "label"), "check_id")
    passed = (
        F.when(F.col("target") == "0", F.col("n_anomalies") == 0)
        .when(F.col("target") == "< 5 %", F.coalesce(F.col("rate_pct") < 5, F.lit(True)))
        .otherwise(F.lit(None).cast("boolean"))  # measured only
    )
    return joined.withColumn("passed", passed)


def compare_phases(before: DataFrame, after: DataFrame) -> DataFrame:
    """Before/after table in dimension order, with the outcome of each check."""
    left = before.select("check_id", "dimension", "label", F.col("n_anomalies").alias("anomalies_before"),
                         F.col("rate_pct").alias("rate_before"))
    right = after.select("check_id", F.col("n_anomalies").alias("anomalies_after"), F.col("rate_pct").alias("rate_after"))
    joined = left.join(right, "check_id").withColumn("status", X.compare_status("anomalies_before", "anomalies_after"))
    return order_by_rank(joined, "dimension", S.DIMENSION_ORDER, "check_id")


def _several(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows whose non-null key occurs with more than one value; keys are reduced before they are matched."""
    keys = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias("lo"), F.max(value).alias("hi")).filter("lo <> hi")
    return df.join(keys.select(key), key, "left_semi")


def failing_rows(df: DataFrame, check_id: str, reference_codes: DataFrame = None) -> DataFrame:
    """The rows that one check on rows or groups counts (of repeated readings those after the lowest row id)."""
    if check_id in ROW_CHECKS:
        return df.filter(F.coalesce(F.expr(ROW_CHECKS[check_id][1]), F.lit(False)))
    if check_id == "U1":
        keys = ["station_id", "collected_at"]
        return df.join(repeated_keys(df, keys), keys).filter(F.col("row_id") > F.col("kept_id")).select(df.columns)
    if check_id == "U2":
        return _several(df, "station_code", "station_id")
    if check_id == "K4":
        return _several(df, "town_code", "town_name")
    if check_id == "I1":
        return not_in_list(df, reference_codes, "station_code")
    raise ValueError(f"{check_id} does not count rows")


def anomaly_breakdown(df: DataFrame, check_id: str, by, reference_codes: DataFrame = None, cadence: str = "minute") -> DataFrame:
    """Where and when a check fails: rows, stations and largest excess per group.

    C4 counts what is not there: missing collections per ``day``, without stations. I1 needs the reference.
    """
    if check_id == "C4":
        slots = df.select(F.date_trunc(cadence, "collected_at").cast("timestamp_ntz").alias("slot")).distinct()
        span = slots.agg(F.min("slot").alias("a"), F.max("slot").alias("b"))
        every = span.select(F.explode(F.expr(f"sequence(a, b, INTERVAL 1 {cadence.upper()})")).alias("slot"))
        missing = every.join(slots, "slot", "left_anti").groupBy(F.to_date("slot").alias("day")).agg(F.count(F.lit(1)).alias("n_readings"))
        return missing.select("day", "n_readings", F.lit(0).cast("bigint").alias("n_stations"), F.lit(None).cast("bigint").alias("max_excess"))
    excess = F.col("bikes_total") + F.col("docks_free") - F.col("capacity")
    failing = failing_rows(df, check_id, reference_codes)
    per_station = failing.groupBy(*dict.fromkeys([*by, "station_id"])).agg(F.count(F.lit(1)).alias("n"), F.max(excess).alias("excess"))
    return per_station.groupBy(*by).agg(
        F.sum("n").alias("n_readings"), F.count("station_id").alias("n_stations"), F.max("excess").alias("max_excess")
    )

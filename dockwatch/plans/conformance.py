"""Load of the repaired readings into the target model, read-back, and base-to-base comparison."""

from pyspark.sql import DataFrame, functions as F

from dockwatch.functions import text as X
from dockwatch.operators import constraints, load
from dockwatch.operators.aggregates import incomplete_children
from dockwatch.operators.relations import star_join, without_readings
from dockwatch.plans.audit import audit, compare_phases, late_update
from dockwatch.plans.cleaning import Repair, journal, repair
from dockwatch.plans.readings import silent
from dockwatch.schemas import MIN_NAMED_ROWS
from dockwatch.session import fixed_rows, materialise


def target_tables(result: Repair, clean: DataFrame = None) -> dict:
    """The five target tables from a repair run."""
    clean = result.clean if clean is None else clean
    spark = clean.sparkSession
    types = load.seed_types(spark)
    seen = result.flagged.filter(~F.col("r3b")).select("station_id", "station_code")
    # a dimension, used by the stations, the towns and every key check
    stations = materialise(load.build_station_dim(result.valid_reference, seen), "stations")
    reading, reading_bikes = load.build_facts(clean, types)
    return {
        "town": load.build_town_dim(stations),
        "station": stations.select(*load.STATION_COLUMNS),
        "bike_type": types,
        "reading": reading,
        "reading_bikes": reading_bikes,
    }


def read_back(tables: dict) -> DataFrame:
    """Readings as the audit sees them after the load."""
    return star_join(tables, zero_missing=False)


# indicators compared between two bases, in report order
INDICATORS = [
    "Readings", "Stations", "Towns", "Distinct collections", "Readings without both type rows",
    "Stations without any reading", "Readings of silent stations (> 24 h)", "Readings updated after their collection",
    "Station names with extra spaces",
]


def base_indicators(tables: dict, until=None) -> DataFrame:
    """Nine figures of one base; ``until`` bounds the readings by collection time (a Column or value)."""
    readings = tables["reading"]
    if until is not None:
        readings = readings.filter(F.col("collected_at") <= until)

    def one(position, frame):
        return frame.select(F.lit(position + 1).alias("position"), F.col("n").cast("bigint").alias("n"))

    def count(frame):
        return frame.agg(F.count(F.lit(1)).alias("n"))

    flags = readings.agg(
        F.count(F.lit(1)).alias("all"), F.count_if(silent()).alias("silent"), F.count_if(late_update()).alias("late")
    )
    # the three counts over the readings share one pass
    shared = flags.selectExpr("stack(3, 1, `all`, 7, silent, 8, late) AS (position, n)")
    station = tables["station"]
    parts = [
        one(1, count(station)),
        one(2, count(tables["town"])),
        one(3, count(readings.select("collected_at").distinct())),
        one(4, count(incomplete_children(readings.select("reading_id"), tables["reading_bikes"]))),
        one(5, count(without_readings(station, readings))),
        one(8, station.agg(F.count_if(X.has_extra_ws("station_name")).alias("n"))),
    ]
    out = shared
    for part in parts:
        out = out.unionByName(part)
    return out


def base_vs_base(live: dict, repaired: dict, until) -> DataFrame:
    """Nine indicators of the live and the repaired base over the same period, with the difference.

    ``until`` (a Column or value) ends the period on both sides: the latest collection that both have had the chance to load.
    """
    spark = live["station"].sparkSession
    labels = fixed_rows(spark, enumerate(INDICATORS, 1), {"position": "int", "indicator": "string"})
    both = base_indicators(live, until).select("position", F.col("n").alias("live"), F.lit(0).cast("bigint").alias("repaired")).unionByName(
        base_indicators(repaired, until).select("position", F.lit(0).cast("bigint").alias("live"), F.col("n").alias("repaired"))
    ).groupBy("position").agg(F.sum("live").alias("live"), F.sum("repaired").alias("repaired"))
    return both.join(labels, "position").select(
        "position", "indicator", "live", "repaired", (F.col("repaired") - F.col("live")).alias("difference")
    ).orderBy("position")


def audit_path(before: DataFrame, reference: DataFrame, min_named: int = MIN_NAMED_ROWS, cadence: str = "minute") -> dict:
    """Audit, repair, load with constraint check, re-audit and comparison; ``before`` is a stored table."""
    result = repair(before, reference, min_named)
    clean = materialise(result.clean, "clean")
    tables = target_tables(result, clean)
    constraints.require_valid(tables)
    after = materialise(read_back(tables), "after")
    first = audit(before, reference, "before", cadence)
    second = audit(after, reference, "after", cadence)
    return {
        "clean": clean, "tables": tables, "journal": journal(result, clean, min_named),
        "before": first, "after": second, "comparison": compare_phases(first, second),
    }

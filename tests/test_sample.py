"""Golden figures of the small real sample: 4 towns, 12 stations, 2 collections."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from dockwatch.operators import constraints, load
from dockwatch.operators.aggregates import under_capacity
from dockwatch.operators.ordering import latest_per_key
from dockwatch.operators.relations import group_with_zero, star_join

# fixed values: station id, code, capacity, town, then free docks, mechanical and electric at both collections
SAMPLE = [
    (37420, "10003", 17, "75056", 12, 2, 2, 12, 2, 2),
    (221032834, "10004", 48, "75056", 35, 8, 4, 35, 8, 4),
    (37521, "10005", 17, "75056", 2, 10, 3, 2, 10, 3),
    (37903195, "21001", 27, "92012", 6, 18, 0, 6, 18, 0),
    (102328355, "21002", 20, "92012", 13, 5, 2, 14, 4, 2),
    (95927849, "21003", 39, "92012", 31, 5, 2, 31, 5, 2),
    (80419347, "31001", 27, "93048", 0, 15, 12, 0, 15, 12),
    (129144878, "31003", 30, "93048", 20, 1, 9, 23, 0, 7),
    (213894629, "31005", 45, "93048", 20, 1, 23, 20, 1, 23),
    (102333275, "21301", 34, "92040", 23, 11, 0, 23, 11, 0),
    (102335085, "21302", 25, "92040", 16, 6, 2, 16, 6, 2),
    (37504995, "21303", 32, "92040", 7, 22, 3, 7, 22, 3),
]
FIRST, SECOND = datetime(2026, 9, 24, 8, 16, 38), datetime(2026, 9, 24, 8, 18, 41)


@pytest.fixture(scope="module")
def tables(spark):
    towns = spark.createDataFrame([("75056", "A"), ("92012", "B"), ("93048", "C"), ("92040", "D")], "town_code string, town_name string")
    stations = spark.createDataFrame(
        [(i, c, f"Stop {c}", 48.8, 2.3, cap, t) for i, c, cap, t, *_ in SAMPLE],
        "station_id long, station_code string, station_name string, latitude double, longitude double, capacity long, town_code string")
    flat = [(s[0], at, *s[k:k + 3]) for s in SAMPLE for at, k in ((FIRST, 4), (SECOND, 7))]
    feed = spark.createDataFrame(flat, "station_id long, collected_at timestamp, docks_free long, bikes_mechanical long, bikes_electric long")
    feed = feed.withColumn("updated_at", F.col("collected_at")).withColumns({f: F.lit(True) for f in ("is_installed", "is_renting", "is_returning")})
    types = load.seed_types(spark)
    reading, children = load.build_facts(feed, types)
    return {"town": load.towns_of(towns), "station": stations, "bike_type": types, "reading": reading, "reading_bikes": children}


def test_sizes_and_constraints(tables):
    assert {n: t.count() for n, t in tables.items()} == {"town": 4, "station": 12, "bike_type": 2, "reading": 24, "reading_bikes": 48}
    constraints.require_valid(tables)


def test_stations_per_town(tables):
    got = group_with_zero(tables["town"], tables["station"], "town_code", "station_id", "capacity")
    assert {r.town_code: (r.stations, r.docks) for r in got.collect()} == {
        "75056": (3, 82), "92012": (3, 86), "93048": (3, 102), "92040": (3, 91)}


def test_latest_readings(tables):
    latest = latest_per_key(star_join(tables), "station_id", "collected_at").collect()
    assert len(latest) == 12 and {r.collected_at for r in latest} == {SECOND}
    assert sum(r.bikes_mechanical for r in latest) == 102
    assert sum(r.bikes_electric for r in latest) == 60
    assert sum(r.docks_free for r in latest) == 189


def test_under_capacity(tables):
    got = under_capacity(tables).collect()
    assert {(r.station_code, r.observed) for r in got} == {
        ("10003", 16), ("10004", 47), ("10005", 15), ("21001", 24), ("21003", 38), ("21302", 24), ("31005", 44)}
    assert len(got) == 14


def test_cascade_delete(spark, tables):
    left = load.cascade_delete(tables, spark.createDataFrame([(37420,)], "station_id long"))
    assert {n: left[n].count() for n in ("station", "reading", "reading_bikes")} == {"station": 11, "reading": 22, "reading_bikes": 44}

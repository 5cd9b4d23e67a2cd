from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dockwatch.operators import load
from dockwatch.plans import readings as R
from tests.conftest import rows

T0 = datetime(2024, 1, 1)


def test_insert_absent_keeps_known(spark):
    columns = "town_code string, town_name string"
    known = spark.createDataFrame([("75001", "Old")], columns)
    new = spark.createDataFrame([("75001", "New"), ("75002", "B"), ("75002", "A")], columns)
    assert rows(load.insert_absent(known, new, "town_code", ["town_name"])) == [("75001", "Old"), ("75002", "A")]


def test_upsert_updates_only_listed_columns(spark):
    target = spark.createDataFrame([(1, "A", 10), (2, "B", 20)], "station_id long, station_code string, capacity long")
    new = spark.createDataFrame([(1, "X", 11, T0), (1, "Y", 12, T0 + timedelta(days=1)), (3, "C", 30, T0)],
                                "station_id long, station_code string, capacity long, collected_at timestamp")
    once = load.upsert_latest(target, new, "station_id", ["collected_at"], ["capacity"])
    expected = [(1, "A", 12), (2, "B", 20), (3, "C", 30)]
    assert rows(once) == expected
    assert rows(load.upsert_latest(once, new, "station_id", ["collected_at"], ["capacity"])) == expected


def test_insert_new_readings(spark):
    columns = "row_id long, station_id long, collected_at timestamp"
    target = spark.createDataFrame([(1, 1, T0)], columns).withColumn("date", F.to_date("collected_at"))
    new = spark.createDataFrame([(5, 1, T0), (7, 2, T0), (6, 2, T0), (8, 1, T0 + timedelta(days=3))], columns)
    assert rows(load.insert_new_readings(target, new), "row_id") == [(6,), (8,)]


def test_reading_ids(spark):
    """Every station id and microsecond has an id of its own; only a missing part gives none."""
    ends = [0, 5, -1, 1 << 30, 5_000_000_000, (1 << 63) - 1, -(1 << 63)]
    times = [T0, T0 + timedelta(microseconds=1), datetime(1, 1, 2), datetime(9999, 12, 30, 23, 59, 59, 999999), datetime(1969, 12, 31, 23, 59, 59)]
    data = [(s, t) for s in ends for t in times] + [(None, T0), (5, None)]
    got = load.with_reading_id(spark.createDataFrame(data, "station_id long, collected_at timestamp_ntz")).collect()
    ids = [int(r.reading_id) for r in got[:-2]]
    assert len(set(ids)) == len(ids) and [r.reading_id for r in got[-2:]] == [None, None]
    micros = (T0 - datetime(1, 1, 1)) // timedelta(microseconds=1)
    assert ids[0] == micros and ids[len(times)] == 5 * 10**18 + micros


def test_late_rows_leave_newer_attributes(spark):
    target = spark.createDataFrame([(1, "old", T0 + timedelta(days=5)), (2, "old", None)], "station_id long, station_name string, seen_at timestamp")
    new = spark.createDataFrame([(1, "late", T0), (2, "first", T0), (3, "new", T0)], "station_id long, station_name string, collected_at timestamp")
    once = load.upsert_latest(target, new, "station_id", ["collected_at"], ["station_name"])
    assert rows(once.select("station_id", "station_name")) == [(1, "old"), (2, "first"), (3, "new")]
    later = new.withColumn("collected_at", F.lit(T0 + timedelta(days=6))).withColumn("station_name", F.lit("newest"))
    assert rows(load.upsert_latest(once, later, "station_id", ["collected_at"], ["station_name"]).select("station_name")) == [("newest",)] * 3


def test_station_dim_keeps_older_usable_version(spark):
    reference = spark.createDataFrame(
        [("A", T0, "S", 1.0, 2.0, 20, "75001", "T"), ("A", T0 + timedelta(days=1), "S", 1.0, 2.0, 0, "75001", "T"), ("B", T0, "S", 1.0, 2.0, 0, "75001", "T")],
        "station_code string, version_ts timestamp, station_name string, latitude double, longitude double, capacity long, town_code string, town_name string")
    seen = spark.createDataFrame([(1, "A"), (1, "A"), (2, "B"), (3, None)], "station_id long, station_code string")
    assert rows(load.build_station_dim(reference, seen), "station_id", "station_code", "capacity") == [(1, "A", 20)]


GOOD = dict(station_id="1", station_code="A", station_name="S", coordinates="48.8, 2.3", capacity="10", town_code="75001", town_name="T",
            collected_at="2024-01-01T00:00:00+00:00", updated_at="1704067200", bikes_mechanical="1", bikes_electric="2", docks_free="3",
            is_installed="1", is_renting="1", is_returning="1")


@pytest.mark.parametrize("change, reason", [
    ({}, None), ({"station_id": "x"}, "invalid"), ({"collected_at": "bad"}, "invalid"), ({"updated_at": None}, "invalid"),
    ({"town_code": ""}, "invalid"), ({"station_name": None}, "invalid"), ({"coordinates": "48.8"}, "invalid"), ({"coordinates": ""}, "invalid"),
    ({"capacity": "0"}, "invalid"), ({"capacity": None}, "invalid"), ({"docks_free": "-1"}, "invalid"), ({"docks_free": None}, "invalid"),
    ({"bikes_mechanical": "-1"}, "invalid"), ({"bikes_electric": "-1"}, "invalid"), ({"is_installed": None}, "invalid"),
    ({"bikes_mechanical": None}, None), ({"is_renting": None}, "not loadable"), ({"is_returning": ""}, "not loadable"),
    ({"station_code": None}, "not loadable"), ({"station_code": "c" * 11}, "not loadable"), ({"station_name": "n" * 151}, "not loadable"),
    ({"town_name": "t" * 101}, "not loadable"), ({"town_code": "750561"}, None), ({"capacity": "40000"}, "not loadable"),
    ({"docks_free": "40000"}, "not loadable"), ({"bikes_electric": "40000"}, "not loadable"), ({"coordinates": "95.0, 2.3"}, "not loadable"),
])
def test_validity(spark, change, reason):
    row = {**GOOD, **change}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))
    good, bad = R.split_valid(R.type_readings(df))
    assert [r.reason for r in bad.collect()] == ([reason] if reason else [])
    assert good.count() == (0 if reason else 1)

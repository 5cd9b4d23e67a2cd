"""Audit by day against the audit of everything."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dockwatch.plans import audit_state as A
from dockwatch.plans.audit import audit
from dockwatch.sources import lake
from tests.conftest import rows

COLUMNS = ("row_id long, station_id long, station_code string, collected_at timestamp_ntz, updated_at timestamp_ntz, bikes_total long, bikes_mechanical long, "
           "bikes_electric long, docks_free long, station_name string, capacity long, latitude double, longitude double, town_code string, town_name string")


def reading(i, day=1, minute=0, station=1, code="A", town="75001", name="Town", **change):
    at = None if day is None else datetime(2024, 1, day, 0, minute)
    row = dict(row_id=i, station_id=station, station_code=code, collected_at=at, updated_at=at, bikes_total=3, bikes_mechanical=2, bikes_electric=1, docks_free=4,
               station_name="S", capacity=10, latitude=48.8, longitude=2.3, town_code=town, town_name=name)
    return tuple({**row, **change}.values())


READINGS = [
    reading(1, 1, 0), reading(2, 1, 0), reading(3, 1, 7, code="B", station=2), reading(4, 1, 7, code=None, station=None),
    reading(5, 3, 0, code="A", station=9), reading(6, 3, 1, code="Z", name="Other"), reading(7, 3, 1, bikes_electric=None, capacity=0),
    reading(8, 4, 2, code="A", station=None), reading(9, 4, 2, code="A", station=None), reading(10, 2, 5, town="99", name=None),
    reading(11, None), reading(12, None), reading(13, 6, 59, updated_at=datetime(2024, 1, 8), docks_free=-1, latitude=1.0),
]
CODES = [("A",), ("B",), (None,)]


@pytest.fixture
def base(spark):
    return spark.createDataFrame(READINGS, COLUMNS), spark.createDataFrame(CODES, "station_code string")


def stored(spark, df, root, label):
    dated = df.withColumn("date", F.to_date("collected_at"))
    lake.write_batch(dated, f"{root}/rows", label)
    return lake.read_batches(spark, f"{root}/rows", dated).drop("batch")


def results(df):
    return rows(df, "check_id", "n_checked", "n_anomalies", "rate_pct")


@pytest.mark.parametrize("cadence", ["minute", "hour"])
def test_days_in_any_order_late_and_again(spark, base, tmp_path, cadence):
    df, codes = base
    days = [date(2024, 1, d) for d in (3, 1, 6, 2, 4)] + [None]
    path = f"{tmp_path}/states"
    late = df.filter("row_id IN (2, 5)")
    held = stored(spark, df.filter("row_id NOT IN (2, 5)"), tmp_path, "a")
    for day in days:
        A.audit_days(held, [day], path, cadence)
    first = A.audit_from_states(A.read_states(spark, path), codes, "p", cadence)
    assert results(first) == results(audit(df.filter("row_id NOT IN (2, 5)"), codes, "p", cadence))
    held = stored(spark, late, tmp_path, "b")
    for day in (date(2024, 1, 1), date(2024, 1, 3), date(2024, 1, 3), date(2024, 1, 4)):
        A.audit_days(held, [day], path, cadence)
    whole = audit(df, codes, "p", cadence)
    assert results(A.audit_from_states(A.read_states(spark, path), codes, "p", cadence)) == results(whole)
    assert {r.check_id: r.n_anomalies for r in whole.collect()}["U2"] == 1
    assert A.audit_from_states(A.read_states(spark, path), codes, "p", cadence).columns == whole.columns


def test_only_the_given_day_is_read(spark, base, tmp_path):
    df, _ = base
    held = stored(spark, df, tmp_path, "a")
    for file in (tmp_path / "rows/date=2024-01-03").rglob("*.parquet"):
        file.write_bytes(b"no parquet")
    A.audit_days(held, [date(2024, 1, 1)], f"{tmp_path}/states")
    assert {r.date for r in A.read_states(spark, f"{tmp_path}/states").collect()} == {date(2024, 1, 1)}
    with pytest.raises(Exception):
        A.audit_days(held, [date(2024, 1, 3)], f"{tmp_path}/states")


def test_a_day_that_lost_its_readings_and_an_empty_base(spark, base, tmp_path):
    df, codes = base
    held, path = stored(spark, df, tmp_path, "a"), f"{tmp_path}/states"
    A.audit_days(held, [date(2024, 1, d) for d in (1, 2, 3)], path)
    A.audit_days(held.filter("date <> DATE '2024-01-03'"), [date(2024, 1, 3), date(2024, 1, 30)], path)
    left = df.filter("to_date(collected_at) <= DATE '2024-01-02'")
    assert results(A.audit_from_states(A.read_states(spark, path), codes, "p")) == results(audit(left, codes, "p"))
    nothing = A.audit_from_states(spark.createDataFrame([], A.STATE), codes, "p")
    assert results(nothing) == results(audit(df.limit(0), codes, "p"))

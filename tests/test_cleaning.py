from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dockwatch.contract import derived as D
from dockwatch.operators import constraints
from dockwatch.plans import cleaning as C, conformance as L
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1, 12)
COLUMNS = ("row_id long, station_id long, station_code string, collected_at timestamp, updated_at timestamp, bikes_total long, "
           "bikes_mechanical long, bikes_electric long, docks_free long, is_installed boolean, is_renting boolean, is_returning boolean, station_name string")


def reading(i, station=1, code="A", at=0, updated=None, total=5, mech=3, elec=2, docks=4, name="Stop"):
    collected = T0 + timedelta(minutes=at)
    return (i, station, code, collected, collected if updated is None else T0 + timedelta(minutes=updated), total, mech, elec, docks, True, True, True, name)


def work(spark, data):
    return C.r0_working_set(spark.createDataFrame(data, COLUMNS))


def test_r1_needs_more_than_half(spark):
    half = work(spark, [reading(1, 1, updated=50), reading(2, 2)])
    assert rows(C.late_collections(half)) == []
    most = work(spark, [reading(1, 1, updated=50), reading(2, 2, updated=40), reading(3, 3)])
    moved = C.r1_clock(most)
    assert {r.collected_at for r in moved.collect()} == {T0 + timedelta(minutes=50)}
    assert all(r.r1 for r in moved.collect())


def test_r1_collision_is_left_to_r9(spark):
    df = work(spark, [reading(1, 1, at=0, updated=30), reading(2, 1, at=30)])
    moved = C.r1_clock(df)
    assert moved.select("collected_at").distinct().count() == 1
    assert rows(C.r9_dedup(moved), "row_id") == [(1,)]


def test_r2(spark):
    out = C.r2_code(work(spark, [reading(1, 1, "A"), reading(2, 1, None, at=1), reading(3, 2, None)]))
    assert rows(out, "row_id", "station_code", "r2") == [(1, "A", False), (2, "A", True), (3, None, False)]


@pytest.mark.parametrize("data, expected", [
    ([reading(1), reading(2, at=1, mech=None, elec=None, total=9)], (7, 2, True)),                       # previous
    ([reading(2, mech=None, elec=None, total=9), reading(3, at=1, elec=4)], (5, 4, True)),                # next
    ([reading(1, elec=8), reading(2, at=1, mech=None, elec=None, total=3)], (0, 3, True)),               # capped
    ([reading(1, mech=None, elec=None), reading(2, at=1, mech=None, elec=None)], (None, None, False)),   # no donor
    ([reading(1), reading(2, at=1, mech=None, elec=2)], (None, 2, False)),                               # electric known
    ([reading(1), reading(2, at=1, mech=None, elec=None, total=None)], (None, 2, True)),                 # unknown total
])
def test_r3(spark, data, expected):
    out = {r.row_id: r for r in C.r3_impute(work(spark, data)).collect()}[2]
    assert (out.bikes_mechanical, out.bikes_electric, out.r3a) == expected


def test_deletes_keep_unknowns(spark):
    df = spark.createDataFrame([(1, 0), (2, None), (3, 5)], "row_id long, capacity long")
    assert rows(C.r6_capacity(df), "row_id") == [(2,), (3,)]
    times = spark.createDataFrame([(1, T0, T0 - timedelta(hours=24)), (2, T0, T0 - timedelta(hours=24, seconds=1)), (3, T0, None)],
                                  "row_id long, collected_at timestamp, updated_at timestamp")
    assert rows(C.r7_silent(times), "row_id") == [(1,), (3,)]


@pytest.fixture(scope="module")
def repaired(spark):
    before = D.before(spark, SF, stored=True)
    reference = D.versions(spark, SF)
    return before, reference, L.audit_path(before, reference, D.MIN_NAMED, cadence="hour")


def test_journal_and_balance(repaired):
    before, _, out = repaired
    counts = {r.rule.split(" ")[0] + r.action[:3]: r.n_rows for r in out["journal"].collect()}
    assert counts == {"R1cor": 23, "R2sub": 11, "R3imp": 11, "R3del": 0, "R4del": 45, "R4sub": 105, "R5cor": 60, "R6del": 60,
                      "R7del": 0, "R8del": 0, "R9del": 46, "K2non": 443}
    assert before.count() - 60 - 46 == out["clean"].count() == 894


def test_checks_before_and_after(repaired):
    _, _, out = repaired
    before = {r.check_id: (r.n_checked, r.n_anomalies) for r in out["before"].collect()}
    assert len(before) == 18
    assert {c: before[c][1] for c in ("C1", "C2", "C3", "U1", "V1", "V5", "V6", "K1", "K2", "K3", "I2")} == {
        "C1": 11, "C2": 11, "C3": 105, "U1": 49, "V1": 49, "V5": 49, "V6": 23, "K1": 0, "K2": 468, "K3": 59, "I2": 105}
    assert before["V1"][0] == 895
    after = {r.check_id: r.n_anomalies for r in out["after"].collect()}
    assert all(after[c] == 0 for c in after if c not in ("C4", "K2"))


def test_clean_is_a_fixed_point(spark, repaired):
    _, reference, out = repaired
    again = C.repair(out["clean"].withColumn("version_ts", F.lit(None).cast("timestamp_ntz")), reference, D.MIN_NAMED)
    columns = ["row_id", "station_id", "station_code", "collected_at", "bikes_mechanical", "bikes_electric", "capacity", "station_name"]
    assert rows(again.clean, *columns) == rows(out["clean"], *columns)


def test_load_stops_on_violations(spark, repaired):
    tables = repaired[2]["tables"]
    constraints.require_valid(tables)
    town = tables["town"].limit(0)
    with pytest.raises(constraints.ConstraintViolation, match="foreign key town_code"):
        constraints.require_valid({**tables, "town": town})
    negative = tables["station"].withColumn("capacity", F.lit(-5).cast("bigint"))
    with pytest.raises(constraints.ConstraintViolation, match="capacity > 0"):
        constraints.require_valid({**tables, "station": negative})
    twice = tables["reading"].unionByName(tables["reading"])
    with pytest.raises(constraints.ConstraintViolation, match="unique station_id, collected_at"):
        constraints.require_valid({**tables, "reading": twice})

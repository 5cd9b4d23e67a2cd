"""Repair of closed days against one repair of everything, and what a run without news leaves alone."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dockwatch.operators import load
from dockwatch.operators.ordering import dedup
from dockwatch.plans import cleaning as C, conformance as L, live_repair as R
from dockwatch.session import materialise
from dockwatch.sources import lake
from tests.conftest import rows

FEED = ("row_id long, station_id long, station_code string, collected_at timestamp_ntz, updated_at timestamp_ntz, bikes_total long, bikes_mechanical long, "
        "bikes_electric long, docks_free long, is_installed boolean, is_renting boolean, is_returning boolean")
VERSION = "version_ts timestamp_ntz, station_code string, station_name string, capacity string, coordinates string, town_name string, town_code string"
DAYS = [date(2024, 1, d) for d in range(1, 6)]


def reading(i, day, hour=0, minute=0, station=1, code="A", late=-2, electric=1, total=3, docks=4):
    at = datetime(2024, 1, day, hour, minute)
    mechanical = None if electric is None else total - electric
    return (i, station, code, at, at + timedelta(minutes=late), total, mechanical, electric, docks, True, True, True)


READINGS = [
    reading(1, 1, 0), reading(2, 1, 0, station=2, code="B"), reading(3, 1, 0), reading(4, 1, 9, code=None),
    # the last poll of day 1 belongs to day 2, between two of its polls
    reading(5, 1, 23, 58, late=10), reading(6, 1, 23, 58, station=2, code="B", late=11, electric=None),
    reading(7, 2, 0, 1, station=2, code="B", electric=2), reading(8, 2, 0, 12, station=2, code="B", electric=None),
    reading(9, 2, 5, electric=None), reading(10, 2, 6, station=3, code=None), reading(11, 2, 7, station=2, code="B", late=-3000),
    # no reading on day 3; day 4 starts with a split that only day 2 or 5 can give
    reading(12, 4, 0, station=2, code="B", electric=None), reading(13, 4, 1, electric=None), reading(14, 4, 2, station=4, code="D", electric=None),
    reading(15, 5, 0, station=4, code="D", electric=0, total=9), reading(16, 5, 1, station=3, code="C"), reading(17, 5, 1, station=3, code="C"),
]


def version(day, *stations):
    return [(datetime(2024, 1, day, 6), c, n, cap, "48.8, 2.3", "Town", "75001") for c, n, cap in stations]


REFERENCE = [*version(1, ("A", "Stop  A", "10"), ("B", "Stop B", "12"), ("C", "Stop C", "0")), *version(2, (None, None, None)),
             *version(4, ("A", "New A", "10"), ("B", "Stop B", "12"), ("C", "Stop C", "7"), ("D", "Stop D", "5"))]


@pytest.fixture
def given(spark):
    return spark.createDataFrame(READINGS, FEED), spark.createDataFrame(REFERENCE, VERSION)


def everything(feed, reference):
    before = materialise(feed.withColumn("station_name", F.lit(None).cast("string")), "before")
    result = C.repair(before, reference, 1)
    return L.target_tables(result, materialise(result.clean, "clean"))


def content(tables):
    order = {"reading": load.READING_COLUMNS, "reading_bikes": ["reading_id", "bike_type_id", "bikes"], "station": load.STATION_COLUMNS, "town": ["town_code", "town_name"]}
    return {name: rows(tables[name].select(*columns)) for name, columns in order.items()}


def files(root):
    return {str(f): f.stat().st_mtime_ns for f in (root / "target").rglob("*.parquet")}


def test_days_one_by_one_equal_one_repair(spark, given, tmp_path):
    feed, reference = given
    root = str(tmp_path)
    R.stage_days(feed, root, DAYS[:1])
    for days in (DAYS[1:3], DAYS[3:]):
        R.stage_days(feed, root, days)
        # what comes before the newest day is closed
        R.repair_closed(spark, root, reference, until=days[-1], min_named=1)
    R.repair_closed(spark, root, reference, min_named=1)
    expected = content(everything(feed, reference))
    assert content(lake.read_target(spark, f"{root}/target")) == expected
    assert len(expected["reading"]) == 11 and len(expected["station"]) == 4
    # nothing new: nothing is written
    held = files(tmp_path)
    assert R.repair_closed(spark, root, reference, min_named=1) == [] and files(tmp_path) == held


def test_news_call_back_the_days_they_concern(spark, given, tmp_path):
    feed, reference = given
    root = str(tmp_path)
    run = lambda ref=reference: R.repair_closed(spark, root, ref, min_named=1)
    early = feed.filter("row_id NOT IN (9, 17)")
    R.stage_days(early, root, DAYS[:4])
    assert run() == [DAYS[0], DAYS[1], DAYS[3]]
    # day 5 names station 3 of day 2 and lends a split to station 4 of day 4; day 1 keeps its files
    day_one = {f: t for f, t in files(tmp_path).items() if "date=2024-01-01" in f}
    R.stage_days(early, root, [DAYS[4]])
    assert run() == [DAYS[1], DAYS[3], DAYS[4]]
    assert day_one == {f: t for f, t in files(tmp_path).items() if "date=2024-01-01" in f}
    # late readings: day 2 is staged again, and day 4 takes its neighbour from there
    R.stage_days(feed, root, [DAYS[1]])
    assert run() == [DAYS[1], DAYS[3]]
    # a new reference version concerns the days from its time on
    newer = reference.unionByName(spark.createDataFrame(version(5, ("A", "Last A", "9"), ("B", "Stop B", "12")), VERSION))
    assert run(newer) == [DAYS[4]]
    # a day staged again without its late poll gives up what it had on the next day
    gone = feed.filter("row_id NOT IN (5, 6, 17)")
    R.stage_days(gone, root, [DAYS[0]])
    assert set(run(newer)) >= {DAYS[1]}
    assert content(lake.read_target(spark, f"{root}/target")) == content(everything(gone, newer))


def test_rows_the_live_path_lost_come_back(spark, given, tmp_path):
    feed, reference = given
    root = str(tmp_path)
    lost = materialise(load.with_reading_id(feed.filter("row_id IN (1, 2)")), "live")
    stations = spark.createDataFrame([(1, "A", "Old", 1.0, 1.0, 3, "75001")], "station_id long, station_code string, station_name string, latitude double, longitude double, capacity long, town_code string")
    lake.write_target({"town": load.towns_of(stations.withColumn("town_name", F.lit("T"))), "station": stations, "bike_type": load.seed_types(spark),
                       "reading": lost.select(*load.READING_COLUMNS), "reading_bikes": load.insert_children(lost, load.seed_types(spark))}, f"{root}/target")
    R.stage_days(feed, root, DAYS)
    R.repair_closed(spark, root, reference, min_named=1)
    tables, whole = lake.read_target(spark, f"{root}/target"), everything(feed, reference)
    assert content(tables) == content(whole)
    until = datetime(2024, 2, 1)
    assert {r.difference for r in L.base_vs_base(tables, whole, until).collect()} == {0}


def test_type_rows_with_their_date_are_stored_without_meeting_the_readings(spark, given, tmp_path, monkeypatch):
    feed, _ = given
    numbered = materialise(load.with_reading_id(dedup(feed)).withColumn("date", F.to_date("collected_at")), "live")
    types, stations = load.seed_types(spark), spark.createDataFrame([], "station_id long, town_code string")
    tables = {"town": stations, "station": stations, "bike_type": types, "reading": numbered.select(*load.READING_COLUMNS)}
    written, write = {}, lake.write_batch
    monkeypatch.setattr(lake, "write_batch", lambda df, path, label: written.update({path[len(str(tmp_path)):]: df}) or write(df, path, label))
    for name, ids in (("dated", ["reading_id", "date"]), ("plain", ["reading_id"])):
        lake.write_target({**tables, "reading_bikes": load.insert_children(numbered, types, ids)}, f"{tmp_path}/{name}")
    dated, plain = (spark.read.parquet(f"{tmp_path}/{n}/reading_bikes") for n in ("dated", "plain"))
    assert rows(dated, "reading_id", "bike_type_id", "bikes", "date") == rows(plain, "reading_id", "bike_type_id", "bikes", "date") != []
    joins = {n: written[f"/{n}/reading_bikes"]._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") for n in ("dated", "plain")}
    assert joins == {"dated": joins["plain"] - 1, "plain": joins["plain"]}


@pytest.mark.parametrize("table", ["reading_bikes"])
def test_an_interrupted_swap_is_finished(spark, given, tmp_path, monkeypatch, table):
    feed, reference = given
    root = str(tmp_path)
    R.stage_days(feed, root, DAYS)
    move, calls = lake._move, []

    def stops(spark, old, new):
        if f"/{table}/_swap/rows" in old:
            calls.append(old)
            if len(calls) == 2:
                raise OSError("lost")
        move(spark, old, new)

    monkeypatch.setattr(lake, "_move", stops)
    with pytest.raises(OSError):
        R.repair_closed(spark, root, reference, min_named=1)
    monkeypatch.setattr(lake, "_move", move)
    assert lake.exists(spark, f"{root}/target/{table}/_swap/plan.json")
    assert R.repair_closed(spark, root, reference, min_named=1) == [DAYS[0], DAYS[1], DAYS[3], DAYS[4]]
    assert content(lake.read_target(spark, f"{root}/target")) == content(everything(feed, reference))
    assert not lake.exists(spark, f"{root}/target/{table}/_swap")


def test_swap_of_days_without_rows(spark, tmp_path):
    path = f"{tmp_path}/t"
    frame = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, date(2024, 1, 3))], "v long, date date")
    lake.write_batch(frame, path, "a")
    lake.write_batch(frame.withColumn("v", F.col("v") + 10), path, "b")
    lake.replace_days(frame.filter("v = 1").withColumn("v", F.lit(7).cast("long")), path, [date(2024, 1, 1), date(2024, 1, 2)], "new")
    assert rows(spark.read.parquet(path), "v", "batch") == [(13, "b"), (3, "a"), (7, "new")]
    with pytest.raises(ValueError, match="not replaced"):
        lake.replace_days(frame, path, [date(2024, 1, 1)], "new")


def test_staged_rows_are_not_stored_twice(spark, given, tmp_path, monkeypatch):
    """The rows in true time are written into their days only."""
    stored = []

    def noted(df, name):
        stored.append(name)
        return materialise(df, name)

    monkeypatch.setattr(R, "materialise", noted)
    # the last poll of day 1 belongs to day 2
    assert R.stage_days(given[0], f"{tmp_path}/base", DAYS[:1]) == DAYS[:2]
    assert stored == ["staged", "late"]

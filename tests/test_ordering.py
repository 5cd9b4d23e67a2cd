import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from dockwatch.operators import aggregates as A, ordering as O
from dockwatch.operators.asof import asof_version, attach_reference
from tests.conftest import rows

T0 = datetime(2024, 1, 1)


def skewed(spark, n=2400, seed=3):
    """A third of all rows are copies of one station at one time; some keys and values are NULL."""
    r = random.Random(seed)
    data = []
    for i in range(n):
        if i % 3 == 0:
            data.append((i, 1, T0 + timedelta(hours=30), r.choice([None, 1, 2])))
        else:
            at = T0 + timedelta(hours=r.randint(0, 90)) if r.random() > 0.03 else None
            data.append((i, r.choice([1, 2, 3, None]), at, r.choice([None, 1, 2, 3])))
    r.shuffle(data)
    return spark.createDataFrame(data, "row_id long, station_id long, collected_at timestamp, v long")


@pytest.mark.parametrize("block", [1 << 20, 64])
def test_neighbours_equal_one_window(spark, monkeypatch, block):
    monkeypatch.setattr(O, "BLOCK_ROWS", block)
    df = skewed(spark)
    w = Window.partitionBy("station_id").orderBy("collected_at", "row_id")
    plain = df.select("row_id", "v", F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("n"))
    assert rows(O.with_neighbours(df, "v")) == rows(plain, "row_id", "p", "n")
    assert rows(O.with_neighbours(df, "v", only_missing=True)) == rows(plain.filter("v IS NULL"), "row_id", "p", "n")


def test_neighbours_of_missing_values_come_from_the_days_around_them(spark):
    at = lambda *days: [T0 + timedelta(days=d) for d in days]
    data = [(i, 1, t, None if i == 4 else i) for i, t in enumerate(at(0, 1, 1, 5, 9, 20, 20, 21, 30))] + [(100 + i, 2, t, i) for i, t in enumerate(at(5, 9, 20))]
    df = spark.createDataFrame(data + [(200, None, None, None), (201, None, T0, 7)], "row_id long, station_id long, collected_at timestamp, v long")
    near = O._around_missing(df.select(F.col("station_id").alias("k"), F.col("collected_at").alias("t"), F.col("row_id").alias("id"), "v"))
    assert rows(near, "id") == [(200,), (201,), (3,), (4,), (5,), (6,)]
    assert rows(O.with_neighbours(df, "v", only_missing=True)) == [(200, None, 7), (4, 3, 5)]


def test_incomplete_children_are_counted_without_a_join(spark):
    readings = spark.createDataFrame([(1,), (2,), (2,), (3,), (4,), (None,)], "reading_id long")
    children = spark.createDataFrame([(1,), (1,), (2,), (4,), (4,), (4,), (9,), (None,), (None,)], "reading_id long")
    out = A.incomplete_children(readings, children)
    assert rows(out, "reading_id", "n_children") == [(2, 1), (2, 1), (3, 0), (4, 3), (None, 0)]
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    named = readings.withColumn("name", F.lit("r"))
    assert rows(A.incomplete_children(named, children)) == [(2, "r", 1), (2, "r", 1), (3, "r", 0), (4, "r", 3), (None, "r", 0)]


def test_keep_lowest_keeps_null_keys(spark):
    df = skewed(spark)
    seen, expected = set(), []
    for r in sorted(df.collect(), key=lambda r: r.row_id):
        key = (r.station_id, r.collected_at)
        if None in key or key not in seen:
            expected.append(r.row_id)
            seen.add(key)
    assert sorted(r.row_id for r in O.keep_lowest(df, ["station_id", "collected_at"]).collect()) == expected


def test_latest_with_ties(spark):
    df = spark.createDataFrame([(1, 1, T0), (2, 1, T0), (3, 1, T0 - timedelta(days=1)), (4, 2, T0)], "row_id long, s long, t timestamp")
    assert rows(O.latest_per_key(df, "s", "t"), "row_id") == [(1,), (2,), (4,)]
    assert rows(O.latest_by(df, ["s"], ["t", "row_id"]), "row_id") == [(2,), (4,)]


def at(hours):
    return T0 + timedelta(hours=hours)


def test_asof(spark):
    versions = spark.createDataFrame([(at(h),) for h in (6, 30, 31, 100)], "version_ts timestamp")
    times = spark.createDataFrame([(at(h),) for h in (0, 6, 7, 29, 30, 40, 99, 100, 500)], "collected_at timestamp")
    expected = {0: None, 6: 6, 7: 6, 29: 6, 30: 30, 40: 31, 99: 31, 100: 100, 500: 100}
    got = {r.collected_at: r.version_ts for r in asof_version(times, versions).collect()}
    assert got == {at(t): None if v is None else at(v) for t, v in expected.items()}
    with_first = {r.collected_at: r.version_ts for r in asof_version(times, versions, fallback=True).collect()}
    assert with_first == {**got, at(0): at(6)}
    none = asof_version(times, versions.limit(0), fallback=True)
    assert {r.version_ts for r in none.collect()} == {None}


def test_attach_keeps_lost_codes(spark):
    feed = spark.createDataFrame([(1, "A", at(1)), (2, None, at(1)), (3, "Z", at(1)), (4, "A", at(-1))], "row_id long, station_code string, collected_at timestamp")
    ref = spark.createDataFrame([(at(0), "A", "Stop"), (at(0), None, None)], "version_ts timestamp, station_code string, station_name string")
    out = attach_reference(feed, ref, asof_version(feed, ref))
    assert rows(out, "row_id", "station_name") == [(1, "Stop"), (2, None), (3, None), (4, None)]


def test_tuple_distinct_counts_nulls(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (None, 1), (None, None), (2, None)], "a long, b long")
    assert rows(A.tuple_distinct(df, "a", "b")) == [(6, 4)]


def test_missing_slots(spark):
    df = spark.createDataFrame([(T0,), (T0 + timedelta(minutes=1, seconds=20),), (T0 + timedelta(minutes=4),)], "collected_at timestamp")
    assert rows(A.missing_slots(df)) == [(5, 2)]

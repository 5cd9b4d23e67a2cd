"""Bitmaps of time slots against distinct tuples."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dockwatch.operators.aggregates import missing_slots, tuple_distinct
from dockwatch.operators.slots import collection_counts, slot_bitmaps
from tests.conftest import rows

ROW = "station_id long, collected_at timestamp_ntz"
START = datetime(2023, 12, 20)


def frame(spark):
    given = [(s, START + timedelta(minutes=7 * k * s % 50_000)) for s in range(1, 6) for k in range(400)]
    given += given[::3] + [(1, START + timedelta(minutes=3, seconds=5)), (1, START + timedelta(minutes=3, seconds=5)), (1, START + timedelta(minutes=3, microseconds=1))]
    given += [(2, None), (2, None), (None, START), (None, START), (None, None), (3, datetime(1969, 12, 31, 23, 59))]
    return spark.createDataFrame(given, ROW)


@pytest.mark.parametrize("cadence", ["minute", "hour", "second"])
def test_equal_to_distinct_tuples(spark, cadence):
    df = frame(spark)
    got = collection_counts(df, cadence).first()
    n, tuples = tuple_distinct(df, "station_id", "collected_at").first()
    expected, missing = missing_slots(df, cadence=cadence).first()
    assert (got.readings, got.tuples, got.expected, got.missing) == (n, tuples, expected, missing)


def test_one_row_per_station_and_stretch(spark):
    df = frame(spark).filter("collected_at >= '2023-12-20'")
    assert slot_bitmaps(df).count() <= 6 * 3 and df.count() > 2500


def test_empty(spark):
    none = frame(spark).limit(0)
    assert rows(collection_counts(none)) == [(0, 0, 0, 0)]
    assert rows(collection_counts(frame(spark).filter(F.col("collected_at").isNull()))) == [(3, 2, 0, 0)]


def test_bitmaps_are_neither_shuffled_nor_sorted(spark):
    """Plan of the counts: what is sorted or exchanged before the merge of all stations holds slots, not bitmaps."""
    executed = collection_counts(frame(spark))
    executed.collect()
    plan = executed._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[1]
    lines = [line.strip(" +-:*") for line in plan.splitlines()]
    per_stretch = next(i for i, line in enumerate(lines) if "partial_bitmap_or_agg" in line)
    below = lines[per_stretch + 1:]
    built = next(i for i, line in enumerate(below) if "bitmap_construct_agg" in line)
    assert not any(line.startswith(("Sort ", "Exchange")) for line in below[:built])
    partial = next(i for i, line in enumerate(below) if "partial_bitmap_construct_agg" in line)
    assert not any(line.startswith(("Sort ", "Exchange")) for line in below[:partial])

"""Change history against whole versions."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from dockwatch.operators.aggregates import reference_changes
from dockwatch.operators.asof import asof_version, attach_reference
from dockwatch.operators.history import append_version, attach_at_collection, build_history, history_changes
from dockwatch.plans.cleaning import r4_valid_versions
from tests.conftest import rows

VERSION = "version_ts timestamp_ntz, station_code string, station_name string, capacity string, coordinates string, town_name string, town_code string"
FEED = "row_id long, station_code string, collected_at timestamp_ntz"


def ts(day, hour=6):
    return datetime(2024, 1 + (day - 1) // 28, 1 + (day - 1) % 28, hour)


def version(day, *stations):
    return [(ts(day), c, n, cap, "48.8, 2.3", "Town", "75001") for c, n, cap in stations]


FULL = [("A", "Stop A", "10"), ("B", "Stop B", None), ("C", "Stop C", "5")]
REFERENCE = [*version(2, *FULL), *version(3, *FULL), *version(4, (None, None, None), (None, None, None)), *version(5, *FULL),
             *version(6, ("A", "New A", "10"), FULL[1]), *version(7, ("A", "New A", "10"), FULL[1], FULL[2]), *version(40, ("A", "New A", "10"), ("B", "Stop B", "1"), FULL[2])]
TIMES = [ts(1), ts(2, 5), ts(2), ts(3, 7), ts(4), ts(4, 9), ts(5), ts(6, 8), ts(7), ts(20), ts(39), ts(40), ts(41), None]


@pytest.fixture
def given(spark):
    feed = [(100 * n + k, code, at) for n, at in enumerate(TIMES) for k, code in enumerate(["A", "B", "C", "Z", None])]
    return spark.createDataFrame(feed, FEED), spark.createDataFrame(REFERENCE, VERSION)


def test_intervals(spark, given):
    history = build_history(given[1])
    assert rows(history, "station_code", "station_name", F.dayofyear("valid_from"), F.dayofyear("valid_to")) == sorted([
        ("A", "Stop A", 2, 4), ("A", "Stop A", 5, 6), ("A", "New A", 6, None), ("B", "Stop B", 2, 4), ("B", "Stop B", 5, 43), ("B", "Stop B", 43, None),
        ("C", "Stop C", 2, 4), ("C", "Stop C", 5, 6), ("C", "Stop C", 7, None)], key=repr)


@pytest.mark.parametrize("fallback", [False, True])
def test_same_rows_as_the_join_with_versions(spark, given, fallback):
    feed, reference = given
    known = reference if not fallback else r4_valid_versions(reference, 2)
    whole = attach_reference(feed, known, asof_version(feed, known, fallback=fallback))
    by_history = attach_at_collection(feed, build_history(known), known, fallback)
    assert rows(by_history, *sorted(whole.columns)) == rows(whole, *sorted(whole.columns)) and by_history.count() == 65
    if not fallback:
        assert build_history(reference).count() == 9 < reference.count()


def test_versions_one_by_one(spark, given):
    reference = given[1]
    times = sorted({r.version_ts for r in reference.collect()})
    at = lambda t: reference.filter(F.col("version_ts") == F.lit(t))
    history = build_history(at(times[0]))
    for t in times[1:]:
        history = append_version(history, at(t), t)
    whole = build_history(reference)
    assert rows(history, *sorted(whole.columns)) == rows(whole, *sorted(whole.columns))
    history = build_history(at(times[0]))
    for t in times[1:]:
        history = append_version(history, at(t), t, min_named=2)
    valid = build_history(reference.filter(F.col("version_ts") != F.lit(ts(4))))
    assert rows(history, *sorted(valid.columns)) == rows(valid, *sorted(valid.columns))
    with pytest.raises(ValueError, match="not later"):
        append_version(history, at(times[2]), times[2])


def test_changes(spark, given):
    reference = given[1]
    assert rows(history_changes(build_history(reference))) == rows(reference_changes(reference))
    assert len(rows(reference_changes(reference))) == 2


def test_empty(spark, given):
    feed, reference = given
    none = reference.limit(0)
    assert build_history(none).count() == 0
    assert attach_at_collection(feed, build_history(none), none).filter("station_name IS NOT NULL").count() == 0
    assert attach_at_collection(feed.limit(0), build_history(reference), reference).count() == 0

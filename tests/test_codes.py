"""Codes carried as keyed state: batches, restarts, a first state, expiry."""

import time
from datetime import datetime, timedelta

import pytest

from dockwatch.streaming.codes import STORE, carry_code_stream
from tests.conftest import rows

ROW = "station_id long, station_code string, collected_at timestamp"


@pytest.fixture
def store(spark):
    before = {k: spark.conf.get(k, None) for k in STORE}
    for k, v in STORE.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def at(hour):
    return datetime(2024, 1, 1, hour)


def add(spark, root, *batch):
    spark.createDataFrame([(s, c, at(h)) for s, c, h in batch], ROW).coalesce(1).write.mode("append").parquet(f"{root}/in")


def run(spark, root, **kw):
    source = spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    query = carry_code_stream(source, **kw).writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    return rows(spark.read.schema(ROW).parquet(f"{root}/out"), "station_id", "station_code")


def test_batches_restart_and_first_state(spark, store, tmp_path):
    first = spark.createDataFrame([(2, "B0", at(0)), (9, None, at(0)), (None, "X", at(0))], "station_id long, station_code string, seen_at timestamp")
    add(spark, tmp_path, (1, "A", 1), (1, None, 1), (2, None, 1), (3, None, 1), (None, None, 1), (None, "Z", 1))
    seen = [(1, "A"), (1, "A"), (2, "B0"), (3, None), (None, None), (None, "Z")]
    assert run(spark, tmp_path, initial=first) == sorted(seen, key=repr)
    # a late code changes nothing; of equal times the greatest counts
    add(spark, tmp_path, (1, "Late", 0), (1, None, 2), (3, "C1", 2), (3, "C2", 2), (3, None, 1))
    seen += [(1, "Late"), (1, "A"), (3, "C1"), (3, "C2"), (3, "C2")]
    assert run(spark, tmp_path, initial=first) == sorted(seen, key=repr)


def test_codes_expire(spark, store, tmp_path):
    """A stream with expiry runs empty batches for ever, so it is stopped once its rows are there."""
    def wait_for(n):
        source = spark.readStream.schema(ROW).parquet(f"{tmp_path}/in")
        query = carry_code_stream(source, expire=timedelta(milliseconds=1)).writeStream.format("parquet").option("path", f"{tmp_path}/out").option(
            "checkpointLocation", f"{tmp_path}/cp").start()
        try:
            end = time.monotonic() + 60
            while time.monotonic() < end:
                time.sleep(1)
                if (tmp_path / "out/_spark_metadata").exists():
                    found = rows(spark.read.schema(ROW).parquet(f"{tmp_path}/out"), "station_id", "station_code")
                    if len(found) >= n:
                        return found
            raise AssertionError(query.lastProgress)
        finally:
            query.stop()

    add(spark, tmp_path, (1, "A", 1))
    assert wait_for(1) == [(1, "A")]
    add(spark, tmp_path, (1, None, 2))
    assert wait_for(2) == [(1, "A"), (1, None)]

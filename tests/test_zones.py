"""Zones written batch by batch: lost and repeated batches."""

import json
from datetime import datetime, timezone

import pytest

from dockwatch.sources import lake
from dockwatch.streaming import live
from tests.test_live import STATIONS, message, topic, version


def zones(spark, root):
    raw = sorted(r.value for r in lake.read_zone(spark, root, "raw/api").collect())
    commits = lake.read_commits(spark, root)
    batches = lake.read_committed_batches(spark, root, commits).count() if commits.count() else 0
    return raw, batches


def stream(spark, root, once=True):
    source = live.read_status_stream(spark, f"{root}/topic", "text")
    return live.run_two_zone_stream(source, root, f"{root}/raw/source2", f"{root}/checkpoint/zones", once=once)


@pytest.mark.parametrize("lost_in", ["raw/api", "aggregated", "commit", "after"])
def test_a_batch_that_was_stopped_is_stored_once(spark, tmp_path, monkeypatch, lost_in):
    root = str(tmp_path)
    version(tmp_path, "2024-01-01", "000000", STATIONS)
    lines = [message(1, "A", 0), message(2, "B", 0), message(1, "A", 0)]
    topic(tmp_path, "t1", lines)
    write, commit, line = lake.write_zone_batch, lake.commit_batch, lake.write_batch

    def lost(df, root, zone, label, at):
        write(df, root, zone, label, at)  # the folder is complete, the job is not
        if zone == lost_in:
            raise OSError("lost")

    def never(*a):
        raise OSError("lost")

    monkeypatch.setattr(lake, "write_zone_batch", lost)
    if lost_in == "commit":
        monkeypatch.setattr(lake, "commit_batch", never)
    if lost_in == "after":  # committed, but the stream does not get to know
        monkeypatch.setattr(lake, "write_batch", never)
    with pytest.raises(Exception, match="lost"):
        stream(spark, root).awaitTermination()
    assert zones(spark, root) == ((sorted(lines), 3) if lost_in == "after" else ([], 0))
    counts = {r.zone: r.records for r in lake.zone_counts(spark, {"raw": f"{root}/raw/api"}, root).collect()}
    assert counts == {"raw": 3 if lost_in == "after" else 0}

    monkeypatch.setattr(lake, "write_zone_batch", write)
    monkeypatch.setattr(lake, "commit_batch", commit)
    monkeypatch.setattr(lake, "write_batch", line)
    stream(spark, root).awaitTermination()
    assert zones(spark, root) == (sorted(lines), 3) and lake.open_folders(spark, root) == []
    # whoever reads the folders as they are finds nothing twice either
    assert spark.read.text(f"{root}/raw/api").count() == 3 and spark.read.text(f"{root}/aggregated").count() == 3
    assert [(r.messages, r.unmatched) for r in live.stream_report(spark, root).collect()] == [(3, 0)]
    assert lake.read_raw_status(spark, f"{root}/raw/api", root=root).count() == 3

    topic(tmp_path, "t2", [message(1, "A", 1)])
    stream(spark, root).awaitTermination()
    assert len(zones(spark, root)[0]) == 4


def test_the_load_follows_commits(spark, tmp_path):
    root = str(tmp_path)
    version(tmp_path, "2024-01-01", "000000", STATIONS)
    source = spark.createDataFrame([(message(1, "A", m),) for m in range(3)], "value string")
    at, _ = lake.begin_batch(spark, root, "q-0", datetime(2024, 1, 1, tzinfo=timezone.utc))
    enriched = spark.createDataFrame([(json.dumps({"station_id": "1"}),)], "value string")
    lake.write_zone_batch(enriched, root, "aggregated", "q-0", at)  # open: not for the load

    def load():
        live.run_incremental(spark, root, f"{root}/checkpoint/load").awaitTermination()
        path = f"{root}/target/reading"
        return spark.read.parquet(path).count() if lake.exists(spark, path) else 0

    assert load() == 0
    live.process_batch(source, root, f"{root}/raw/source2", label="q-0")
    live.process_batch(source.limit(0), root, f"{root}/raw/source2", label="q-1")
    assert load() == 3 and load() == 3
    assert lake.read_commits(spark, root).count() == 1


def test_a_zone_without_commits_is_followed_by_files(spark, tmp_path):
    root = str(tmp_path)
    version(tmp_path, "2024-01-01", "000000", STATIONS)
    live.process_batch(spark.createDataFrame([(message(1, "A", 0),)], "value string"), root, f"{root}/raw/source2")
    live.run_incremental(spark, root, f"{root}/checkpoint/files", committed=False).awaitTermination()
    assert spark.read.parquet(f"{root}/target/reading").count() == 1

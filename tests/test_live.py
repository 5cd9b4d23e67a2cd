import json
from datetime import datetime

from pyspark.sql import functions as F

from dockwatch.operators import load
from dockwatch.sources import lake, reference
from dockwatch.streaming import live
from tests.conftest import rows

HEADER = "﻿stationcode;name;capacity;coordonnees_geo;nom_arrondissement_communes;code_insee_commune\n"


def version(root, day, time, lines):
    folder = root / "raw" / "source2" / f"date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"stations_{time}.csv").write_text(HEADER + "".join(line + "\n" for line in lines), encoding="utf-8")


def message(station, code, minute, mech=2, elec=1):
    return json.dumps({
        "station_id": station, "stationCode": code, "num_bikes_available": mech + elec,
        "num_bikes_available_types": [{"mechanical": mech}, {"ebike": elec}], "num_docks_available": 5, "is_installed": 1, "is_renting": 1,
        "is_returning": 1, "last_reported": 1704067200, "date_collecte": f"2024-01-01T00:{minute:02d}:00+00:00"})


STATIONS = ["A;Stop  A;10;48.8, 2.3;Town;75001", "B;Stop B;0;48.8, 2.3;Town;75001"]


def topic(root, name, lines):
    folder = root / "topic"
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.txt").write_text("".join(line + "\n" for line in lines))


def run(spark, root, code_store=None, min_named=None):
    source = live.read_status_stream(spark, str(root / "topic"), "text")
    query = live.run_two_zone_stream(source, str(root), str(root / "raw/source2"), str(root / "checkpoint/zones"), once=True,
                                     min_named=min_named, code_store=code_store)
    query.awaitTermination()
    load_query = live.run_incremental(spark, str(root), str(root / "checkpoint/load"))
    load_query.awaitTermination()


def test_reference_files(spark, tmp_path):
    version(tmp_path, "2024-01-01", "060000", STATIONS)
    version(tmp_path, "2024-01-02", "060000", [";;;;;", ";;;;;"])
    ref = reference.read_reference_versions(spark, str(tmp_path / "raw/source2"))
    assert rows(ref.select("station_code", "station_name", F.date_format("version_ts", "dd HH:mm"))) == sorted(
        [("A", "Stop  A", "01 06:00"), ("B", "Stop B", "01 06:00"), (None, None, "02 06:00"), (None, None, "02 06:00")], key=repr)
    path = str(tmp_path / "raw/source2")
    assert reference.read_newest_version(spark, path).count() == 0
    assert rows(reference.read_newest_version(spark, path, min_named=2), "station_code") == [("A",), ("B",)]
    assert reference.read_newest_version(spark, path, min_named=3) is None
    assert rows(reference.newest_version(ref, 2), "station_code") == [("A",), ("B",)]
    assert rows(reference.valid_versions(ref, 2).select(F.dayofmonth("version_ts"))) == [(1,)]


def test_live_path(spark, tmp_path):
    version(tmp_path, "2024-01-01", "000000", STATIONS)
    first = [message(1, "A", 0), message(2, "B", 0), message(3, "Z", 0), message(1, "A", 1), message(1, "A", 1)]
    topic(tmp_path, "t1", first)
    run(spark, tmp_path)
    root = str(tmp_path)
    assert sorted(r.value for r in spark.read.text(f"{root}/raw/api").select("value").collect()) == sorted(first)
    tables = lake.read_target(spark, f"{root}/target")
    assert rows(load.flat_view(tables), "station_code", "station_name", "bikes_mechanical", "bikes_electric", "bikes_total") == [("A", "Stop A", 2, 1, 3)] * 2
    log = load.read_runs(spark, f"{root}/runs").collect()
    assert [(r.rows_raw, r.rows_rejected, r.rows_duplicate, r.rows_loaded) for r in log] == [(5, 2, 1, 2)]

    report = live.stream_report(spark, root).collect()
    assert [(r.messages, r.unmatched) for r in report] == [(5, 1)]

    # a second batch with one known and one new reading, and a renamed station
    version(tmp_path, "2024-01-01", "010000", ["A;Stop A2;12;48.8, 2.3;Town;75001"])
    topic(tmp_path, "t2", [message(1, "A", 1), message(1, "A", 2)])
    run(spark, tmp_path)
    view = load.flat_view(lake.read_target(spark, f"{root}/target"))
    assert rows(view.select("station_name", "capacity", F.minute("collected_at"))) == [("Stop A2", 12, 0), ("Stop A2", 12, 1), ("Stop A2", 12, 2)]
    assert lake.read_target(spark, f"{root}/target")["reading_bikes"].count() == 6
    assert spark.read.parquet(f"{root}/clean/readings").count() == 3


def test_replayed_batch_changes_nothing(spark, tmp_path):
    text = ("station_id string, station_code string, collected_at string, updated_at string, bikes_mechanical string, bikes_electric string, "
            "docks_free string, is_installed string, is_renting string, is_returning string, station_name string, capacity string, "
            "coordinates string, town_name string, town_code string")
    row = lambda s, minute: (str(s), f"C{s}", f"2024-01-01T00:{minute:02d}:00+00:00", "1704067200", "1", "2", "3", "1", "1", "1", "S", "10", "48.8, 2.3", "T", "75001")
    batch = spark.createDataFrame([row(1, 0), row(2, 0), row(2, 0)], text)
    for _ in range(2):
        run_row = live.load_batch(batch, str(tmp_path), "q-0")
        assert (run_row["rows_loaded"], run_row["rows_duplicate"]) == (2, 1)
    again = live.load_batch(batch, str(tmp_path), "q-1")
    assert (again["rows_loaded"], again["rows_duplicate"]) == (0, 3)
    tables = lake.read_target(spark, f"{tmp_path}/target")
    assert {n: tables[n].count() for n in ("reading", "reading_bikes", "station", "town")} == {"reading": 2, "reading_bikes": 4, "station": 2, "town": 1}
    assert load.read_runs(spark, f"{tmp_path}/runs").count() == 2


def test_codes_are_carried_between_batches(spark, tmp_path):
    store = str(tmp_path / "codes")
    def carried(*batch):
        frame = spark.createDataFrame(list(batch), "station_id string, station_code string, collected_at string")
        return rows(live.carry_code(frame, store), "station_id", "station_code")

    assert carried(("1", "Z", "2024-01-01T00"), ("2", None, "2024-01-01T00")) == sorted([("1", "Z"), ("2", None)], key=repr)
    assert carried(("1", None, "2024-01-01T01"), ("2", "B", "2024-01-01T01")) == [("1", "Z"), ("2", "B")]
    # the last code counts, not the greatest, and a late one changes nothing
    assert carried(("1", "A", "2024-01-01T02")) == [("1", "A")]
    assert carried(("1", "Y", "2023-12-31T00"), ("1", None, "2024-01-01T03"), ("2", None, "2024-01-01T03")) == [("1", "A"), ("1", "Y"), ("2", "B")]
    for n in range(6):
        carried(("1", f"N{n}", f"2024-01-02T0{n}"))
    assert len(list((tmp_path / "codes").glob("snapshot=*"))) == 3


def batch_of(spark, *messages):
    """Aggregated-zone rows: (station id, minute, mechanical, change of other fields)."""
    names = ["station_id", "station_code", "collected_at", "updated_at", "bikes_mechanical", "bikes_electric", "docks_free", "is_installed", "is_renting",
             "is_returning", "station_name", "capacity", "coordinates", "town_name", "town_code"]
    made = []
    for station, at, mechanical, change in messages:
        row = dict(zip(names, (str(station), f"C{station % 1000}", at, "1704067200", str(mechanical), "2", "3", "1", "1", "1", "S", "10", "48.8, 2.3", "T", "75001")))
        made.append(tuple({**row, **change}[n] for n in names))
    return spark.createDataFrame(made, ", ".join(f"{n} string" for n in names))


def test_no_bikes_are_lost(spark, tmp_path):
    """Large station ids and fractions of a second keep their type rows, and what the model refuses is rejected."""
    stations = [5, 5_000_000_001, (1 << 63) - 1]
    times = ["2024-01-01T00:00:00+00:00", "2024-01-01T00:00:00.000001+00:00"]
    batch = batch_of(spark, *[(s, t, 3, {}) for s in stations for t in times], (6, times[0], 1, {"station_name": "n" * 151}), (7, times[0], 40000, {}))
    run_row = live.load_batch(batch, str(tmp_path), "q-0")
    assert (run_row["rows_loaded"], run_row["rows_rejected"]) == (6, 2)
    view = load.flat_view(lake.read_target(spark, f"{tmp_path}/target"))
    assert rows(view, "bikes_total") == [(5,)] * 6 and view.filter("reading_id is null").count() == 0


def test_broken_dimension_stops_the_batch(spark, tmp_path):
    import pytest

    from dockwatch.operators.constraints import ConstraintViolation

    at = "2024-01-01T00:00:00+00:00"
    with pytest.raises(ConstraintViolation, match="unique station_code"):
        live.load_batch(batch_of(spark, (1, at, 1, {}), (2, at, 1, {"station_code": "C1"})), str(tmp_path), "q-0")
    assert not (tmp_path / "target").exists()


def test_state_stays_bounded(spark, tmp_path):
    """Twenty batches over two days: intermediate tables go, snapshots are pruned, closed days are joined."""
    from dockwatch.session import work_dir

    def intermediate():
        import glob
        return len(glob.glob(f"{work_dir(spark)}/tables-*/*"))

    before = intermediate()
    for n in range(20):
        at = f"2024-01-0{1 + n // 10}T00:{n:02d}:00+00:00"
        live.load_batch(batch_of(spark, (1, at, n, {}), (2, at, n, {})), str(tmp_path), f"q-{n}")
        if n == 9:
            late = live.load_batch(batch_of(spark, (1, "2023-12-31T00:00:00+00:00", 1, {"station_name": "Old"})), str(tmp_path), "q-late")
            assert late["rows_loaded"] == 1
    assert intermediate() == before
    assert len(list((tmp_path / "target/station").glob("snapshot=*"))) == 3 and len(list((tmp_path / "target/town").glob("snapshot=*"))) == 1
    tables = lake.read_target(spark, f"{tmp_path}/target")
    assert {r.station_name for r in tables["station"].collect()} == {"S"}
    view = rows(load.flat_view(tables), "reading_id", "bikes_total", "date")
    assert len(view) == 41
    folders = lambda day: len(list((tmp_path / f"target/reading/date={day}").glob("batch=*")))
    assert (folders("2024-01-01"), folders("2024-01-02")) == (10, 10)
    live.compact_closed(spark, str(tmp_path), datetime(2024, 1, 2))
    assert (folders("2024-01-01"), folders("2024-01-02")) == (1, 10)
    assert rows(load.flat_view(lake.read_target(spark, f"{tmp_path}/target")), "reading_id", "bikes_total", "date") == view
    # a batch that is run again after that adds nothing, and a stopped compaction is finished
    again = live.load_batch(batch_of(spark, (1, "2024-01-01T00:00:00+00:00", 0, {}), (2, "2024-01-01T00:00:00+00:00", 0, {})), str(tmp_path), "q-0")
    assert again["rows_loaded"] == 0
    reading = f"{tmp_path}/target/reading"
    lake._move(spark, f"{reading}/date=2024-01-01/batch=compacted", f"{reading}/_compacted-2024-01-01")
    lake.compact_before(spark, reading, "2024-01-02")
    assert rows(load.flat_view(lake.read_target(spark, f"{tmp_path}/target")), "reading_id", "bikes_total", "date") == view
    assert load.read_runs(spark, f"{tmp_path}/runs").count() == 21


def test_reads_of_the_view_are_cut_by_day(spark, tmp_path):
    """Both fact tables get partition filters in the reports of the stored target."""
    from dockwatch.operators.relations import latest_state
    from dockwatch.plans.availability import series_24h

    for n in (1, 2, 3):
        live.load_batch(batch_of(spark, (1, f"2024-01-0{n}T00:00:00+00:00", n, {})), str(tmp_path), f"q-{n}")
    tables = lake.read_target(spark, f"{tmp_path}/target")

    def fact_scans(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [line for line in plan.splitlines() if "FileScan parquet" in line and ("collected_at#" in line or "bikes#" in line)]

    for report, figure, want in ((series_24h(load.flat_view(tables), datetime(2024, 1, 3, 12)), "mechanical", 3), (latest_state(tables), "bikes_total", 5)):
        scans = fact_scans(report)
        assert any("bikes#" in line for line in scans) and any("collected_at#" in line for line in scans)
        # the newest day itself is found from the partition column alone
        assert all("PartitionFilters: []" not in line for line in scans)
        assert [r[figure] for r in report.collect()] == [want]


def test_reference_header_and_repeated_code(spark, tmp_path):
    import pytest

    version(tmp_path, "2024-01-01", "060000", ["A;Zed;10;48.8, 2.3;Town;75001", "B;B;1;48.8, 2.3;Town;75001", "A;Last;11;48.8, 2.3;Town;75001"])
    path = str(tmp_path / "raw/source2")
    assert rows(reference.read_newest_version(spark, path), "station_code", "station_name") == [("A", "Last"), ("B", "B")]
    assert rows(reference.newest_version(reference.read_reference_versions(spark, path)), "station_code", "station_name") == [("A", "Last"), ("B", "B")]
    (tmp_path / "raw/source2/notes.csv").write_text(HEADER)
    assert [name.rsplit("/", 1)[1] for name in reference.unplaced_files(spark, path)] == ["notes.csv"]
    folder = tmp_path / "other/date=2024-01-01"
    folder.mkdir(parents=True)
    (folder / "stations_060000.csv").write_text("name;stationcode;capacity;coordonnees_geo;nom_arrondissement_communes;code_insee_commune\nB;A;1;x;T;75001\n")
    with pytest.raises(Exception, match="(?i)header"):
        reference.read_reference_versions(spark, str(tmp_path / "other")).collect()


def test_enrichment_by_collection_time(spark):
    flat = spark.createDataFrame([("A", "2024-01-01T07:00:00+00:00"), ("A", "2024-01-02T07:00:00+00:00"), ("A", "2023-12-31T00:00:00+00:00")], "station_code string, collected_at string")
    ts = lambda d: datetime(2024, 1, d, 6)
    ref = spark.createDataFrame([(ts(1), "A", "one", "1", "c", "t", "k"), (ts(2), None, None, None, None, None, None)],
                                "version_ts timestamp, station_code string, station_name string, capacity string, coordinates string, town_name string, town_code string")
    assert rows(live.enrich_asof(flat, ref), "collected_at", "station_name") == sorted(
        [("2023-12-31T00:00:00+00:00", "one"), ("2024-01-01T07:00:00+00:00", "one"), ("2024-01-02T07:00:00+00:00", None)], key=repr)
    assert {r.station_name for r in live.enrich_asof(flat, ref, min_named=1).collect()} == {"one"}


def test_stream_dedup_across_batches(spark, tmp_path):
    source = tmp_path / "in"
    schema = "station_id long, collected_at timestamp"
    for i, minutes in enumerate([(0, 0, 1), (1, 2)]):
        frame = spark.createDataFrame([(1, datetime(2024, 1, 1, 0, m)) for m in minutes], schema)
        frame.coalesce(1).write.mode("append").parquet(str(source))
        out = live.dedup_stream(spark.readStream.schema(schema).parquet(str(source)), "1 hour")
        query = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")).select(F.minute("collected_at"))) == [(0,), (1,), (2,)]


def test_rate_of_a_stream(spark, tmp_path):
    from dockwatch.plans.monitoring import rate_per_minute

    schema = "ts timestamp"
    frame = spark.createDataFrame([(datetime(2024, 1, 1, 0, m),) for m in (0, 0, 1, 4, 9)], schema)
    frame.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in")).withWatermark("ts", "10 minutes")
    query = rate_per_minute(stream).writeStream.format("memory").queryName("rates").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.table("rates")) == rows(rate_per_minute(frame))
    assert live.lag_of(query)


def test_audit_from_raw_files(spark, tmp_path):
    from dockwatch.operators.asof import asof_version, attach_reference
    from dockwatch.plans.conformance import audit_path
    from dockwatch.plans.readings import type_raw
    from dockwatch.session import materialise

    version(tmp_path, "2024-01-01", "000000", ["A;Stop  A;10;48.8, 2.3;Town;75001", "B;Stop B;0;48.8, 2.3;Town;75001"])
    version(tmp_path, "2024-01-01", "000030", [";;;;;"])
    folder = tmp_path / "raw/api/date=2024-01-01"
    folder.mkdir(parents=True)
    lost = json.loads(message(1, None, 1, 4, 1))
    lost["num_bikes_available_types"] = [{}, {}]
    polls = {"000000": [message(1, "A", 0), message(2, "B", 0)], "000100": [json.dumps(lost)], "000200": [message(1, "A", 2), message(1, "A", 2)],
             "000300": [message(1, "A", 3)]}
    for time, lines in polls.items():
        (folder / f"status_{time}.jsonl").write_text("\n".join(lines) + "\n")

    feed = materialise(type_raw(lake.read_raw_status(spark, str(tmp_path / "raw/api"), cutoff="2024-01-01/000200")), "feed")
    ref = materialise(reference.read_reference_versions(spark, str(tmp_path / "raw/source2")), "reference")
    before = materialise(attach_reference(feed, reference.type_reference(ref), asof_version(feed, ref)), "before")
    out = audit_path(before, ref, min_named=1)
    first = {r.check_id: r.n_anomalies for r in out["before"].collect()}
    # K2: the closed station B (capacity 0) still shows 3 bikes and 5 docks
    assert {c: n for c, n in first.items() if n} == {"C1": 1, "C2": 1, "C3": 3, "U1": 1, "V1": 1, "V5": 1, "K2": 1, "I2": 3}
    assert rows(out["clean"].select(F.minute("collected_at"), "bikes_mechanical", "bikes_electric", "station_name", "split_imputed")) == [
        (0, 2, 1, "Stop A", False), (1, 4, 1, "Stop A", True), (2, 2, 1, "Stop A", False)]
    assert {r.check_id: r.status for r in out["comparison"].collect()}["C1"] == "OK"
    assert rows(out["tables"]["station"], "station_code") == [("A",)]

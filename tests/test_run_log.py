"""The run log holds every run once."""

from dockwatch.contract.operation import runs
from dockwatch.contract.registry import QUERIES
from dockwatch.operators import load
from tests.conftest import rows

SF = "/root/testdata/sf0.01"


def test_query_has_all_runs(spark):
    assert rows(QUERIES["l5_run_log"](spark, SF)) == rows(runs(spark, SF))


def test_frame_of_lines_replaces_only_its_runs(spark, tmp_path):
    path, lines = f"{tmp_path}/runs", runs(spark, SF)
    first = lines.orderBy("run_id").first()
    load.record_run(spark, path, {**first.asDict(), "rows_raw": 0})
    load.record_run(spark, path, {**first.asDict(), "run_id": "other"})
    load.record_run(spark, path, lines)
    log = {r.run_id: r.rows_raw for r in load.read_runs(spark, path).collect()}
    assert log == {"other": first.rows_raw, **{r.run_id: r.rows_raw for r in lines.collect()}}

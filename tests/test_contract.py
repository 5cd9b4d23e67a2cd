"""Representative registered queries against their SQL; tests/contract_check.py runs all of them."""

import pytest

import __spark_entry__ as entry
from dockwatch.contract.registry import ORACLES, QUERIES
from tests.contract_check import compare, connect

SF = "/root/testdata/sf0.001"
SAMPLE = ["s1_explode", "s8_flatten", "s6_reference_files", "p3_typing", "p12_types", "p14_rejected", "j3_asof", "j5_attach", "j10_not_in_list",
          "j16_radius", "w1_neighbours", "a5_kpis", "a8_fill_rate", "a18_reference_changes", "q_audit_before", "q_base", "l2_upsert_stations",
          "l7_violations", "t5_rate", "t6_cumulative", "q_audit_dirty", "r_journal_faulty", "j7_stored_state", "a6_stored_series", "m5_stream_report",
          "t8_carried_codes", "l5_run_log", "l6_reading_ids", "u1_stack", "s4_raw_zone", "a17_breakdown_u2", "a17_breakdown_c4", "w6_ranked_order",
          "p19_duplicate_fields", "q_audit_incremental", "t1_exactly_once", "l2_bucketed", "l7_violations_once", "j5_attach_history", "a13_bitmaps"]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_query(spark, con, name):
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF) is None


def test_every_query_has_checking_sql():
    assert set(QUERIES) == set(ORACLES)


def test_planted_faults_trigger_every_rule(spark):
    sf = "/root/testdata/sf0.01"
    found = {r.check_id: r.n_anomalies for r in entry.queries()["q_audit_dirty"](spark, sf).collect()}
    assert len(found) == 18 and all(found.values()), found
    touched = {r.rule: r.n_rows for r in entry.queries()["r_journal_faulty"](spark, sf).collect()}
    assert len(touched) == 12 and all(touched.values()), touched
    broken = {(r.table_name, r.rule): r.violations for r in entry.queries()["l7_violations"](spark, sf).collect()}
    kinds = {}
    for (_, rule), n in broken.items():
        kinds[rule.split()[0]] = kinds.get(rule.split()[0], 0) + n
    assert set(kinds) == {"not", "length", "check", "smallint", "primary", "unique", "foreign"} and all(kinds.values()), kinds


def test_entry(spark):
    assert entry.entry(spark).count() == 18

"""The query on duplicate fields flattens whole messages: all columns of every message, with each way the names can come."""

from datetime import datetime

from dockwatch.contract.feed import p19, s8
from tests.conftest import rows


def test_whole_messages(spark, tmp_path):
    events = [(i, datetime(2024, 1, 1, i % 24), 10 + i, "view" if i % 2 else "click", 1.0, f'{{"k": {i + 5}}}') for i in range(12)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    got, first = p19(spark, str(tmp_path)), s8(spark, str(tmp_path))
    assert got.columns == first.columns
    expected = [*rows(first), *((*r[:3], *((None,) if int(r[2]) % 3 == 1700000000 % 3 else (r[3],)), *r[4:6],
                                 *((None,) if int(r[2]) % 3 == 1700000000 % 3 else (r[6],)), *r[7:]) for r in rows(first))]
    assert sorted(expected, key=repr) == rows(got)
    assert sum(r.docks_free is None for r in got.collect()) == 4

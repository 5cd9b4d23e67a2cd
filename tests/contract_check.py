"""Compare every registered query with its SQL on the supplied tables.

    python tests/contract_check.py [sf_dir] [name prefix ...]
"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP", "date": "DATE", "smallint": "SMALLINT", "decimal(10,2)": "DECIMAL(10,2)", "decimal(38,0)": "DECIMAL(38,0)"}


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir):
    """None when equal, else what differs."""
    frame = query(spark, sf_dir)
    got = [tuple(r) for r in frame.collect()]
    if sql is None:
        return None if got else "no rows (no SQL)"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    mine = {f: t for f, t in frame.dtypes}
    if sorted(mine) != sorted(columns):
        return f"columns {sorted(mine)} != {sorted(columns)}"
    wrong = {c: (mine[c], types[c]) for c in mine if KINDS.get(mine[c]) != types[c]}
    if wrong:
        return f"types {wrong}"
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    a, b = rows_of(list(frame.columns), got), rows_of(columns, expected)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(diff)} rows differ, first {diff[0]}"
    return None


def main():
    import __spark_entry__ as entry
    from dockwatch.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", extra={"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, query, oracles.get(name), sf_dir)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        n = "" if problem else ("ok" if name in oracles else "rows only")
        print(f"{name:28s} {time.time() - start:6.2f}s {n}{problem or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

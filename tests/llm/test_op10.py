"""Prefix forest against brute force."""

import numpy as np
from pyspark.sql import functions as F

from dockwatch.llm.op10_ann import nearest
from dockwatch.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def exact(rows, k=5):
    """rows: id -> vector."""
    ids = np.array(sorted(rows))
    v = np.array([rows[i] for i in ids], float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    out = {}
    for n, i in enumerate(ids):
        if i % 50 == 0:
            s = v @ v[n]
            order = [j for j in np.lexsort((ids, -np.round(s, 12))) if j != n][:k]
            out[int(i)] = [int(ids[j]) for j in order]
    return out


def test_recall_and_scores(spark):
    got = {}
    for r in QUERIES["op10_nearest"](spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    want = exact(rows)
    assert got.keys() == want.keys()
    assert all([x[0] for x in found] == [1, 2, 3, 4, 5] for found in got.values())
    recall = np.mean([len({x[1] for x in got[q]} & set(want[q])) / 5 for q in want])
    assert recall >= 0.9
    for q, found in got.items():
        for _, i, score in found:
            a, b = np.array(rows[q], float), np.array(rows[i], float)
            assert abs(score - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_copies_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(3)
    rows = {i: rng.normal(size=8).tolist() for i in range(1, 400)}
    for i in range(100, 300):
        rows[i] = rows[100]
    bad = [(1000, None), (1050, [0.0] * 8), (1100, [1.0, None] * 4), (1150, [float("nan")] * 8), (None, [1.0] * 8), (1200, []), (1250, [1.0, 2.0])]
    given = list(rows.items()) + [(5, rows[5])] + bad
    df = spark.createDataFrame(given, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = {}
    for r in nearest(df, F.col("id") % 50 == 0, block_rows=64, query_rows=2, least=1000).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == exact(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nearest(df, F.col("id") % 50 == 0).collect() == []

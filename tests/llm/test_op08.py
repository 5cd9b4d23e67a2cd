"""Mixing of domains that are rare, absent or out of reach."""

import warnings

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dockwatch.llm import op08_mixing
from dockwatch.llm.common import repeat_rows
from dockwatch.llm.queries import MIXTURE, domain_labels

SF = "/root/testdata/sf0.01"
op08_mixing_fit = op08_mixing.fit_rates


def posteriors(centre, spread, n=20_000):
    rng = np.random.default_rng(1)
    z = np.exp(rng.normal([3, 0, centre], [1, 1.5, spread], (n, 3)))
    return z / z.sum(1, keepdims=True), rng.integers(1, 1000, n)


def frame(spark, p, t):
    data = pa.table({"tokens": pa.array(t), "posterior": pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * 3), pa.array(p.ravel()))})
    return spark.createDataFrame(data)


def test_rare_domain_is_met(spark):
    p, t = posteriors(-4, 1.2)
    assert (t @ p / t.sum())[2] < 0.004
    steps, now, target = op08_mixing.fit_rates(frame(spark, p, t), [0.9, 0.07, 0.03])
    r = op08_mixing.rates(p, steps)
    assert 1 <= len(steps) <= 20 and (r >= 0).all() and np.allclose((r * t) @ p, now)
    assert np.abs(now - target).max() <= op08_mixing.TOLERANCE * t.sum()


def test_domain_out_of_reach_is_reported(spark, monkeypatch):
    p, t = posteriors(-9, 0.5)  # no document is of the domain by 3 %
    assert p[:, 2].max() < 0.03
    steps, now, target = op08_mixing.fit_rates(frame(spark, p, t), [0.9, 0.07, 0.03])
    assert np.allclose((op08_mixing.rates(p, steps) * t) @ p, now) and abs(now.sum() / t.sum() - 1) < 0.04  # about 0.03 of it is missing
    monkeypatch.setattr(op08_mixing, "fit_rates", lambda table, shares, **kw: (steps, now, target))
    docs = spark.createDataFrame([(1, "a b"), (2, "c d"), (3, "e")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "doc_id long, domain string")
    with pytest.warns(RuntimeWarning, match="c 0.00.. instead of 0.0300"):
        report = op08_mixing.fit_mixture(docs, labels, {"a": 0.9, "b": 0.07, "c": 0.03})[3]
    assert [(d, round(w, 4)) for d, w, _ in report] == [("a", 0.9), ("b", 0.07), ("c", 0.03)] and report[2][2] < 0.01
    # given up, it leaves the others to their proportions
    steps, now, target = op08_mixing_fit(frame(spark, p, t), [0.9, 0.07, 0.03], free=[2])
    assert np.allclose(now[:2] / now[:2].sum(), [0.9 / 0.97, 0.07 / 0.97], atol=0.002) and np.allclose((op08_mixing.rates(p, steps) * t) @ p, now)
    capped = op08_mixing.rates(p, op08_mixing_fit(frame(spark, p, t), [0.5, 0.5, 0.0], cap=3)[0], cap=3)
    assert capped.max() <= 3


def test_equals_a_plain_projected_gradient(spark):
    """Document by document, with the step that always descends: the same totals, and the same least squares where they are out of reach."""
    for centre, spread, shares in ((-2, 1.0, [0.6, 0.3, 0.1]), (-4, 1.2, [0.9, 0.07, 0.03]), (-9, 0.5, [0.9, 0.07, 0.03])):
        p, t = posteriors(centre, spread, 3000)
        steps, now, target = op08_mixing.fit_rates(frame(spark, p, t), shares)
        largest = np.linalg.eigvalsh((p * t[:, None]).T @ p)[-1]
        r = np.ones(len(p))
        for _ in range(30_000):
            miss = (r * t) @ p - target
            if np.abs(miss).max() <= op08_mixing.TOLERANCE * t.sum():
                break
            r = np.maximum(0, r - p @ miss / largest)
        plain, least = (r * t) @ p - target, op08_mixing.TOLERANCE * t.sum()
        assert np.linalg.norm(now - target) <= max(1.15 * np.linalg.norm(plain), 2 * least)
        assert (np.abs(now - target).max() <= least) == (centre != -9)


def staged(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = op08_mixing.materialise(stage(spark, docs, sf), "stage")
    return docs


def test_stage_input_of_the_pipeline(spark):
    """The mixture knows every target after the rules and the classifier took all junk, and its report tells what it reached."""
    docs = staged(spark, SF)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)
        corpus_pipeline.mixture(spark, docs, SF)
        labels = spark.read.parquet(f"{SF}/labels.parquet").where(~corpus_pipeline.held_out(F.col("doc_id")))
        rows = op08_mixing.mixture_rates(docs, domain_labels(labels), MIXTURE, taught_by=spark.read.parquet(f"{SF}/documents.parquet"), cap=corpus_pipeline.MOST_COPIES).collect()
    report = {r.domain: (r.wanted, r.reached) for r in spark.read.parquet(corpus_pipeline.MIXTURE_REPORTS[-1]).collect()}
    assert rows[0].domains == ["clean", "junk", "toxic"] and set(report) == set(MIXTURE)
    tokens = sum(r.tokens for r in rows)
    for k, domain in enumerate(rows[0].domains):
        wanted, reached = report[domain]
        assert abs(wanted - MIXTURE[domain]) < 1e-9 and abs(sum(r.rate * r.tokens * r.posterior[k] for r in rows) / tokens - reached) < 1e-6
    # junk is out of reach once the rules have judged: the report says so, and the others keep their proportions
    assert report["junk"][1] < 0.01 < report["junk"][0]
    assert abs(report["clean"][1] / report["toxic"][1] - 0.9 / 0.07) < 0.5
    gone = sum(r.copies == 0 for r in rows) / len(rows)
    assert gone < 0.1 and max(r.rate for r in rows) <= corpus_pipeline.MOST_COPIES
    assert {(r.domain, r.wanted, r.reached) for r in rows[0].report} == {(d, *x) for d, x in report.items()}


def test_targets_without_labels_are_reported(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, "c d"), (3, "e")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, domain string")
    with pytest.warns(RuntimeWarning, match="gone 0.0000 instead of 0.5000"):
        op08_mixing.mix_rows(docs, labels, {"a": 1, "b": 1, "gone": 2}, report_path=f"{tmp_path}/report").collect()
    assert {(r.domain, r.wanted) for r in spark.read.parquet(f"{tmp_path}/report").collect()} == {("a", 0.25), ("b", 0.25), ("gone", 0.5)}


def test_rows_without_tokens_and_many_copies():
    assert op08_mixing.rates(np.array([[1.0], [1.0]]), [np.array([-99.0])], [5, 0]).tolist() == [100, 1]

    class Frame:
        columns, schema = ["text"], None

        def mapInArrow(self, run, schema):
            return list(run(iter([pa.record_batch({"text": ["word " * 20_000]})])))

    sizes = [b.num_rows for b in repeat_rows(Frame(), "text", lambda data, offsets: [200])]
    assert sum(sizes) == 200 and max(sizes) < 50

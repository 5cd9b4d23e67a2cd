"""Near-duplicates against brute force."""

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockwatch.llm.components import components
from dockwatch.llm.op06_neardup import near_duplicates, one_permutation
from dockwatch.llm.queries import QUERIES
from tests.llm import brute

KINDS = "doc_id long, text string"


def check(got, rows, k, threshold):
    want = brute.components(rows, k, threshold)
    seen = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got]
    expected = [(i, len(brute.shingles(t, k)), want.get(i), i is None or want[i] == i) for i, t in rows]
    assert sorted(map(repr, seen)) == sorted(map(repr, expected))


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op6_near_duplicates"](spark, sf).collect(), rows, 3, Fraction(85, 100))


def edited(rng, words, share):
    return " ".join(f"w{rng.randrange(5000)}" if rng.random() < share else w for w in words)


@pytest.mark.parametrize("k,num,den,worst", [(3, 85, 100, 0.1), (5, 4, 5, 0.08)])
def test_groups_of_near_copies(spark, k, num, den, worst):
    """Groups whose members lie on both sides of the threshold, and copies of copies."""
    rng = random.Random(5)
    rows = []
    for size, length in ((300, 150), (120, 60), (40, 400), (25, 12)):
        source = [f"w{rng.randrange(3000)}" for _ in range(length)]
        made = [" ".join(source)]
        for _ in range(size):
            made.append(edited(rng, rng.choice(made).split() if rng.random() < 0.3 else source, rng.random() * worst))
        rows += made
    rows += rows[:30]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    check(near_duplicates(spark.createDataFrame(rows, KINDS).repartition(6), k=k, num=num, den=den).collect(), rows, k, Fraction(num, den))


def test_odd_rows(spark):
    body = " ".join(f"a{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "Two words"), (5, "two WORDS"), (6, "two  words here"), (7, body), (7, body), (8, body.upper()),
            (9, body + " tail"), (9, "another text with the same id as nine"), (10, "Another text WITH the same id as nine"), (None, body), (None, None),
            (11, "ÄÖ Ü ß é"), (12, "äö ü ß é"), (13, "long " * 50_000), (14, "long " * 60_000)]
    df = spark.createDataFrame(rows, KINDS).select("*", F.lit(1).alias("id"), F.lit("x").alias("component_id"), F.lit(2).alias("BANDS"))
    check(near_duplicates(df, k=3, num=85, den=100).collect(), rows, 3, Fraction(85, 100))


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], KINDS)).collect() == []


def test_chain_of_links(spark):
    links = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 502), (502, 500), (900, 900)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500, 502: 500}


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    for size in (40, 400):
        base = rng.integers(0, 2**63, size, dtype=np.uint64)
        agree = []
        for _ in range(60):
            base = rng.integers(0, 2**63, size, dtype=np.uint64)
            other = base.copy()
            other[: size // 10] = rng.integers(0, 2**63, size // 10, dtype=np.uint64)
            s = one_permutation([np.unique(base), np.unique(other)], 252)
            agree.append((s[0] == s[1]).mean())
        assert abs(np.mean(agree) - 0.9 / 1.1) < 0.03


def test_split_by_ids(spark):
    from dockwatch.llm.common import split_by_ids

    df = spark.createDataFrame([(i if i else None, f"t{i}") for i in range(3000)], "doc_id long, _word string")
    ids = spark.createDataFrame([(i,) for i in range(-5, 3000, 7)] + [(None,)], "doc_id long")
    maybe, not_there = split_by_ids(df, "doc_id", ids)
    a, b = [r.doc_id for r in maybe.collect()], [r.doc_id for r in not_there.collect()]
    assert len(a) + len(b) == 3000 and maybe.columns == df.columns
    wanted = {i for i in range(-5, 3000, 7) if i > 0}
    assert wanted <= set(a) and len(a) < len(wanted) + 30 and None in b

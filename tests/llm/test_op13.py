"""Merkle manifest against a plain recursive version, with small fanouts so that the butterfly has several rounds."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from dockwatch.llm.op13_manifest import butterfly, manifest
from dockwatch.llm.queries import QUERIES, tampered_text


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, fanout):
    """Root and, per leaf, the (left, right) neighbours level by level."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + fanout] for i in range(0, len(nodes), fanout)]
        for k, p in enumerate(place):
            run, d = runs[p // fanout], p % fanout
            paths[k].append(("".join(run[:d]), "".join(run[d + 1:])))
        place = [p // fanout for p in place]
        nodes = [sha("".join(run)) for run in runs]
    return nodes[0], paths


def plain(rows, change, fanout=8):
    """rows: doc_id, text, lang, source, n_chars."""
    groups = defaultdict(list)
    for i, text, lang, source, n in rows:
        later = change(i, text)
        groups[lang].append((i is not None, i or 0, leaf((i, source, lang, n, text)), leaf((i, source, lang, n, later)), i))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    done = {g: climb([x[2] for x in sorted(groups[g])], fanout) for g in names}
    root, tops = climb([done[g][0] for g in names], fanout)
    out = []
    for g, top in zip(names, tops):
        for (_, _, first, later, i), path in zip(sorted(groups[g]), done[g][1]):
            node = later
            for a, b in path + top:
                node = sha(a + node + b)
            out.append((i, first, done[g][0], root, sha("".join(a + b for a, b in path + top)), node, node == root))
    return sorted(out, key=repr)


def tampered(i, text):
    if text is None or i is None or zlib.crc32(str(i).encode()) % 3:
        return text
    return text.translate({c: c + 32 for c in range(65, 91)})


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def made(spark, rows, **kw):
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "'c' as id", "0 as grp", "1 as leaf", "2 as row", "3 as block", "true as named", "'r' as root")
    return sorted((tuple(r) for r in manifest(df, changed={"text": tampered_text()}, **kw).collect()), key=repr)


@pytest.mark.parametrize("fanout, levels", [(8, 4), (2, 1), (3, 0), (2, 3)])
def test_against_the_plain_version(spark, fanout, levels):
    rng = random.Random(fanout)
    ids = rng.sample(range(10_000), 70)
    rows = [(i, rng.choice([None, "", "Some Text ä" * rng.randint(1, 4), "plain"]), rng.choice(["en"] * 5 + ["de", "fr", None, "", "é"]), rng.choice([None, "s"]), rng.choice([None, i])) for i in ids]
    rows += [(10_001, "Alone", "zz", "s", 1)]
    got = made(spark, rows, fanout=fanout, levels=levels)
    assert got == plain(rows, tampered, fanout)
    assert 0 < sum(r[6] for r in got) < len(got)


@pytest.mark.parametrize("size", [1, 2, 7, 8, 9, 10, 64, 65, 100])
def test_butterfly_of_any_size(spark, size):
    fanout = 8 if size > 9 else 2
    leaves = [sha(str(i)) for i in range(size)]
    nodes = spark.createDataFrame([(i, size, h) for i, h in enumerate(leaves)], "p long, size long, h string")
    root, paths = climb(leaves, fanout)
    rows = {r.p: r for r in butterfly(nodes, [], fanout).collect()}
    assert sorted(rows) == list(range(size))
    for i, path in enumerate(paths):
        assert rows[i].h == root and list(zip(rows[i].lefts, rows[i].rights)) == path


def test_repeats_null_ids_and_empty_tables(spark):
    rows = [(None, "X", "en", None, None)] * 30 + [(5, "Same", None, "s", 4)] * 20 + [(5, "other", None, "s", 4), (None, None, None, None, None)]
    assert made(spark, rows, levels=1) == plain(rows, tampered)
    assert made(spark, rows[:1]) == plain(rows[:1], tampered)
    assert manifest(spark.createDataFrame([], DOCS)).collect() == []


def test_unchanged_rows_verify(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert manifest(docs).where(~F.col("verified")).count() == 0
    hit = {r.doc_id for r in QUERIES["op13_manifest"](spark, "/root/testdata/sf0.001").where(~F.col("verified")).collect()}
    assert hit and all(zlib.crc32(str(i).encode()) % 3 == 0 for i in hit)

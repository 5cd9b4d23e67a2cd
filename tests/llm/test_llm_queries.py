"""Queries against their SQL, laws of sharding, packing and mixing, and odd rows of every operator."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dockwatch.llm import op02_packing, op08_mixing
from dockwatch.llm.op01_gam import AdditiveModel, keep_good, quality_scores
from dockwatch.llm.op05_rules import RULES, keep_passing, quality_rules
from dockwatch.llm.op06_neardup import keep_one
from dockwatch.llm.op07_urls import filter_urls
from dockwatch.llm.op09_shards import interleaved_shards
from dockwatch.llm.queries import MIXTURE, ORACLES, QUERIES, domain_labels
from tests.contract_check import compare, connect

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, source string"
ODD = [(1, None, "a"), (2, "", None), (3, " \n\t\n ", "a"), (3, "x", "b"), (None, "some words here", None), (None, None, "a"),
       (5, "word " * 40_000, "b"), (6, "ÄÖÜ ß 日本\n\n" * 30, "a"), (7, "a", "a"), (7, "a", "a"), (7, "a", "a")]


@pytest.fixture
def odd(spark):
    clash = ["id", "kept", "rule", "n_words", "score", "x", "bucket", "tokens", "size", "shard", "slot", "b", "posterior"]
    return spark.createDataFrame(ODD, DOCS).select("*", *[F.lit("clash").alias(c) for c in clash])


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    assert compare(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF) is None


# quality rules

def test_order_changes_no_verdict(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [sorted((r.doc_id, r.kept) for r in quality_rules(docs, order=o).collect()) for o in (list(RULES), list(RULES)[::-1])]
    assert seen[0] == seen[1] and 0 < sum(k for _, k in seen[0]) < len(seen[0])
    kept = {r.doc_id for r in keep_passing(docs).collect()}
    assert kept == {i for i, k in seen[0] if k}


def test_rules_on_odd_rows(odd, none):
    rows = quality_rules(odd, report=("n_words", "n_dup_lines")).collect()
    assert len(rows) == len(ODD)
    got = {r.doc_id: (r.n_words, r.kept, r.rule) for r in rows if r.doc_id in (1, 5)}
    assert got[1] == (0, False, "few_words") and got[5][0] == 40_000 and got[5][1:] == (False, "repeated_windows")
    assert quality_rules(none).collect() == [] and keep_passing(none).collect() == []
    assert keep_passing(odd).columns == odd.columns


# classifier

def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op1_quality_classifier"](spark, sf).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [r.score for r in held if labels[r.doc_id] == 1], [r.score for r in held if labels[r.doc_id] == 0]
    auc = np.mean([np.mean([(g > b) + 0.5 * (g == b) for b in bad]) for g in good])
    assert auc > 0.99 and np.mean(np.array(good) >= 0.3) > 0.99 and np.mean(np.array(bad) < 0.3) > 0.95


def test_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)).astype(int)
    model = AdditiveModel(pairs=2).fit(x, y)
    fresh = rng.random((1000, 4))
    assert (0, 2) in [pair for pair, _ in model.grids]
    assert np.mean((model.score(fresh) > 0.5) == ((fresh[:, 0] > 0.5) ^ (fresh[:, 2] > 0.5))) > 0.9


def test_scores_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 1), (5, 0), (7, None), (None, 1), (99, 1)], "doc_id long, quality int")
    rows = quality_scores(odd, labels).collect()
    assert len(rows) == len(ODD) and len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    empty = labels.limit(0)
    assert {r.score for r in quality_scores(odd, empty).collect()} == {0.5}
    assert quality_scores(none, labels).collect() == [] and keep_good(none, empty).collect() == []
    assert keep_good(odd, empty).count() == len(ODD)


# URL filters

def test_rules_fit_hosts_and_paths(spark):
    rules = [("org", "/", "allow"), ("example.org", "/a", "block"), ("www.example.org", "/a/b", "allow"), ("Example.ORG", "/a/", "allow"), ("x.net", "", "block"),
             ("x.net", "/é", "allow"), ("", "/", "block"), (None, "/", "block"), ("x.net", None, "block"), ("two.com", "/", "allow"), ("two.com", "/", "block"), ("y.org", "/x", None)]
    rules = [(h and h.lower(), p, v) for h, p, v in rules]
    rng = np.random.default_rng(1)
    hosts = ["org", "example.org", "www.example.org", "a.www.example.org", "notexample.org", "WWW.X.NET", "x.net", "x-y.net", "two.com", "", "net", "example.org.", "user@x.net:80"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/a/bc?x=/", "/A", "/é", "/é/x#y", "?q", "#f", "/b//a"]
    urls = [f"{s}://{h}{p}" for s in ("http", "https") for h in hosts for p in paths] + [None, "", "no scheme/a", "://", "http://x.net/a://example.org/a", "x\n://example.org\n/a"]
    rows = [(int(i) if i < 300 else None, urls[i % len(urls)]) for i in range(400)]
    rng.shuffle(rows)

    def judge(url):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, path = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
            path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
        fits = [(len(h) + len(p or ""), len(h), h + (p or ""), v) for h, p, v in rules if h and v and host and ("." + host).endswith("." + h) and path.startswith(p or "")]
        best = max(fits, default=None)
        return host, path, best[2] if best else None, best[3] if best else "allow"

    df = spark.createDataFrame([(int(i) if i is not None else None, u) for i, u in rows], "page_id long, url string").selectExpr("*", "'c' as host", "'c' as path", "1 as verdict", "2 as won")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = filter_urls(df, table, sweep_rows=7).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == Counter((i, *judge(u)) for i, u in rows)
    assert filter_urls(df.limit(0), table).collect() == []
    assert {r.verdict for r in filter_urls(df, table.limit(0), default="block").collect()} == {"block"}


# sharding

def laws(rows, shards, given):
    """Counts at most one apart, gapless slots, every row once, the mixture in every shard."""
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    sizes = [len(by[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(r.slot for r in by[s]) == list(range(n)) for s, n in enumerate(sizes))
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), s) for i, t, s in given)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.source) for r in rows) == want
    sources = Counter(s for _, _, s in given)
    for s in range(shards):
        mixture = Counter(r.source for r in by[s])
        for source, n in sources.items():
            assert abs(mixture[source] - n / shards) < 4  # its own rounding and that of the other sources


def test_sharding(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    given = [tuple(r) for r in docs.collect()] + [(i, "same text", "src0") for i in range(5000, 5700)]
    frame = spark.createDataFrame(given, DOCS).repartition(5)
    first = interleaved_shards(frame, 40, bucket_rows=50).collect()
    laws(first, 40, given)
    again = interleaved_shards(frame.repartition(3, "source"), 40, bucket_rows=50).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in first} == {(r.doc_id, r.shard, r.slot) for r in again}
    laws(interleaved_shards(odd, 3).collect(), 3, ODD)
    assert len(interleaved_shards(odd, 40).collect()) == len(ODD) and interleaved_shards(none, 40).collect() == []


# packing

def test_bounds_are_optimal():
    rng = np.random.default_rng(4)
    for _ in range(30):
        edges = np.sort(rng.choice(60, 9, replace=False) + 1)
        counts = rng.integers(1, 20, 9)

        def padded(bounds):
            return sum(int(c) * min(b for b in bounds if b >= e) for e, c in zip(edges, counts))

        import itertools
        for k in (1, 2, 4, 12):
            best = min(padded([*(edges[i] for i in cut), edges[-1]]) for n in range(min(k, 9)) for cut in itertools.combinations(range(8), n))
            bounds = op02_packing.best_bounds(edges, counts, k)
            assert len(bounds) <= k and bounds[-1] == edges[-1] and padded(bounds) == best


def check_packing(rows, lengths, budget):
    assert Counter((r.id, r.n_tokens) for r in rows) == Counter(lengths)
    batches = defaultdict(list)
    for r in rows:
        batches[r.bucket, r.batch].append(r)
        assert r.n_tokens <= r.padded_to
    by_bucket = defaultdict(set)
    for (bucket, batch), held in batches.items():
        assert sorted(r.slot for r in held) == list(range(len(held)))
        assert len(held) == 1 or len(held) * held[0].padded_to <= budget
        by_bucket[bucket].add(batch)
    assert all(b == set(range(len(b))) for b in by_bucket.values())
    full = [len(h) for (bucket, batch), h in batches.items() if batch < max(by_bucket[bucket])]
    assert all(n == max(1, budget // h[0].padded_to) for (bucket, batch), h in batches.items() if batch < max(by_bucket[bucket]) for n in [len(h)]) or not full


def test_packing(spark):
    rng = np.random.default_rng(2)
    lengths = [(int(i), int(n)) for i, n in enumerate(np.exp(rng.normal(5, 1.5, 3000)).astype(int) + 1)] + [(i, 77) for i in range(4000, 5000)] + [(None, 5), (1, 9), (1, 9), (6000, 3_000_000)]
    frame = spark.createDataFrame(lengths, "id long, n_tokens long")
    check_packing(op02_packing.pack(frame, 8, 4096, bucket_rows=100).collect(), lengths, 4096)
    edges = dict(frame.select("n_tokens", op02_packing.rounded_up(F.col("n_tokens"))).collect())
    assert all(n <= e <= n + max(0, n // 128) + 1 and (n > 1024 or n == e) for n, e in edges.items())


def test_packing_of_odd_rows(spark, odd, none):
    from dockwatch.llm.tokens import tokenizer_file

    rows = op02_packing.pack_documents(odd, tokenizer_file()).collect()
    assert len(rows) == len(ODD) and {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {1}
    assert op02_packing.pack_documents(none, tokenizer_file()).collect() == []


# mixing

def test_rates_reach_the_targets(spark):
    rng = np.random.default_rng(9)
    p = rng.dirichlet([0.3, 0.2, 0.1], 4000)
    t = rng.integers(1, 2000, 4000)
    table = spark.createDataFrame([(int(i), int(n), q.tolist()) for i, (n, q) in enumerate(zip(t, p))], "id long, tokens long, posterior array<double>")
    for shares in ([0.5, 0.3, 0.2], [0.2, 0.2, 0.6], [8, 1, 1]):
        steps, now, target = op08_mixing.fit_rates(table, shares)
        r = op08_mixing.rates(p, steps)
        assert (r >= 0).all() and np.allclose((r * t) @ p, now) and np.abs(now - target).max() <= 0.002 * t.sum()
    same = np.isclose(p[:, 0], p[0, 0])
    assert np.allclose(r[same], r[0])


def test_mixing_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op8_mixing"](spark, sf).collect()
    labels = {r.doc_id: r.domain for r in domain_labels(spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    total = sum(r.tokens for r in rows)
    for k, name in enumerate(rows[0].domains):
        assert abs(sum(r.rate * r.tokens * r.posterior[k] for r in rows) / total - MIXTURE[name]) < 0.002
    guess = [(r.domains[int(np.argmax(r.posterior))], labels[r.doc_id]) for r in rows if r.doc_id in labels]
    assert np.mean([a == b for a, b in guess]) > 0.9
    assert all(r.rate >= 0 and abs(r.copies - r.rate) < 1 and abs(sum(r.posterior) - 1) < 1e-9 for r in rows)
    assert abs(sum(r.copies * r.tokens for r in rows) / sum(r.rate * r.tokens for r in rows) - 1) < 0.03


def test_mixing_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, "a"), (5, "b"), (7, None), (None, "a"), (3, "other")], "doc_id long, domain string")
    rows = op08_mixing.mixture_rates(odd, labels, {"a": 1, "b": 1, "gone": 5}).collect()
    assert len(rows) == len(ODD) and all(r.domains == ["a", "b"] for r in rows)
    assert {r.rate for r in op08_mixing.mixture_rates(odd, labels.limit(0), {"a": 1}).collect()} == {1.0}
    assert op08_mixing.mixture_rates(none, labels, {"a": 1}).collect() == [] and op08_mixing.mix_rows(none, labels, {"a": 1, "b": 2}).collect() == []
    mixed = op08_mixing.mix_rows(odd, labels, {"a": 1, "b": 1})
    copies = Counter()
    for r in op08_mixing.mixture_rates(odd, labels, {"a": 1, "b": 1}).collect():
        copies[r.doc_id] += r.copies
    assert +copies == Counter(r.doc_id for r in mixed.collect()) and mixed.columns == odd.columns


# pipeline

def test_keep_one(spark, odd):
    rows = keep_one(odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter([1, 2, 3, None, None, 5, 6, 7])


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    held = docs
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, held, SF)
        assert after.schema == held.schema
        assert all(rows[r.doc_id] == r for r in after.collect())
        seen.append(Counter(r.doc_id for r in after.collect()))
        held = spark.createDataFrame(after.collect(), docs.schema)
    assert all(set(b) <= set(a) for a, b in zip(seen, seen[1:])) and all(max(s.values()) == 1 for s in seen[:3])
    judged = {r.doc_id for r in quality_rules(docs).where("kept").collect()}
    assert set(seen[0]) == judged
    out = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in out) == seen[3]


def test_the_classifier_stage_drops_bad_texts_that_pass_the_rules(spark, tmp_path):
    """The stage's input holds labels of one quality only; it learns from the whole table and drops bad texts no rule rejects."""
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    docs = corpus_pipeline.quality_rules(spark, whole, SF)
    good = [r.text for r in docs.orderBy("doc_id").limit(85).collect()]
    # shouted words, but too few for the rule on capitals
    bad = [" ".join((w.upper() if n % 2 else w.lower()) + "!!" for n, w in enumerate(t.split()[:300])) for t in good]
    rows = spark.createDataFrame([(10_000_000 + i, t, "en", "src0", len(t)) for i, t in enumerate(bad)], docs.schema)
    assert corpus_pipeline.quality_rules(spark, rows, SF).count() == len(bad)
    taught = rows.where("doc_id < 10000060")  # labelled, and no longer among the stage's rows
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    whole.unionByName(taught).write.parquet(f"{tmp_path}/documents.parquet")
    labels.unionByName(taught.selectExpr("doc_id", "0 as quality", "0 as toxic").select(*[F.col(f.name).cast(f.dataType) for f in labels.schema])).write.parquet(f"{tmp_path}/labels.parquet")
    given = docs.unionByName(rows.where("doc_id >= 10000060"))
    assert {r.quality for r in labels.join(given, "doc_id").select("quality").distinct().collect()} == {1}
    ids = {r.doc_id for r in corpus_pipeline.quality_classifier(spark, given, str(tmp_path)).select("doc_id").collect()}
    assert sum(i >= 10_000_000 for i in ids) <= 1 and len(ids) >= 0.98 * docs.select("doc_id").distinct().count()


def test_split_by_ids_with_clashing_columns(spark):
    from dockwatch.llm.common import split_by_ids

    df = spark.createDataFrame([(1, "a", 2, 3), (2, "b", 3, 4), (None, "c", 1, 1)], "doc_id long, _word string, _word_bits int, _WORD_bit int")
    maybe, rest = split_by_ids(df, "doc_id", df.where("doc_id = 1").select("doc_id"))
    assert 1 in {r.doc_id for r in maybe.collect()} and maybe.columns == rest.columns == df.columns
    assert maybe.count() + rest.count() == 3
    text = spark.createDataFrame([(1, "x", 2, 3)], "doc_id long, text string, _word_bits int, _word_bit int")
    assert keep_one(text).columns == text.columns and keep_one(text).count() == 1


def test_pipeline_of_odd_rows(spark, odd, none, tmp_path):
    spark.createDataFrame([(5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, str(tmp_path)).columns == docs.columns
            stage(spark, docs, str(tmp_path)).collect()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


# the cascade

def test_later_rules_count_living_rows_only(monkeypatch):
    from dockwatch.llm import op05_rules as C

    rng = np.random.default_rng(6)
    long = [" ".join(f"w{n}" for n in rng.integers(0, 10_000, 80)) for _ in range(10)]
    texts = [t for i in range(10) for t in ["too short"] * 99 + [long[i]]]
    raw = [t.encode() for t in texts]
    seen = defaultdict(list)

    def spy(name, metric):
        def run(t):
            seen[name].append(t.rows)
            return metric(t)
        return run

    plain = {m: f(C.Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))) for m, f in C.METRICS.items()}
    monkeypatch.setattr(C, "METRICS", {m: spy(m, f) for m, f in C.METRICS.items()})
    given = C.Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    verdict = C.run_cascade(given, C.RULES, ["few_words", "repeated_windows", "symbols", "repeated_lines", "shouting", "word_length"])
    assert seen.pop("n_words") == [1000] and all(rows == [10] for rows in seen.values()) and len(seen) == 7
    assert (verdict[99::100] == -1).all() and (verdict >= 0).sum() == 990
    # metrics of a part equal those of all
    at = np.sort(rng.choice(1000, 300, replace=False))
    alive = np.zeros(1000, bool)
    alive[at] = True
    for known in (False, True):
        t = C.Texts(given.data, given.offsets)
        if known:
            t.spans()
        assert all((t.metric(m, alive)[at] == plain[m][at]).all() for m in plain)


def test_order_of_rules_does_not_change_between_runs(spark):
    from dockwatch.llm.op05_rules import plan_order

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    orders = [plan_order(d, "doc_id", "text", RULES) for d in (docs, docs.repartition(7), docs)]
    assert orders[0] == orders[1] == orders[2] and sorted(orders[0]) == sorted(RULES)
    huge = spark.createDataFrame([(1, "word " * 400_000), (1, "x"), (2, None)], "doc_id long, text string")
    assert sorted(plan_order(huge, "doc_id", "text", RULES)) == sorted(RULES)

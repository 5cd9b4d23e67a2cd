"""Resampling: payload composition, the dictionary, and whole results against a plain version."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from dockwatch.llm import op12_resampling as R
from dockwatch.llm import word_automaton as W

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
TEXTS = ["", None, "a", "A b", "é É ab12_x -- ß\x00q", "x" * 300 + " " + "y" * 1000 + " z", "one two one two", "日本 語x", "!!! ???", "  the\n\nend  "]


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)], len(w)


def plain(rows, target, buckets=10_000, percent=5, min_words=20, seed=42):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(bucket(f) for _, x in rows for f in features(x)[0]), Counter(bucket(f) for x in target for f in features(x)[0])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in s}
    out = []
    for i, x in rows:
        found, n = features(x)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    may = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0]))
    for place, r in enumerate(may[:percent * len(may) // 100]):
        r[4] = place + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def some_texts(n, seed=0):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé日0Z") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    return [rng.choice([" ", ". ", "--"]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def as_bytes(texts):
    raw = [(t or "").encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


@pytest.mark.parametrize("la, lb", [(0, 0), (3, 5), (10, 255), (10, 256), (1, 257), (7, 100_000), (1, 1 << 20)])
def test_composition(la, lb):
    rng = random.Random(la + lb)
    a, b = rng.randbytes(la), rng.randbytes(lb)
    assert W.compose(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([lb]))[0] == zlib.crc32(a + b)


@pytest.mark.parametrize("most", [0, 5, 1000])
def test_buckets_whatever_the_dictionary_holds(most):
    words = W.WordDictionary(most)
    for seed in range(3):
        texts = TEXTS + some_texts(50, seed)
        found, owner, n = W.feature_buckets(*as_bytes(texts), 997, words)
        for i, text in enumerate(texts):
            expected, count = features(text)
            assert sorted(found[owner == i].tolist()) == sorted(zlib.crc32(f.encode()) % 997 for f in expected) and n[i] == count
    assert len(words.known) <= most and (most < 1000 or len(words.automaton) == len(words.known) - words.fresh)


def test_the_automaton_finds_known_words():
    words = W.WordDictionary()
    line, _ = W.line_of(*as_bytes(["the cat the cathedral he"]))
    words.scan(line)
    hits = [(line.tobytes()[e - len(k):e].decode(), v) for e, v in words.automaton.iter(line.tobytes().decode("latin-1")) for k in words.known if words.known[k] == v]
    assert [w for w, _ in hits] == ["the", "cat", "the", "cathedral", "he"]


@pytest.mark.parametrize("window", [10, 64, 5000])
def test_long_texts_window_by_window(window):
    for text in [" ".join(some_texts(40, 5)), "w" * 9000 + " a " + "v" * 9000, "q" * 20_000, " " * 9000 + "a b c d"]:
        data, offsets = as_bytes([text])
        got, words = [], 0
        for _, _, found, _, n in R.scanned(data, offsets, 997, window):
            got += found.tolist()
            words += int(n.sum())
        expected, count = features(text)
        assert sorted(got) == sorted(zlib.crc32(f.encode()) % 997 for f in expected) and words == count


def resampled(spark, rows, target, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' as id", "0 as row", "1 as score", "2 as rank", "3 as weight", "4 as place", "5 as of")
    return R.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), **kw)


def test_against_the_plain_version(spark):
    rows = [*enumerate(some_texts(300, 1)), *enumerate(TEXTS, 1000)]
    for percent in (5, 37, 100, 0):
        got = sorted((tuple(r) for r in resampled(spark, rows, some_texts(20, 2), percent=percent).collect()), key=repr)
        assert got == plain(rows, some_texts(20, 2), percent=percent)


def test_null_ids_repeats_and_empty_tables(spark):
    same = " ".join(["word"] * 30)
    rows = [(None, same)] * 40 + [(7, same)] * 20 + [(8, None), (None, "")]
    got = sorted((tuple(r) for r in resampled(spark, rows, [], percent=50).collect()), key=repr)
    assert got == plain(rows, [], percent=50)
    assert sorted(r[4] for r in got if r[4] is not None) == list(range(1, 31))
    assert resampled(spark, rows[:1], []).limit(0).collect() == [] and resampled(spark, rows, [None]).count() == len(rows)
    assert R.resample(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([("a",)], "text string")).collect() == []

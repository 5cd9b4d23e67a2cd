"""Token counts against the tokenizers library."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from dockwatch.llm import transducer as T
from dockwatch.llm.op11_counts import token_counts
from dockwatch.llm.queries import QUERIES
from dockwatch.llm.tokens import tokenizer_file

PARTS = ["a", "b", "s", "t", "re", "'", "'s", "'ll", "'re", "'r", " ", "  ", "\n", "\t", "1", "23", "!", "?", "é", "日", "本", "　", "\xa0", "😀",
         "<|endoftext|>", "<|endof", "the", "ing", "ation", " th", "́", "Ⅷ", "x", "-", "--", "===", "\x00", "\x7f", "İ", "ß"]
EDGES = ["", "a", " ", "  ", "\n", "a  b", "a \n b", "'s", "don't", "we'll've", "'r", "'re", "' s", " 's", "\n's", "''s", "<|endoftext|>",
         "a<|endoftext|><|endoftext|>b ", " <|endoftext|> ", "'s's'll'rex"]
LONG = ["a" * 5000, "ab" * 3000, "日本語" * 2000, " " * 4000 + "x", "!" * 3333, "\n" * 999 + "y", "x" * 700 + "'s", "na" * 1000 + "tion" * 500,
        "<|endoftext|>" * 300, "z" * 999 + " " * 999, "'" * 2001]


def library():
    return Tokenizer.from_file(tokenizer_file())


def as_bytes(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def wrong(machine, texts, **kw):
    counts = machine.count(*as_bytes(texts), **kw)
    expected = [len(e.ids) for e in library().encode_batch(texts, add_special_tokens=False)]
    return [(t[:60], int(c), e) for t, c, e in zip(texts, counts, expected) if c != e]


@pytest.fixture(scope="module")
def machine():
    return T.Transducer(tokenizer_file())


def mixed(n, seed, size=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, size))) for _ in range(n)]


def test_counts_equal_the_library(machine):
    assert wrong(machine, EDGES) == []
    assert wrong(machine, mixed(6000, 1)) == []


def test_random_characters(machine):
    rng = random.Random(2)
    texts = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0x3000), rng.randrange(0xE000, 0x20000)])) for _ in range(40)) for _ in range(500)]
    assert wrong(machine, texts) == []


@pytest.mark.parametrize("window", [64, 300, 1 << 20])
def test_long_texts_and_pieces_window_by_window(machine, window):
    assert wrong(machine, LONG + mixed(300, 3, 400), window=window) == []


def test_a_full_table_is_emptied(machine):
    small = T.Transducer(tokenizer_file(), max_states=1)
    for seed in range(4):
        assert wrong(small, mixed(300, seed) + LONG, window=300) == []
    assert len(small.states) < len(machine.states)


def test_chunk_maps_compose_to_the_run_through_all_chunks():
    classes = np.random.default_rng(4).integers(0, 12, 2000).astype(np.uint8)
    for entry in range(T.STATES):
        marks, last = T.piece_marks(classes, entry)
        state, expected = entry, np.zeros(len(classes), bool)
        for i, c in enumerate(classes):
            mark = T.MARKS[c * 16 + state]
            expected[i] |= bool(mark & 1)
            if mark & 2 and i:
                expected[i - 1] = True
            state = T.NEXT[c * 16 + state]
        assert (marks == expected).all() and last == state
    maps = T.state_maps(np.ascontiguousarray(classes[:1920].reshape(-1, 128).T))
    assert (T.scan_maps(maps)[-1] == [T.piece_marks(classes[:1920], s)[1] for s in range(T.STATES)]).all()


def test_query_over_all_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op11_token_counts"](spark, sf).collect()}
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    assert rows.keys() == docs.keys()
    encoded = library().encode_batch(list(docs.values()), add_special_tokens=False)
    for (i, text), e in zip(docs.items(), encoded):
        assert (rows[i].n_bytes, rows[i].n_tokens, rows[i].over_limit) == (len(text.encode()), len(e.ids), len(e.ids) > 1024)


def test_odd_rows(spark):
    odd = [(1, None), (2, ""), (None, "two words"), (None, None), (5, "word " * 300_000), (7, "same"), (7, "same")]
    df = spark.createDataFrame(odd, "doc_id long, text string").selectExpr("*", "'c' as id", "1 as n_tokens", "true as over_limit", "0 as n_bytes")
    got = sorted(tuple(r) for r in token_counts(df, tokenizer_file()).fillna(-1, ["doc_id"]).collect())
    expected = len(library().encode(odd[4][1], add_special_tokens=False).ids)
    assert got == [(-1, 0, 0, False), (-1, 9, 2, False), (1, 0, 0, False), (2, 0, 0, False), (5, 1_500_000, expected, True), (7, 4, 1, False), (7, 4, 1, False)]
    assert token_counts(df.limit(0), tokenizer_file()).collect() == []


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        T.Transducer(tokenizer_file("word_bpe_49k.json"))

"""Token sets: equal to plain encoding, exact round trip, short-document access."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dockwatch.llm import op03_tokens as op
from dockwatch.llm.queries import QUERIES
from dockwatch.llm.tokens import Encoder, tokenizer_file

PLAIN = Tokenizer.from_file(tokenizer_file())
ENCODER = Encoder(tokenizer_file())
PARTS = st.sampled_from(["the", " the", " ", "  ", "\n", "\t", " ", " ", "é", " éa", "'s", "don't", "12", "!?", "<|endoftext|>", "ß", "日本", "\u0085", "\x1c", "\x7f", "　", "x" * 40])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=14).map("".join), max_size=6))
def test_pieces_equal_whole_texts(texts):
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    flat, at = ENCODER.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    got = [flat[a:b].tolist() for a, b in zip(at, at[1:])]
    assert got == [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]


def expected(rows):
    out, start = [], 0
    for doc, text in rows:
        ids = np.array(PLAIN.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_on_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = [tuple(r) for r in QUERIES["op3_token_ids"](spark, sf).orderBy("start").collect()]
    assert got == expected([(r.doc_id, r.text) for r in rows])


def test_parts_segments_and_odd_rows(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(op, "SEGMENT_ROWS", 3)
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(40)] + [(50, None), (51, ""), (52, "word " * 30_000), (53, "a"), (53, "a"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start", "'x' as frame", "2 as ID2")
    path = op.write_tokens(df, str(tmp_path / "set"), tokenizer_file(), part_bytes=200)
    got = [tuple(r) for r in op.read_tokens(spark, path, digest=True).orderBy("start").collect()]
    assert got == expected(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))
    one = op.read_tokens(spark, path, only_id=31).collect()
    assert [r.doc_id for r in one] == [31] and one[0].ids == PLAIN.encode(rows[31][1], add_special_tokens=False).ids + [2]


def test_empty_and_foreign_dictionary(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    path = op.write_tokens(df, str(tmp_path / "none"), tokenizer_file())
    assert op.read_tokens(spark, path).collect() == []
    a = op.write_tokens(spark.createDataFrame([(1, "one text")], "doc_id long, text string"), str(tmp_path / "a"), tokenizer_file())
    spark.createDataFrame([(bytearray(b"0123456789"), op.hashlib.sha256(b"0123456789").hexdigest(), 2)], op.DICTIONARY).write.mode("overwrite").parquet(f"{a}/dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        op.read_tokens(spark, a).collect()

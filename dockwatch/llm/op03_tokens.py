"""Token ids in a binary file format with a shared zstandard dictionary.

A token set is a folder of three Parquet tables, written and committed by Spark, so it lies in any store Spark writes to:

* ``dictionary``: one row, the dictionary trained on serialized id arrays of a bounded sample, its SHA-256 and the id width.
* ``segments``: rows in ascending order of id, a few thousand documents or a few MB each: ``part, segment``, the ids of the
  first and last document, ``dict_hash``, ``blob`` (one zstandard frame after the other, one frame per document) and the
  offset index as arrays: ``doc_ids``, ``offsets`` of the frames in the blob (one more at the end), ``n_tokens`` and
  ``starts`` counted from the beginning of the part.
* ``parts``: per part, the token number of its first token.

A short document is read from its own frame: the segment by the first and last id, the frame by the offset index.
"""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockwatch.llm.common import hashed_sample, lean, materialise, utf8_array
from dockwatch.llm.tokens import encoder as encoder_of

END_ID = 2
#: Training of the dictionary: at most so many documents, of each at most so many bytes of ids; it changes sizes, never ids.
SAMPLE_ROWS = 1000
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 65_536
LEVEL = 3
#: A segment is closed at so many documents or bytes; a longer document is a segment of its own.
SEGMENT_ROWS = 4096
SEGMENT_BYTES = 1 << 19
PART_BYTES = 128 << 20
#: Small row groups bound what a writer holds back and what a reader takes at once; frames are compressed already.
WRITE = {"parquet.block.size": 8 << 20, "compression": "uncompressed"}


def with_end(ids, at, end_id):
    """Append ``end_id`` to every document of a flat id array."""
    n = np.diff(at) + 1
    out = np.full(int(n.sum()), end_id, np.uint32)
    stops = np.cumsum(n) - 1
    keep = np.ones(len(out), bool)
    keep[stops] = False
    out[keep] = ids
    return out, np.concatenate([[0], stops + 1])


def train_dictionary(samples: list[bytes]) -> bytes:
    """Dictionary for id arrays; few or short samples serve as they are, none gives a minimal one."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return (b"".join(samples) + bytes(16))[:DICTIONARY_BYTES]


def write_tokens(df: DataFrame, path: str, tokenizer: str, id_col="doc_id", text_col="text", end_id=END_ID, part_bytes=PART_BYTES) -> str:
    """Encode every whole text (null: empty) of ``df`` and write a token set to the new folder ``path``.

    Documents lie in ascending order of id, null ids first, repeated ids next to each other; every one ends with
    ``end_id``. Other columns are ignored. An empty table gives a token set without segments.
    """
    import zstandard

    spark = df.sparkSession
    given = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    picked = hashed_sample(given.select("id").where("id is not null"), "id", SAMPLE_ROWS)
    texts = given.join(F.broadcast(picked.distinct()), "id").limit(SAMPLE_ROWS).select(F.substring("text", 1, 4 * SAMPLE_BYTES).alias("t"))
    encoder = encoder_of(tokenizer)
    wide = encoder.tokenizer.get_vocab_size() > 1 << 16 or end_id >= 1 << 16
    kind = np.dtype("<u4" if wide else "<u2")
    data, offsets = utf8_array(texts.toArrow()["t"].combine_chunks())
    samples = []
    for _, _, ids, at in encoder.encode_texts(data, offsets):
        ids, at = with_end(ids, at, end_id)
        serial = ids.astype(kind)
        samples += [serial[a:b].tobytes()[:SAMPLE_BYTES] for a, b in zip(at, at[1:])]
    dictionary = train_dictionary(samples)
    dict_hash = hashlib.sha256(dictionary).hexdigest()

    def compress(batches):
        encoder = encoder_of(tokenizer)
        frames = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))
        for batch in batches:
            data, offsets = utf8_array(batch.column(1))
            for a, b, ids, at in encoder.encode_texts(data, offsets):
                ids, at = with_end(ids, at, end_id)
                serial = ids.astype(kind)
                packed = [frames.compress(serial[x:y].tobytes()) for x, y in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(at)), pa.array(packed, pa.binary())], ["id", "n_tokens", "frame"])

    frames = materialise(given.mapInArrow(lean(compress), "id long, n_tokens long, frame binary"), "frames")
    size = frames.agg(F.coalesce(F.sum(F.length("frame")), F.lit(0))).first()[0]
    parts = max(1, -(-size // part_bytes), min(spark.sparkContext.defaultParallelism, size >> 20))
    # the hash of the frame lets one id with very many rows lie in several parts
    ordered = frames.withColumn("h", F.xxhash64("frame"))
    ordered = ordered.repartitionByRange(parts, "id", "h").sortWithinPartitions("id", "h", "frame").drop("h")

    def segments(batches):
        part, number, start = TaskContext.get().partitionId(), 0, 0
        ids, sizes, frames, held = [], [], [], 0

        def close():
            n = np.array(sizes, np.int64)
            row = {"part": part, "segment": number, "first_id": ids[0], "last_id": ids[-1], "dict_hash": dict_hash, "blob": b"".join(frames),
                   "doc_ids": list(ids), "offsets": np.cumsum([0, *map(len, frames)]), "n_tokens": n, "starts": start + np.cumsum(n) - n}
            return pa.RecordBatch.from_pylist([row], schema=SEGMENT_ARROW)

        for batch in batches:
            for i, n, frame in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and (len(ids) >= SEGMENT_ROWS or held + len(frame) > SEGMENT_BYTES):
                    yield close()
                    number, start = number + 1, start + sum(sizes)
                    ids, sizes, frames, held = [], [], [], 0
                ids.append(i)
                sizes.append(n)
                frames.append(frame)
                held += len(frame)
        if ids:
            yield close()

    ordered.mapInArrow(lean(segments), SEGMENTS).write.options(**WRITE).parquet(f"{path}/segments")
    written = spark.read.schema(SEGMENTS).parquet(f"{path}/segments")
    totals = written.groupBy("part").agg(F.sum(F.expr("aggregate(n_tokens, 0L, (s, n) -> s + n)")).alias("tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    totals.withColumn("first_token", F.coalesce(F.sum("tokens").over(earlier), F.lit(0))).write.parquet(f"{path}/parts")
    spark.createDataFrame([(bytearray(dictionary), dict_hash, kind.itemsize)], DICTIONARY).write.parquet(f"{path}/dictionary")
    return path


SEGMENTS = ("part int, segment int, first_id long, last_id long, dict_hash string, blob binary, doc_ids array<long>, offsets array<long>,"
            " n_tokens array<long>, starts array<long>")
SEGMENT_ARROW = pa.schema([
    ("part", pa.int32()), ("segment", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("dict_hash", pa.string()),
    ("blob", pa.binary()), *((c, pa.list_(pa.int64())) for c in ("doc_ids", "offsets", "n_tokens", "starts"))])
PARTS = "part int, tokens long, first_token long"
DICTIONARY = "dictionary binary, dict_hash string, id_bytes int"


def read_tokens(spark: SparkSession, path: str, only_id=None, digest=False) -> DataFrame:
    """``doc_id, start, n_tokens`` and the ids (``digest``: their crc32) from a token set; ``only_id`` reads one document.

    Reading fails if a segment names another dictionary than the stored one.
    """
    import zstandard

    stored = spark.read.schema(DICTIONARY).parquet(f"{path}/dictionary").first()
    dictionary, expected, kind = bytes(stored.dictionary), stored.dict_hash, np.dtype(f"<u{stored.id_bytes}")
    if hashlib.sha256(dictionary).hexdigest() != expected:
        raise ValueError("the stored dictionary is damaged")
    rows = spark.read.schema(SEGMENTS).parquet(f"{path}/segments")
    if only_id is not None:
        rows = rows.where((F.col("first_id").isNull() | (F.col("first_id") <= only_id)) & (F.col("last_id") >= only_id))
    rows = rows.join(spark.read.schema(PARTS).parquet(f"{path}/parts").select("part", "first_token"), "part")
    rows = rows.select("dict_hash", "blob", "doc_ids", "offsets", "n_tokens", "starts", "first_token")

    def decode(batches):
        frames = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        for batch in batches:
            for at in range(batch.num_rows):  # one segment in Python at a time
                row = batch.slice(at, 1).to_pylist()[0]
                if row["dict_hash"] != expected:
                    raise ValueError("a segment was written with another dictionary")
                out, held = [], 0
                for k, doc in enumerate(row["doc_ids"]):
                    if only_id is not None and doc != only_id:
                        continue
                    n = row["n_tokens"][k]
                    frame = row["blob"][row["offsets"][k]:row["offsets"][k + 1]]
                    ids = np.frombuffer(frames.decompress(frame, max_output_size=n * kind.itemsize), kind).astype("<u4")
                    out.append((doc, row["first_token"] + row["starts"][k], len(ids), zlib.crc32(ids.tobytes()) if digest else ids))
                    held += len(ids)
                    if held > SEGMENT_BYTES:
                        yield decoded(out, digest)
                        out, held = [], 0
                if out:
                    yield decoded(out, digest)

    last = "ids_crc32 long" if digest else "ids array<long>"
    return rows.mapInArrow(lean(decode), f"doc_id long, start long, n_tokens long, {last}")


def decoded(out, digest):
    doc, start, n, last = zip(*out)
    last = pa.array(last, pa.int64()) if digest else pa.array(last, pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), last],
                                      ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

"""What the operators share: tables, shared storage, bounded deterministic samples."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwatch.session import materialise

__all__ = ["hashed_sample", "lean", "split_by_ids", "materialise", "read_table", "repeat_rows", "utf8_array"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hashed_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows with the smallest hashes of ``key``: the same rows in every run, whatever the partitions.

    Spark keeps only ``rows`` rows per task and merges those.
    """
    return df.orderBy(F.xxhash64(F.col(key).cast("string")), F.col(key)).limit(rows)


def lean(run):
    """A ``mapInArrow`` function that hands freed batch memory back, so that waiting workers hold little."""
    import pyarrow as pa

    def wrapped(batches):
        def given():
            for batch in batches:
                yield batch
                pa.default_memory_pool().release_unused()

        yield from run(given())
        pa.default_memory_pool().release_unused()

    return wrapped


#: Bits of the map that ``split_by_ids`` broadcasts: at most BITS / 64 rows of 16 bytes, 4 MB, whatever the data.
ID_BITS = 1 << 24


def split_by_ids(df: DataFrame, key: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` that may have their ``key`` among ``ids`` and rows that surely have not, columns unchanged.

    A bit map of hashed ids is broadcast, so an exact join that follows need not shuffle the texts of all rows, only those
    of the first frame. With very many ids all bits are set and all rows are in the first frame, which is still right.
    """
    place = F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(ID_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    word = F.floor(place / 64).cast("int")
    columns = df.columns
    name = "_word"
    while any(c.lower().startswith(name) for c in columns):
        name = "_" + name
    words = ids.where(F.col(key).isNotNull()).select(word.alias(name), bit.alias(f"{name}_bit")).groupBy(name).agg(F.bit_or(f"{name}_bit").alias(f"{name}_bits"))
    words = materialise(words, "id_bits")
    marked = df.withColumn(name, word).join(F.broadcast(words), name, "left")
    hit = F.col(key).isNotNull() & (F.coalesce(F.col(f"{name}_bits"), F.lit(0).cast("long")).bitwiseAND(bit) != 0)
    return marked.where(hit).select(columns), marked.where(~hit).select(columns)


def utf8_array(column):
    """An Arrow string column (plain or large) as text bytes and offsets; a null is an empty text."""
    import numpy as np
    import pyarrow as pa

    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    width = np.dtype(kind).itemsize
    offsets = np.frombuffer(offsets, kind, len(column) + 1, column.offset * width).astype(np.int64) if offsets else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[:offsets[-1]] if data else np.zeros(0, np.uint8)
    return data, offsets


def repeat_rows(df: DataFrame, text_col: str, counts, others=()) -> DataFrame:
    """Rows of ``df`` as often as ``counts(data, offsets, *others)`` says for their texts (a mask keeps or drops), columns unchanged.

    ``others`` names further columns, given as Arrow arrays. Nothing is shuffled or joined; texts come in bounded slices.
    """
    import numpy as np

    from dockwatch.llm.textscan import slices

    at, rest = df.columns.index(text_col), [df.columns.index(c) for c in others]

    def run(batches):
        for batch in batches:
            data, offsets = utf8_array(batch.column(at))
            for a, b in slices(offsets):
                part = batch.slice(a, b - a)
                n = counts(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], *(part.column(c) for c in rest))
                chosen = np.repeat(np.arange(b - a), np.asarray(n, np.int64))
                held = np.concatenate([[0], np.cumsum(np.diff(offsets[a:b + 1])[chosen] + 64)])
                for c, d in slices(held):  # many copies of a row are no large batch
                    yield part.take(chosen[c:d])

    return df.mapInArrow(lean(run), df.schema)

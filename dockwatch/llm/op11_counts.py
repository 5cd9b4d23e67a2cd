"""Token counts of whole texts by a compiled finite-state tokenizer; see ``transducer`` for the machines.

Every task reads its texts in slices of about a megabyte, a longer text window by window, so memory does not depend on the length
of a text. Nothing is shuffled, and the tokenizer library encodes nothing but pairs of tokens while transitions are compiled.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwatch.llm.common import lean, utf8_array
from dockwatch.llm.textscan import slices
from dockwatch.llm.transducer import transducer

LIMIT = 1024
#: Bytes of a long text that are cut at once.
WINDOW = 1 << 20


def token_counts(df: DataFrame, tokenizer: str, limit=LIMIT, id_col="doc_id", text_col="text", window=WINDOW) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of every row of ``df``, counted as the tokenizers library encodes whole texts.

    Special strings inside a text count as the one token they are by default; nothing is added, cut or padded. Null and empty
    texts have no bytes and no tokens; null ids and repeated rows are counted each; other columns are ignored; an empty table gives an
    empty result. ``tokenizer``: file of a byte-level BPE without normaliser; others are refused.
    """

    def run(batches):
        machine = transducer(tokenizer)
        for batch in batches:
            data, offsets = utf8_array(batch.column(1))
            for a, b in slices(offsets):
                counts = machine.count(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], window)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(offsets[a:b + 1])), pa.array(counts)], ["id", "n_bytes", "n_tokens"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = rows.mapInArrow(lean(run), "id long, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

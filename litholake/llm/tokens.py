"""Encoding of a corpus with a public tokenizer (problem 6), on Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litholake.llm.bpe import DEFAULT_DIR, Encoder, read_ranks

#: Bytes of text that one kernel call works on; the arrays it needs are about forty times as large.
CHUNK_BYTES = 1 << 20


def broadcast_encoder(spark: SparkSession, name: str = "byte_bpe_50k", folder: str = DEFAULT_DIR) -> Broadcast:
    """The tables of a public vocabulary: of fixed size (about 5 MB), whatever the corpus."""
    return spark.sparkContext.broadcast(Encoder(read_ranks(name, folder)))


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string array; a null is an empty text."""
    col = col.fill_null("").cast(pa.large_string())
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1]
    buf = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return buf, at - at[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row where a text is longer."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def encode_column(df: DataFrame, text_col: str, keep: list[str], encoder: Broadcast, out: str = "ids", counts_only: bool = False) -> DataFrame:
    """The ``keep`` columns and the token ids of ``text_col`` (with ``counts_only`` just their number).

    Null and empty texts give an empty list (0). Strings of special tokens inside a text are ordinary text. Repeated rows
    stay. Long texts are one row like any other; nothing is cut. No shuffle: each batch is encoded where it was read."""
    kept = [df.schema[c] for c in keep]
    from pyspark.sql import types as T

    schema = T.StructType([*kept, T.StructField(out, T.LongType() if counts_only else T.ArrayType(T.IntegerType(), True))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder.value
        for b in batches:
            buf, offsets = text_buffer(b.column(b.num_columns - 1))
            for i, j in chunks(offsets):
                ids, ends = enc.encode(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                value = pa.array(np.diff(ends)) if counts_only else pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(i, j - i) for k in range(b.num_columns - 1)), value], names=[*keep, out])

    return df.select(*keep, F.col(text_col)).mapInArrow(run, schema)

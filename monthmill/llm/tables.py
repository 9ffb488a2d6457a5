"""Helpers that the corpus operators share: stored results, checked broadcasts, text buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthmill.session import scratch_path

#: The largest table, in bytes, that is sent to every executor.
BROADCAST_BYTES = 32 << 20
#: Characters of the class [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Compute ``df`` once, as Parquet in the shared folder, so that lost executors cost nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` stored with a number per row, and the name of that column: decisions then name rows, not keys that may repeat or be null."""
    name = "_row"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def small_side(df: DataFrame, row_bytes: int) -> DataFrame:
    """A stored table as the small side of a join: sent to all if its checked size allows, shuffled otherwise."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # lower() also changes letters beyond ASCII; translate() is slow. Texts of ASCII alone take the fast one.
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, capitals, capitals.lower()))


def share(*key: Column | str) -> Column:
    """A number in [0, 1) that depends on the key alone, spread evenly."""
    return (F.shiftrightunsigned(F.xxhash64(*key), 12)).cast("double") / float(1 << 52)


def remainder(identifier: str, divisor: int) -> Column:
    """crc32 of the identifier as text, modulo ``divisor``; null for a null identifier."""
    return F.crc32(F.col(identifier).cast("string").cast("binary")) % divisor


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column of texts, and n + 1 offsets into them; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def byte_texts(texts: pa.Array) -> list[bytes | None]:
    """A column of texts as UTF-8."""
    return texts.cast(pa.large_binary()).to_pylist()

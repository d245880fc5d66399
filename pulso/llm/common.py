"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the provided tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_fold(doc_id: str, buckets: int) -> Column:
    """crc32 of the id's text modulo ``buckets`` (NULL for a NULL id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(buckets)


def text_bytes(col: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of every text; NULL becomes the empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return pc.fill_null(col.cast(pa.large_binary()), b"").to_pylist()


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a text column without copying its bytes; NULL becomes the empty text."""
    arr = pc.fill_null(col.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def pieces(offsets: np.ndarray, limit: int, overlap: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Cut a batch into slabs of about ``limit`` bytes so that memory stays bounded for any text length.

    Yields (row, start, end) arrays; a text longer than ``limit`` is cut into
    several pieces that share ``overlap`` bytes with their predecessor.
    """
    rows: list[int] = []
    starts: list[int] = []
    ends: list[int] = []
    held = 0
    for row in range(len(offsets) - 1):
        a, b = int(offsets[row]), int(offsets[row + 1])
        while a < b:
            e = min(b, a + max(limit - held, overlap + 1))
            rows.append(row)
            starts.append(a)
            ends.append(e)
            held += e - a
            if held >= limit:
                yield np.array(rows), np.array(starts), np.array(ends)
                rows, starts, ends, held = [], [], [], 0
            if e == b:
                break
            a = e - overlap
    if rows:
        yield np.array(rows), np.array(starts), np.array(ends)

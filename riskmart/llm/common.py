"""Shared helpers: tables, written intermediate tables, vectorised word splitting."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from riskmart.session import new_work_dir, ship_package

#: Bytes of text handled by one numpy step inside a task (a longer single text is one step of its own).
CHUNK_BYTES = 1 << 19


#: Rows of an Arrow batch, where the session has Spark's default: whole texts are long, and a
#: batch is held several times, outside the heap of the JVM and in Python.
BATCH_ROWS, DEFAULT_BATCH_ROWS = "1000", "10000"
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ready(spark: SparkSession) -> None:
    """Call before a Python step is planned: workers can import this package, and batches are small."""
    ship_package(spark)
    if spark.conf.get(_BATCH_SETTING) == DEFAULT_BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut by a
    table that every executor sees, so a lost executor costs one re-read."""
    path = new_work_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, row offsets) of an Arrow binary or string array; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    base = offsets[0] if len(offsets) else 0
    return data[base:offsets[-1]] if len(offsets) else data[:0], offsets - base


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (at least one row each)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = j


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo:hi + 1] = True
    return table


#: Word separators of the plain word rule: space and 0x09-0x0D.
SPACES = byte_set((0x20, 0x20), (0x09, 0x0D))
#: ASCII A-Z to a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES):
    """Words of consecutive texts: (starts, ends, first word of each text + total).
    A word never crosses a text border."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~separators[data]
    begins = np.empty(len(data), bool)
    begins[0] = inside[0]
    np.logical_and(inside[1:], ~inside[:-1], out=begins[1:])
    finish = np.empty(len(data), bool)
    finish[-1] = inside[-1]
    np.logical_and(inside[:-1], ~inside[1:], out=finish[:-1])
    border = offsets[1:-1]
    border = border[(border > 0) & (border < len(data))]
    begins[border] |= inside[border]
    finish[border - 1] |= inside[border - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, offsets)


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply) over an array."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, the same wherever the bytes stand (prefix sums of a polynomial)."""
    up, down = _powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=prefix[1:])
    return mix64((prefix[ends] - prefix[starts]) * down[starts])

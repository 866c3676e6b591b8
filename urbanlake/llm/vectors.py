"""Array helpers for work inside tasks: text columns as bytes, rolling hashes, packed rows for the shuffle.

A shuffle of millions of small records costs most in handling single rows. The operators that need one pack the records of
a batch by target bucket, as the bytes of a numpy record array, so that a row carries thousands of them. The bucket of a
record follows from a hash, and the number of buckets from the session's shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from urbanlake.llm.common import partitions

#: Bytes that one step of a task turns into arrays; a longer text is a step of its own.
STEP = 1 << 21
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def buckets(spark: SparkSession) -> int:
    return 8 * partitions(spark)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


def utf8(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def steps(offsets: np.ndarray, limit: int = STEP) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; every row lies in one."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


class Rolling:
    """Polynomial hashes of any substring of a byte array, from one running sum."""

    _powers = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(Rolling._powers) <= n:
            size = max(n + 1, 1 << 21)
            back = np.uint64(pow(int(BASE), -1, 1 << 64))
            for name, step in (("_powers", BASE), ("_inverse", back)):
                all_ = np.full(size, step, np.uint64)
                all_[0] = 1
                setattr(Rolling, name, np.multiply.accumulate(all_))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE[data] * Rolling._powers[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * Rolling._inverse[start])

    def every(self, k: int) -> np.ndarray:
        """The hashes of all substrings of length k."""
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:-k]) * Rolling._inverse[:n]) if n > 0 else np.zeros(0, np.uint64)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the offsets of the rows in the words; no word crosses rows."""
    n = len(data)
    blank = BLANK[data]
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = blank[:-1], blank[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner], after[inner - 1] = True, True
    start, end = np.flatnonzero(~blank & before), np.flatnonzero(~blank & after) + 1
    return start, end, np.searchsorted(start, offsets)


def packed(bucket: np.ndarray, records: np.ndarray, count: int) -> Iterator[tuple[int, bytes]]:
    """The records by bucket."""
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(count + 1))
    records = records[order]
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), records[edges[b] : edges[b + 1]].tobytes()


def unpacked(column: pa.ChunkedArray, kind: np.dtype) -> np.ndarray:
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column if x.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def rows(pairs: list[tuple[int, bytes]], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], schema.types[i]) for i in range(len(schema.types))], schema=schema)

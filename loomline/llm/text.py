"""Shared helpers: words, hashes and byte slices of Arrow text columns, size-checked broadcasts.

A word is a run of ``[^\\x20\\x09-\\x0D]``; those six bytes never occur inside a UTF-8
character, so words are found in the raw bytes. ``slices`` yields the rows of an Arrow
batch in pieces of bounded size, so the working memory of a task follows ``max_bytes``
(or the single longest text), never the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators.groups import checkpointed, input_bytes  # noqa: F401  (used by the operators)

WORD = r"[^\x20\x09-\x0D]+"
# Text bytes that a task works on at once.
SLICE_BYTES = 1 << 20
# Inputs above this size are taken as they are split.
SMALL_BYTES = 64 << 20
# Bytes after which Spark ends a batch of rows for Python; its own limit is 64 MB.
BATCH_BYTES = 4 << 20
# A counted side of at most this many narrow rows is broadcast; larger ones are shuffled.
BROADCAST_ROWS = 500_000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LONG_WORD = 256
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], dtype=np.uint64)


def sized_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` (a stored, narrow table) when its counted rows allow it.

    Beyond the limit the frame is returned as it is and Spark shuffles both sides.
    """
    return F.broadcast(df) if df.count() <= rows else df


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of about ``BATCH_BYTES`` from here on.

    A task holds a batch several times, in the JVM while it grows and when it comes back, and in
    Python; by Spark's own limit whole splits of long texts are one batch. Results don't depend on it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def small_partitions(df: DataFrame) -> DataFrame:
    """As many partitions as cores at least, for a small table read from few files.

    Large inputs have splits enough and are not looked at: asking for the partitions of a
    plan with shuffles runs them.
    """
    if input_bytes(df) > SMALL_BYTES:
        return df
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df


@dataclass
class Slice:
    """Rows ``first .. first + n`` of a batch: their bytes and where each row begins."""

    first: int
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, n + 1 entries, from 0

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of an Arrow column (null: empty) in slices of about ``max_bytes``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + max_bytes, "right")) - 1)
        j = min(j, n)
        yield Slice(i, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j


@dataclass
class Words:
    """Words of a slice: byte range, row (within the slice) and the words before each row."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    bounds: np.ndarray  # n + 1: words of row r are bounds[r]:bounds[r + 1]


def find_words(s: Slice) -> Words:
    size = len(s.data)
    space = np.ones(size + 2, dtype=bool)
    space[1:-1] = _SPACE[s.data]
    word = ~space
    start = word[1:] & space[:-1]
    end = word[:-1] & space[1:]
    cuts = s.offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < size)]
    touching = cuts[word[cuts] & word[cuts + 1]]  # a word ends here and the next row's begins
    start[touching] = True
    end[touching] = True
    starts, ends = np.flatnonzero(start[:size]), np.flatnonzero(end[: size + 1])
    bounds = np.searchsorted(starts, s.offsets, "left")
    row = np.repeat(np.arange(s.n), np.diff(bounds))
    return Words(starts, ends, row, bounds)


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = h ^ (h >> np.uint64(33))
    h = h * _M2
    h = h ^ (h >> np.uint64(29))
    h = h * _M1
    return h ^ (h >> np.uint64(32))


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, eight bytes at a time over all ranges at once."""
    length = ends - starts
    out = mixed(length.astype(np.uint64) + _M1)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    chunks = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1))
    active = np.flatnonzero(length <= _LONG_WORD)
    k = 0
    while len(active):
        left = length[active] - k
        if k:
            active = active[left > 0]
            left = length[active] - k
            if not len(active):
                break
        eight = chunks[starts[active] + k].view(np.uint64).ravel() & _KEEP[np.minimum(left, 8)]
        out[active] = mixed(out[active] * _M2 + eight)
        k += 8
    for i in np.flatnonzero(length > _LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return out


def rolling(h: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """Hash of every run of ``width`` consecutive entries (``len - width + 1`` of them)."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    n = len(h) - width + 1
    out = np.full(n, np.uint64(salt), dtype=np.uint64)
    for j in range(width):
        out = out * _M1 + h[j : j + n]
        out ^= out >> np.uint64(31)
    return mixed(out)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)

"""Removal of repeated passages by difference-cover anchors.

A window is ``LENGTH`` consecutive words of one document. Of every 13 positions only the four
of the difference cover {0, 1, 3, 9} carry an anchor, the hash of eight words. For any two
positions p and q there is a shift below 13 that puts both on the cover, so two equal windows
always share an anchor at the same place inside them. Windows without an anchor that occurs
twice in the corpus are therefore unique and are never looked at again.

The others are extended to their full length and hashed; the first start of each hash is a
combinable minimum, so a passage that stands in a third of all documents needs no group. A
window that is not the first of its hash starts earlier too, and its words go.

Anchors are counted by a shuffle of hashes alone. The repeated ones come back to the
documents as a bit table of fixed size when they fill at most an eighth of it (what it lets
through by chance costs work, never a wrong result), and by a semi-join on the hash beyond.
Windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.text import Slice, checkpointed, find_words, hash_ranges, mixed, rolling, signed, slices, small_partitions

LENGTH = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
ANCHOR = LENGTH - PERIOD + 1
# Bits of the table of repeated anchors, gathered in pieces of 32,768 bits.
TABLE_BITS = 1 << 27
_PIECE = 32_768
# Ids from 0 below 2**33 are packed with a position into one long.
_POSITION_BITS = 30
_MARK = (1 << _POSITION_BITS) - 1
_ON_COVER = np.isin(np.arange(PERIOD), COVER)


class _Text:
    """Words of a slice with their hashes, rows and the room left in the row."""

    def __init__(self, s: Slice):
        self.words = find_words(s)
        self.h = hash_ranges(s.data, self.words.starts, self.words.ends)
        size = np.diff(self.words.bounds)
        at = np.arange(len(self.h))
        self.position = at - np.repeat(self.words.bounds[:-1], size)
        self.room = np.repeat(self.words.bounds[1:], size) - at

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the anchors and the words they begin at; texts below ``LENGTH`` have none."""
        g = rolling(self.h, ANCHOR, 1)
        n = len(g)
        long_enough = self.position[:n] + self.room[:n] >= LENGTH
        at = np.flatnonzero((self.room[:n] >= ANCHOR) & _ON_COVER[self.position[:n] % PERIOD] & long_enough)
        return g[at], at

    def windows(self, anchors: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold one of the anchors beginning at the given words."""
        edge = np.zeros(len(self.h) + PERIOD + 1, np.int64)
        np.add.at(edge, np.maximum(anchors - (LENGTH - ANCHOR), anchors - self.position[anchors]), 1)
        edge[anchors + 1] -= 1
        return np.flatnonzero((np.cumsum(edge)[: len(self.h)] > 0) & (self.room >= LENGTH))

    def covered(self, windows: np.ndarray) -> np.ndarray:
        edge = np.zeros(len(self.h) + LENGTH + 1, np.int64)
        edge[windows] += 1
        edge[windows + LENGTH] -= 1
        return np.cumsum(edge)[: len(self.h)] > 0


def anchor_counts(docs: DataFrame) -> DataFrame:
    """``(h, n)``: how often each anchor occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(1)):
                found, n = np.unique(_Text(s).anchors()[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(signed(found)), pa.array(n.astype(np.int64))], ["h", "n"])

    return docs.mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def bit_table(repeated: DataFrame, bits: int = TABLE_BITS) -> np.ndarray:
    """Bit table of the stored hashes; ``bits / 32768`` rows of 4 KB reach the driver."""
    slot = F.pmod("h", F.lit(bits)) + 1
    rows = repeated.groupBy(F.bitmap_bucket_number(slot).alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("m")
    )
    table = np.zeros(bits // 8, np.uint8)
    for r in rows.toArrow().to_pylist():
        table[(r["b"] - 1) * (_PIECE // 8) : r["b"] * (_PIECE // 8)] = np.frombuffer(r["m"], np.uint8)
    return table


def _in_table(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(8 * len(table) - 1)
    return table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1


def _hits(text: _Text, table: np.ndarray | None, found: pa.Array | None, first: int) -> np.ndarray:
    """Words at which a repeated anchor begins, by the table or by the listed positions of each row."""
    if table is not None:
        g, at = text.anchors()
        return at[_in_table(table, g)]
    return _listed(text, found, first)


def _listed(text: _Text, lists: pa.Array, first: int) -> np.ndarray:
    """Word numbers in the slice of the positions listed for its rows."""
    bounds = text.words.bounds
    out = [
        bounds[r] + np.sort(p.values.to_numpy(zero_copy_only=False)).astype(np.int64)
        for r in range(len(bounds) - 1)
        if (p := lists[first + r]).is_valid and len(p)
    ]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _window_rows(docs: DataFrame, table) -> DataFrame:
    """``(h, doc_id, position)`` of the windows with a repeated anchor, and a mark for each such document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if table is None else table.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            found = None if bits is not None else batch.column(2)
            for s in slices(batch.column(1)):
                text = _Text(s)
                w = text.windows(_hits(text, bits, found, s.first))
                if not len(w):
                    continue
                g = rolling(text.h, LENGTH, 2)[w]
                row = text.words.row[w]
                marked = np.unique(row)
                own = ids[s.first + marked].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([signed(g), signed(mixed(mixed(own.view(np.uint64) + np.uint64(77))))])),
                     pa.array(np.concatenate([ids[s.first + row].astype(np.int64), own])),
                     pa.array(np.concatenate([text.position[w], np.full(len(own), _MARK)]))],
                    ["h", "doc_id", "position"],
                )

    return docs.mapInArrow(run, "h bigint, doc_id bigint, position bigint")


def _kept_words(docs: DataFrame, table) -> DataFrame:
    """Final pass over ``(doc_id, text, firsts[, found])``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if table is None else table.value
        for batch in batches:
            found = None if bits is not None else batch.column(3)
            n, removed, kept = [], [], []
            for s in slices(batch.column(1)):
                text = _Text(s)
                w = text.windows(_hits(text, bits, found, s.first))
                own = batch.column(2).slice(s.first, s.n)
                firsts = np.zeros(len(text.h) + 1, bool)
                for r in np.flatnonzero(pa.compute.is_valid(own).to_numpy(zero_copy_only=False)):
                    p = own[int(r)].values.to_numpy(zero_copy_only=False).astype(np.int64)
                    firsts[text.words.bounds[r] + p[p < _MARK]] = True
                gone = text.covered(w[~firsts[w]])
                raw, bounds = s.data.tobytes(), text.words.bounds
                for r in range(s.n):
                    mine = gone[bounds[r] : bounds[r + 1]]
                    words = raw[s.offsets[r] : s.offsets[r + 1]].split()
                    if mine.any():
                        words = list(compress(words, (~mine).tolist()))
                    n.append(len(mine))
                    removed.append(int(mine.sum()))
                    kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return docs.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")


def without_repeats(docs: DataFrame, table_bits: int = TABLE_BITS) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text)`` per document.

    A word goes when a window that covers it also starts earlier: in a document with a
    smaller id, or earlier in its own. Null and empty texts have no words; texts below
    ``LENGTH`` words lose none. Rows of one id and text are alike and lose the same words; a
    null id takes no part and keeps all words. An empty table gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = small_partitions(texts.where("doc_id is not null"))
    repeated = checkpointed(anchor_counts(named).where("n > 1").select("h"))
    if repeated.count() <= table_bits // 8:
        table = docs.sparkSession.sparkContext.broadcast(bit_table(repeated, table_bits))
        searched = named
    else:
        table = None
        places = _anchor_places(named).join(repeated, "h", "left_semi")
        searched = named.join(places.groupBy("doc_id").agg(F.collect_set("position").alias("found")), "doc_id", "left")
    rows = _window_rows(searched, table)
    low, high = named.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None or (low >= 0 and high < 1 << 63 - _POSITION_BITS):
        start = F.shiftleft("doc_id", _POSITION_BITS).bitwiseOR(F.col("position")).alias("s")
        first = rows.select("h", start).groupBy("h").agg(F.min("s").alias("s"))
        owned = first.select(
            F.shiftright("s", _POSITION_BITS).alias("doc_id"), F.col("s").bitwiseAND(F.lit(_MARK).cast("long")).cast("int").alias("position")
        )
    else:
        first = rows.groupBy("h").agg(F.min(F.struct("doc_id", "position")).alias("s"))
        owned = first.select("s.doc_id", F.col("s.position").cast("int").alias("position"))
    lists = owned.groupBy("doc_id").agg(F.collect_list("position").alias("firsts"))
    columns = ["doc_id", "text", "firsts"] + (["found"] if table is None else [])
    whole = _kept_words(searched.join(lists, "doc_id", "left").select(*columns), table)
    nameless = texts.where("doc_id is null").select(
        "doc_id", "text", F.lit(None).cast("array<int>").alias("firsts"), F.lit(None).cast("array<bigint>").alias("found")
    )
    return whole.unionByName(_kept_words(nameless, None))


def _anchor_places(docs: DataFrame) -> DataFrame:
    """``(h, doc_id, position)`` of every anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for s in slices(batch.column(1)):
                text = _Text(s)
                g, at = text.anchors()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(g)), pa.array(ids[s.first + text.words.row[at]]), pa.array(text.position[at])],
                    ["h", "doc_id", "position"],
                )

    return docs.mapInArrow(run, "h bigint, doc_id bigint, position bigint")

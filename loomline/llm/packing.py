"""Best-fit packing of token pieces into sequences, improved by a swap-based local search.

Documents are tokenized whole; only documents longer than a sequence are cut, into full pieces
behind a first one that may be shorter. Full pieces are sequences of their own. All others are
dealt at random to groups of about ``GROUP`` pieces. A group is packed by best fit, longest
piece first; then underfull bins trade pieces: the emptiest bin gives one or two pieces to a
fuller one, for nothing, one or two pieces that are shorter, preferring trades that fill the
other bin to the end. Every trade increases the sum of squared fills, and the search stops when
the bins are as few as the tokens allow or no trade is left. Full bins are done; the pieces
of the others of all groups are dealt to new, fewer groups, until one group holds them all or
a round saves no bin. Groups are bounded whatever the data size, and the whole loses at
most about a bin, not one per group.

A null text is empty; an empty text is one piece of one token, the end token. Null and
repeated ids are separate documents: pieces are followed by a row number that is stored with
them. Extra columns take no part. Special tokens in a text count as what the tokenizer file
makes of them.
"""

from __future__ import annotations

import bisect
import heapq
import os
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.text import Slice, checkpointed, hash_ranges, slices, small_partitions

CAPACITY, END = 2048, 0
TOKENIZER = "byte_bpe_50k.json"
# Pieces that a task packs together.
GROUP = 16_384
# Stretches that a worker keeps with their ids (twice as many at most), and the longest one worth keeping, in bytes.
HELD, HELD_BYTES = 500_000, 40
# Text bytes whose stretches are looked up together.
TOGETHER = 4 << 20

_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
# Bytes that may begin something blank, so that no text is cut before a space in front of them.
_MAYBE_BLANK = np.zeros(256, dtype=bool)
_MAYBE_BLANK[[*range(9, 14), *range(28, 33), 0xC2, 0xE1, 0xE2, 0xE3]] = True


def byte_letters() -> dict[int, str]:
    """The character by which a byte-level tokenizer names each byte: itself if visible, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def stretches(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all stretches of a slice, and which are a run of letters (after a space or not).

    A stretch begins with a text, at a space that something visible follows, and where a run
    of letters (ASCII and Latin-1) meets any other ASCII character: a byte-level tokenizer's first step
    ends a piece there whatever is around.
    """
    data, size = s.data, len(s.data)
    letter = _ASCII_LETTER[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]  # the signs of multiplication and division
    letter[lead] = letter[lead + 1] = True
    start = np.zeros(size, dtype=bool)
    space = np.flatnonzero(data[:-1] == 32)
    start[space[~_MAYBE_BLANK[data[space + 1]]]] = True
    start[1:] |= letter[:-1] & ~letter[1:] & (data[1:] < 128)
    begins = s.offsets[:-1][np.diff(s.offsets) > 0]
    start[s.offsets[1:-1][s.offsets[1:-1] < size] - 1] &= ~(data[s.offsets[1:-1][s.offsets[1:-1] < size] - 1] == 32)
    start[begins] = True
    starts = np.flatnonzero(start)
    other = np.concatenate([[0], np.cumsum(~letter)])
    ends = np.append(starts[1:], size)
    run = (other[ends] - other[starts + (data[starts] == 32)] == 0) & (ends - starts > (data[starts] == 32))
    return starts, run


class Ids:
    """Token ids of texts, by the byte-level tokenizer file at ``path``.

    Texts are cut into stretches that have the same ids alone as inside the text; every
    different stretch is tokenized once and kept by its 64-bit hash. A run of letters is one piece
    of the tokenizer's first step and goes straight to its merges. Texts that hold one of the
    tokenizer's special tokens are tokenized whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind, self.code = ("<u2", "H") if self.tokenizer.get_vocab_size() <= 1 << 16 else ("<u4", "I")
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.held: dict[int, bytes] = {}
        self.older: dict[int, bytes] = {}

    def pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def encoded(self, text: bytes) -> bytes:
        return self.pack(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids)

    def merged(self, run: bytes) -> bytes:
        named = run.decode("latin-1").translate(self.letters)
        return self.pack([t.id for t in self.tokenizer.model.tokenize(named)])

    def lookup(self, hashes: list[int], raw: bytes, starts: list[int], ends: list[int], run: list[bool]) -> list[bytes]:
        found = list(map(self.held.get, hashes))
        for i, ids in enumerate(found):
            if ids is None:
                h = hashes[i]
                ids = self.older.get(h)
                if ids is None:
                    text = raw[starts[i] : ends[i]]
                    ids = self.merged(text) if run[i] else self.encoded(text)
                if ends[i] - starts[i] <= HELD_BYTES:
                    self.held[h] = ids
                found[i] = ids
        if len(self.held) > HELD:
            self.held, self.older = {}, self.held
        return found

    def texts(self, column: pa.Array) -> Iterator[bytes]:
        """Ids, as little-endian unsigned integers of ``kind``, of every text of an Arrow column (null: empty)."""
        for s in slices(column, TOGETHER):
            raw = s.data.tobytes()
            if not raw:
                yield from [b""] * s.n
                continue
            starts, run = stretches(s)
            ends = np.append(starts[1:], len(raw))
            hashes, first, code = np.unique(hash_ranges(s.data, starts, ends), return_index=True, return_inverse=True)
            found = self.lookup(hashes.tolist(), raw, starts[first].tolist(), ends[first].tolist(), run[first].tolist())
            ids = np.frombuffer(b"".join(found), self.kind)
            length = np.fromiter(map(len, found), np.int64, len(found)) // ids.itemsize
            begin = np.cumsum(length) - length
            bounds = np.searchsorted(starts, s.offsets)
            special = [any(t in raw for t in self.special)] * s.n
            for row in range(s.n):
                lo, hi = s.offsets[row], s.offsets[row + 1]
                if special[row] and any(t in raw[lo:hi] for t in self.special):
                    yield self.encoded(raw[lo:hi])
                    continue
                mine = code[bounds[row] : bounds[row + 1]]
                n = length[mine]
                places = np.repeat(begin[mine] - (np.cumsum(n) - n), n)
                places += np.arange(len(places))
                yield ids[places].tobytes()


_WORKERS: dict[str, Ids] = {}


def worker_ids(path: str) -> Ids:
    """This worker's tokenizer for ``path``; its kept stretches serve all tasks of the worker."""
    if path not in _WORKERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _WORKERS[path] = Ids(path)
    return _WORKERS[path]


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``total`` tokens: full ones, the first perhaps shorter."""
    first = (total - 1) % capacity + 1
    return [(0, first)] + [(at, capacity) for at in range(first, total, capacity)]


def _pieces(path: str, capacity: int, end: int):
    def split(batches):
        ids_of = worker_ids(path)
        last = np.array([end], dtype=ids_of.kind).tobytes()
        width = len(last)
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for doc, ids in zip(batch.column(0).to_pylist(), ids_of.texts(batch.column(1))):
                ids += last
                for number, (start, length) in enumerate(cut(len(ids) // width, capacity)):
                    own = ids[width * start : width * (start + length)]
                    rows.append((doc, number, start, length, own))
                    size += len(own)
                if size > 1 << 24:
                    yield _batch(rows)
                    rows, size = [], 0
            yield _batch(rows)

    return split


def _widened(batches):
    """Ids of two bytes as ids of four."""
    for batch in batches:
        lengths, ids = batch.column(batch.schema.get_field_index("length")), batch.column(batch.schema.get_field_index("ids"))
        wide = [
            x.as_py() if len(x.as_py()) == 4 * n else np.frombuffer(x.as_py(), "<u2").astype("<u4").tobytes()
            for x, n in zip(ids, lengths.to_pylist())
        ]
        yield batch.set_column(batch.schema.get_field_index("ids"), "ids", pa.array(wide, pa.binary()))


_PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in _PIECE]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PIECE.types)], schema=_PIECE)


def tokenized(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: the pieces of every document with their token ids.

    ``ids`` are little-endian unsigned integers, of two bytes if the vocabulary allows it, else
    of four; ``path`` must be readable by every worker.
    """
    return small_partitions(docs).select("doc_id", "text").mapInArrow(
        _pieces(path, capacity, end), "doc_id bigint, piece int, start bigint, length bigint, ids binary"
    )


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices: longest first, each to the fullest bin that holds it."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free space
    open_ = 0  # bit f: some bin has f tokens free
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        length = lengths[i]
        fitting = open_ >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            b = room[free].pop()
            if not room[free]:
                open_ &= ~(1 << free)
            bins[b].append(i)
        else:
            free, b = capacity, len(bins)
            bins.append([i])
        left = free - length
        if left:
            room[left].append(b)
            open_ |= 1 << left
    return bins


class _Offers:
    """Trades on offer by reach: per reach a sorted list of ``(given, bin, piece, piece)``."""

    def __init__(self) -> None:
        self.at: dict[int, list[tuple[int, int, int, int]]] = {}
        self.reaches: list[int] = []

    def add(self, reach: int, offer: tuple[int, int, int, int]) -> None:
        if reach not in self.at:
            self.at[reach] = []
            bisect.insort(self.reaches, reach)
        bisect.insort(self.at[reach], offer)

    def remove(self, reach: int, offer: tuple[int, int, int, int]) -> None:
        offers = self.at[reach]
        del offers[bisect.bisect_left(offers, offer)]
        if not offers:
            del self.at[reach]
            del self.reaches[bisect.bisect_left(self.reaches, reach)]


class _Pool:
    """Underfull bins as lists of piece lengths, indexed by the trades that they offer.

    A bin that gives up some of its pieces (none, one or two) can take pieces of up to its
    free space and theirs together: that sum is the offer's reach.
    """

    def __init__(self, bins: list[list[int]], capacity: int) -> None:
        self.capacity, self.bins = capacity, bins
        self.fill = [sum(b) for b in bins]
        self.one, self.two = _Offers(), _Offers()  # offers of up to one piece, of two pieces
        for b in range(len(bins)):
            self.change(b, _Offers.add)

    def given(self, b: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        """The single pieces and the pairs that a bin can give, by length."""
        sizes = sorted(set(self.bins[b]), reverse=True)
        twice = {s for s in sizes if self.bins[b].count(s) > 1}
        return [(s, 0) for s in sizes], [(s, t) for i, s in enumerate(sizes) for t in sizes[i:] if s != t or s in twice]

    def change(self, b: int, how) -> None:
        """Add or remove what the bin offers; a full or empty bin offers nothing."""
        free = self.capacity - self.fill[b]
        if free <= 0 or not self.fill[b]:
            return
        singles, pairs = self.given(b)
        for s, t in [(0, 0), *singles]:
            how(self.one, s + free, (s, b, s, t))
        for s, t in pairs:
            how(self.two, s + t + free, (s + t, b, s, t))

    def trade(self, giver: int) -> tuple[tuple[int, int], tuple[int, int, int, int]] | None:
        """The best trade of a giver that offers nothing itself: what it gives, and the offer it takes.

        Exact trades fill the other bin; among others the one that leaves least room. At most
        one side gives two pieces. The other bin ends fuller than the giver was, so the sum of
        squared fills grows.
        """
        singles, pairs = self.given(giver)
        best, least = None, self.capacity
        for gives, offers in [(g, o) for g in singles for o in (self.one, self.two)] + [(g, self.one) for g in pairs]:
            total = gives[0] + gives[1]
            for reach in offers.reaches[bisect.bisect_left(offers.reaches, total) :]:
                if reach - total >= least:
                    break
                offer = offers.at[reach][0]  # the one that gives up least gains most
                gain = total - offer[0]
                if gain > 0 and self.fill[offer[1]] + gain > self.fill[giver]:
                    best, least = (gives, offer), reach - total
                    break
            if not least:
                break
        return best

    def apply(self, giver: int, gives: tuple[int, int], offer: tuple[int, int, int, int]) -> None:
        total, b, *takes = offer
        self.change(b, _Offers.remove)
        for size in gives:
            if size:
                self.bins[giver].remove(size)
                self.bins[b].append(size)
        for size in takes:
            if size:
                self.bins[b].remove(size)
                self.bins[giver].append(size)
        gain = sum(gives) - total
        self.fill[giver] -= gain
        self.fill[b] += gain
        self.change(b, _Offers.add)


def fewest(lengths: list[int], capacity: int) -> int:
    """A bound on the bins that pieces need: by tokens, and by pieces that can't share a bin.

    For every ``k``: pieces over ``capacity - k`` are alone among those of ``k`` and more, those over half
    the capacity need a bin each, and the room these leave limits the pieces from ``k`` to half.
    """
    count = np.bincount(np.asarray(lengths, np.int64), minlength=capacity + 1)
    size = count * np.arange(capacity + 1)
    n, total = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(size)])
    k, half = np.arange(capacity // 2 + 1), capacity // 2
    alone = n[-1] - n[capacity - k + 1]
    wide = n[capacity - k + 1] - n[half + 1]
    room = wide * capacity - (total[capacity - k + 1] - total[half + 1])
    small = total[half + 1] - total[k]
    return int(max((alone + wide + np.maximum(0, -(-(small - room) // capacity))).max(), -(-total[-1] // capacity)))


def improved(bins: list[list[int]], capacity: int) -> list[list[int]]:
    """The bins (lists of lengths) after the local search; empty bins are left out."""
    full = [b for b in bins if sum(b) == capacity]
    pool = _Pool([list(b) for b in bins if sum(b) < capacity], capacity)
    enough = fewest([size for b in pool.bins for size in b], capacity)
    alive = len(pool.bins)
    waiting = [(fill, b) for b, fill in enumerate(pool.fill)]
    heapq.heapify(waiting)
    while waiting and alive > enough:
        fill, giver = heapq.heappop(waiting)
        if fill != pool.fill[giver] or not fill or fill == capacity:
            continue  # changed since: it waits under its new fill, or is done
        pool.change(giver, _Offers.remove)
        while pool.fill[giver] and (found := pool.trade(giver)):
            pool.apply(giver, *found)
            b = found[1][1]
            if pool.fill[b] < capacity:
                heapq.heappush(waiting, (pool.fill[b], b))
        if pool.fill[giver]:
            pool.change(giver, _Offers.add)  # no trade left to give; it may still take
        else:
            alive -= 1
    return full + [b for b in pool.bins if b]


def packed_group(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin numbers, from 0, of pieces shorter than the capacity."""
    sizes = lengths.tolist()
    start = [[sizes[i] for i in b] for b in best_fit(sizes, capacity)]
    by_length: dict[int, list[int]] = {}
    for i, size in enumerate(sizes):
        by_length.setdefault(size, []).append(i)
    out = np.empty(len(sizes), np.int64)
    for number, b in enumerate(improved(start, capacity)):
        for size in b:
            out[by_length[size].pop()] = number  # pieces of one length are alike
    return out


_PLACED = "row bigint, length bigint, sequence_id bigint, offset bigint, fill bigint"


def _packer(capacity: int, first: int):
    def pack(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row", ignore_index=True)
        number = packed_group(rows["length"].to_numpy(), capacity)
        lengths = rows["length"]
        return pd.DataFrame({
            "row": rows["row"], "length": lengths, "sequence_id": first + int(key[0]) * (1 << 24) + number,
            "offset": lengths.groupby(number).cumsum() - lengths, "fill": lengths.groupby(number).transform("sum"),
        })

    return pack


def placed(lengths: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``(row, sequence_id, offset)`` for the stored ``(row, length)``; rows are unique."""
    out = lengths.where(F.col("length") == capacity).select("row", F.col("row").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    left = lengths.where(F.col("length") < capacity)
    n, round_ = left.count(), 0
    before = None
    while n:
        round_ += 1
        groups = -(-n // group)
        # sequences of a round are numbered below zero, apart from those of full pieces
        dealt = left.withColumn("g", F.pmod(F.xxhash64(F.lit(round_), "row"), F.lit(groups)))
        done = checkpointed(dealt.groupBy("g").applyInPandas(_packer(capacity, -(round_ << 56)), _PLACED))
        loose = done.where(F.col("fill") < capacity)
        bins = done.where("offset = 0").count()
        still, count, tokens = loose.agg(F.count(F.lit(1)), F.count_if(F.col("offset") == 0), F.coalesce(F.sum("length"), F.lit(0))).first()
        # one group, the fewest possible bins, or a round that saved none: this is the result
        if groups == 1 or count * capacity - tokens < capacity or (before is not None and bins >= before):
            return out.unionByName(done.select("row", "sequence_id", "offset"))
        out = out.unionByName(done.where(F.col("fill") == capacity).select("row", "sequence_id", "offset"))
        left, n, before = checkpointed(loose.select("row", "length")), still, count
    return out


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, group: int = GROUP) -> DataFrame:
    """``(doc_id, piece, start, length, ids, sequence_id, offset)`` of every piece; ``ids`` are of four bytes each.

    Pieces are stored and shuffled with ids of two bytes where the vocabulary allows it.
    """
    pieces = checkpointed(tokenized(docs, path, capacity, end).select(F.monotonically_increasing_id().alias("row"), "*"))
    places = placed(pieces.select("row", "length"), capacity, group)
    met = pieces.join(places, "row").drop("row")
    return met.mapInArrow(_widened, met.schema)

"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are lower-cased and stripped of ASCII punctuation at both ends, so layout and
punctuation don't hide a copy. A seed is an n-gram of a test item that is improbable by the
frequencies of its words in the corpus; a passage that leaks often does not make its own
n-grams look common that way. Items without an improbable n-gram keep their rarest ones.

Documents are read once with a bit table of the seeds (of fixed size; what it lets through
by chance, the join removes). Around their hits they send passages of hashed words, which an
equi-join on the seed brings to the items. Each pair of passage and item is aligned locally;
an item has leaked where the alignment reaches ``LIMIT`` of the score of a perfect copy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.text import (
    checkpointed,
    find_words,
    hash_ranges,
    rolling,
    signed,
    sized_broadcast,
    slices,
    small_partitions,
)

SEED = 3
# An n-gram expected this often or less in the corpus by its words' frequencies is a seed.
EXPECTED = 0.05
# Rarest n-grams that an item keeps as seeds in any case.
KEPT = 4
# Scores of the alignment, and the share of a perfect copy's score that counts as a leak.
MATCH, MISMATCH, GAP = 2, -1, -1
LIMIT = 0.5
# Bits of the tables that seeds and item words are looked up in.
FILTER_BITS = 1 << 23

_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def folded(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Hashes of the normalised words of a text column: ``(first row, hashes, word bounds of rows)``."""
    for s in slices(pc.utf8_lower(column.cast(pa.large_string()))):
        w = find_words(s)
        starts, ends = w.starts.copy(), w.ends.copy()
        active = np.flatnonzero(_PUNCT[s.data[starts]]) if len(starts) else starts
        while len(active):
            starts[active] += 1
            active = active[starts[active] < ends[active]]
            active = active[_PUNCT[s.data[starts[active]]]]
        active = np.flatnonzero((starts < ends) & _PUNCT[s.data[ends - 1]]) if len(starts) else starts
        while len(active):
            ends[active] -= 1
            active = active[_PUNCT[s.data[ends[active] - 1]]]
        some = starts < ends
        h = hash_ranges(s.data, starts[some], ends[some])
        yield s.first, h, np.searchsorted(w.row[some], np.arange(s.n + 1))


def _grams(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams within rows, and the word each begins at."""
    g = rolling(h, SEED)
    row_end = np.repeat(bounds[1:], np.diff(bounds))
    at = np.flatnonzero(np.arange(len(g)) + SEED <= row_end[: len(g)])
    return g[at], at


def _bit_table(hashes: np.ndarray) -> np.ndarray:
    table = np.zeros(FILTER_BITS, dtype=bool)
    table[hashes.view(np.uint64) % np.uint64(FILTER_BITS)] = True
    return np.packbits(table)


def _in_table(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes % np.uint64(FILTER_BITS)
    return bits[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8) & 1 == 1


def _table_of(df: DataFrame, column: str) -> np.ndarray:
    """Bit table of a stored column: only the set bits' numbers, at most ``FILTER_BITS``, are gathered."""
    bits = df.select(F.pmod(F.col(column), F.lit(FILTER_BITS)).alias("b")).distinct().toPandas().b
    return _bit_table(bits.to_numpy(np.int64))


def item_words(items: DataFrame) -> DataFrame:
    """``(item_id, words)``: hashed normalised words in order. Items with a null id are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, h, bounds in folded(batch.column(1)):
                words = pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(signed(h)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(bounds) - 1), words], ["item_id", "words"]
                )

    kind = items.schema["item_id"].dataType.simpleString()
    named = items.where("item_id is not null").select("item_id", F.col("text").cast("string").alias("t"))
    return named.mapInArrow(run, f"item_id {kind}, words array<bigint>")


def _word_counts(docs: DataFrame, words: DataFrame) -> DataFrame:
    """``(word, n)`` over all documents for the words of the items, and the number of all words as null."""
    bits = docs.sparkSession.sparkContext.broadcast(_table_of(words, "word"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, h, _ in folded(batch.column(0)):
                found, n = np.unique(h[_in_table(bits.value, h)], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*signed(found).tolist(), None], pa.int64()), pa.array([*n.tolist(), len(h)], pa.int64())],
                    ["word", "n"],
                )

    texts = docs.select(F.col("text").cast("string").alias("t"))
    return texts.mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _gram_rows(items: DataFrame) -> DataFrame:
    """``(item_id, seed, gram words)`` for every n-gram of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(1).combine_chunks() if isinstance(batch.column(1), pa.ChunkedArray) else batch.column(1)
            flat = words.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            size = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
            bounds = np.concatenate([[0], np.cumsum(size)])
            g, at = _grams(flat, bounds)
            row = np.repeat(np.arange(len(size)), size)[at]
            member = pa.array([signed(flat[i : i + SEED]).tolist() for i in at], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(signed(g)), member], ["item_id", "seed", "members"]
            )

    kind = items.schema["item_id"].dataType.simpleString()
    return items.mapInArrow(run, f"item_id {kind}, seed bigint, members array<bigint>")


def seeds(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(item_id, seed)``: the improbable n-grams of each item, and its ``KEPT`` rarest."""
    words = checkpointed(items.select(F.explode("words").alias("word")).distinct())
    counts = checkpointed(_word_counts(docs, words))
    total = max(1, counts.where("word is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    grams = _gram_rows(items).distinct()
    each = grams.select("item_id", "seed", F.explode("members").alias("word"))
    n = F.greatest(F.coalesce("n", F.lit(0)), F.lit(1))  # an unseen word counts as seen once
    rare = (
        each.join(counts.where("word is not null"), "word", "left")
        .groupBy("item_id", "seed").agg((F.sum(F.log(n / F.lit(float(total)))) + F.log(F.lit(float(total)))).alias("log_expected"))
    )
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("log_expected", "seed"))
    return rare.withColumn("rank", rank).where(
        (F.col("log_expected") <= F.log(F.lit(EXPECTED))) | (F.col("rank") <= KEPT)
    ).select("item_id", "seed")


def passages(docs: DataFrame, seed: DataFrame, reach: int) -> DataFrame:
    """``(doc_id, start, words, seeds)``: stretches of documents within ``reach`` words of a seed."""
    bits = docs.sparkSession.sparkContext.broadcast(_table_of(seed, "seed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, words, found = [], [], [], []
            for first, h, bounds in folded(batch.column(1)):
                g, at = _grams(h, bounds)
                hit = _in_table(bits.value, g)
                g, at = g[hit], at[hit]
                if not len(at):
                    continue
                of = np.searchsorted(bounds, at, "right") - 1
                cut = np.flatnonzero((np.diff(at) > 2 * reach) | (np.diff(of) > 0)) + 1
                for lo, hi in zip([0, *cut], [*cut, len(at)]):
                    r = of[lo]
                    a, b = max(bounds[r], at[lo] - reach), min(bounds[r + 1], at[hi - 1] + SEED + reach)
                    row.append(first + int(r))
                    start.append(int(a - bounds[r]))
                    words.append(signed(h[a:b]).tolist())
                    found.append(signed(np.unique(g[lo:hi])).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(start, pa.int64()),
                 pa.array(words, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.int64()))],
                ["doc_id", "start", "words", "seeds"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("t"))
    return texts.mapInArrow(run, f"doc_id {kind}, start bigint, words array<bigint>, seeds array<bigint>")


def _best(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local score and where it ends in both sequences (first such place)."""
    idx = np.arange(1, len(text) + 1) * -GAP
    above = np.zeros(len(text) + 1, np.int64)
    best, at = 0, (0, 0)
    for i, word in enumerate(item, 1):
        row = np.maximum(above[:-1] + np.where(text == word, MATCH, MISMATCH), above[1:] + GAP)
        row = np.maximum(row, 0)
        row = np.maximum.accumulate(row + idx) - idx  # gaps along the text
        j = int(row.argmax())
        if row[j] > best:
            best, at = int(row[j]), (i, j + 1)
        above = np.concatenate([[0], row])
    return best, *at


def align(item: np.ndarray, text: np.ndarray) -> tuple[float, int, int]:
    """Share of a perfect copy's score, and the stretch ``[begin, end)`` of ``text`` that reaches it."""
    if not len(item) or not len(text):
        return 0.0, 0, 0
    best, i, j = _best(item, text)
    if not best:
        return 0.0, 0, 0
    _, _, back = _best(item[:i][::-1], text[:j][::-1])
    return best / (MATCH * len(item)), j - back, j


def leaks(docs: DataFrame, items: DataFrame, limit: float = LIMIT) -> DataFrame:
    """``(doc_id, item_id, score, start, end)``: the best aligned stretch of words per leaked item.

    Words are counted after normalisation. Null and empty texts and items, items of fewer
    than ``SEED`` words and null ids have no leaks; repeated rows give the same leaks once.
    """
    docs = small_partitions(docs.where("doc_id is not null"))
    test = checkpointed(item_words(items).distinct())
    reach = test.agg(F.coalesce(F.max(F.size("words")), F.lit(0))).first()[0]
    seed = checkpointed(seeds(docs, test))
    found = checkpointed(passages(docs, seed, reach))
    key = ["doc_id", "start", "passage"]
    found = found.withColumn("passage", F.xxhash64("words"))
    hits = found.select(*key, F.explode("seeds").alias("seed"))
    pairs = hits.join(sized_broadcast(seed), "seed").select(*key, "item_id").distinct()
    test = test.select("item_id", F.col("words").alias("item"))
    sides = pairs.join(found.select(*key, "words").dropDuplicates(key), key)
    sides = sides.join(sized_broadcast(test, 20_000), "item_id").select("doc_id", "item_id", "start", "words", "item")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = batch.column(2).to_numpy()
            got = []
            for k in range(batch.num_rows):
                text = batch.column(3)[k].values.to_numpy(zero_copy_only=False)
                score, a, b = align(batch.column(4)[k].values.to_numpy(zero_copy_only=False), text)
                got.append((score, int(start[k]) + a, int(start[k]) + b))
            score, a, b = zip(*got) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array(a, pa.int64()),
                 pa.array(b, pa.int64())], ["doc_id", "item_id", "score", "start", "end"],
            )

    kinds = [f"{c} {f.schema[c].dataType.simpleString()}" for f, c in ((docs, "doc_id"), (items, "item_id"))]
    scored = sides.mapInArrow(run, ", ".join([*kinds, "score double", "start bigint", "`end` bigint"]))
    best = F.max(F.struct("score", (-F.col("start")).alias("s"), F.col("end").alias("e"))).alias("b")
    return (
        scored.where(F.col("score") >= limit).groupBy("doc_id", "item_id").agg(best)
        .select("doc_id", "item_id", "b.score", (-F.col("b.s")).alias("start"), F.col("b.e").alias("end"))
    )


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents without a leaked item; the columns stay as they are."""
    gone = checkpointed(leaks(docs, items).select("doc_id").distinct())
    return docs.join(sized_broadcast(gone), "doc_id", "left_anti").select(*docs.columns)

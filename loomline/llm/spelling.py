"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

One edit leaves one of two disjoint chunks of a word whole, and the other word holds that
chunk as a positional gram at the same place or one further. So every word gives its two
halves as chunks, keyed by what is left when the other half is cut out, and every word one
letter longer gives the grams at the same place (left half) and one further (right half);
rows of equal keys meet and are verified. A key with more than ``FULL`` words is not joined:
its words split the part that was cut out by the same rule (one edit leaves one half of that
part whole too), so keys grow longer until they are narrow enough. At a cut of one letter a
key holds at most one word per letter of the alphabet (pairs of letters for longer words), so
nothing is capped or dropped and no full key is ever expanded into its pairs.

Null texts have no words; a null id counts as an empty id in the checksum. Rows with equal
ids are separate rows of one document. Extra columns take no part. Runs of any length count.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.text import checkpointed, small_partitions
from loomline.operators.groups import lookup_join

RUN = "[A-Za-zÀ-ÿ]+"
# Every run whose checksum this divides loses one letter.
NOISE = 97
MIN_LENGTH, MIN_COUNT = 5, 3
# A form has at least this many times the word's occurrences.
TIMES = 2
# Words under one key that are compared with each other.
FULL = 64
# Distinct words that a task counts before it hands them on, and code points read at once.
HELD_WORDS, READ_CHARS = 200_000, 1 << 20

_FIND = re.compile("[a-zÀ-ÿ]+")
_OUTSIDE = re.compile("[^A-Za-zÀ-ÿ]")


def pieces(text: str, size: int = READ_CHARS) -> Iterator[str]:
    """A text in stretches of about ``size`` code points that cut no run."""
    start = 0
    while len(text) - start > size:
        stop = _OUTSIDE.search(text, start + size)
        if stop is None:
            break
        yield text[start : stop.start()]
        start = stop.start()
    yield text[start:] if start else text


def noisy(run: str, seed: int, noise: int = NOISE) -> str:
    """The run, or the run less one letter where ``noise`` divides its checksum; ``seed`` is the id's."""
    h = zlib.crc32(run.encode(), seed)
    if h % noise:
        return run
    i = h % len(run)
    return run[:i] + run[i + 1 :]


def _counter(min_length: int, noise: int):
    def count(batches):
        held: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            kept = [(w, n) for w, n in held.items() if len(w) >= min_length]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                if not text.is_valid:
                    continue
                seed = zlib.crc32(f"{doc.as_py()}:".encode())
                for piece in pieces(text.as_py()):
                    # bytes.lower changes A-Z only
                    for run, n in Counter(_FIND.findall(piece.encode().lower().decode())).items():
                        held[noisy(run, seed, noise)] += n
                    if len(held) > HELD_WORDS:
                        yield rows()
        yield rows()

    return count


def words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, noise: int = NOISE) -> DataFrame:
    """``(word, n)``: the distinct words of whole texts and how often each occurs."""
    texts = small_partitions(docs).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    counted = texts.mapInArrow(_counter(min_length, noise), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds the key: the base length, the part cut out, and what is left of the word."""
    left = F.expr("concat(substring(word, 1, p), substring(word, q + role + 1))")
    return rows.withColumn("key", F.xxhash64(F.expr("char_length(word) - role"), "p", "q", left))


def _halves(rows: DataFrame) -> DataFrame:
    """Every row twice, with either half of its part."""
    middle = F.expr("(p + q) div 2").cast("int")
    return rows.select(
        "word", "n", "role", F.explode(F.array(F.struct("p", middle.alias("q")), F.struct(middle.alias("p"), "q"))).alias("part")
    ).select("word", "n", "role", "part.p", "part.q")


def near(counted: DataFrame, full: int = FULL) -> DataFrame:
    """``(a, a_n, b, b_n)``: every pair of different words with one edit between them, once.

    ``counted`` is a stored ``(word, n)``. ``role`` 0 are a word's own chunks, 1 its grams as
    a word one letter longer than the base; ``p .. q`` is the part cut out of the base.
    """
    length = F.expr("char_length(word)")
    whole = counted.withColumn("p", F.lit(0)).select("word", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("role"), "p")
    rows = _halves(whole.withColumn("q", (length - F.col("role")).cast("int")))
    found = None
    while True:
        rows = checkpointed(_keyed(rows))
        sizes = rows.where("q - p > 1").groupBy("key").agg(F.count(F.lit(1)).alias("size"))
        crowded = checkpointed(sizes.where(F.col("size") > full).select("key"))
        more = not crowded.isEmpty()
        narrow = lookup_join(rows, crowded, ["key"], "left_anti") if more else rows
        one, two = narrow.where("role = 0").alias("one"), narrow.alias("two")
        met = one.join(
            two,
            (F.col("one.key") == F.col("two.key"))
            & ((F.col("two.role") == 1) | (F.col("one.word") < F.col("two.word")))
            & (F.levenshtein(F.col("one.word"), F.col("two.word"), 1) == 1),
        ).select(
            F.least("one.word", "two.word").alias("a"), F.when(F.col("one.word") < F.col("two.word"), F.col("one.n")).otherwise(F.col("two.n")).alias("a_n"),
            F.greatest("one.word", "two.word").alias("b"), F.when(F.col("one.word") < F.col("two.word"), F.col("two.n")).otherwise(F.col("one.n")).alias("b_n"),
        )
        met = checkpointed(met.distinct())
        found = met if found is None else found.unionByName(met)
        if not more:
            return found.distinct()
        rows = _halves(lookup_join(rows, crowded, ["key"], "left_semi").drop("key"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for the stored ``(word, form)``: the last word that the forms lead to.

    Forms lead to ever more frequent words, so there are no circles; every round doubles the
    steps taken.
    """
    current = forms.select("word", F.col("form").alias("root"))
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = checkpointed(lookup_join(current, further, ["root"], "left"))
        if step.where("next is not null").isEmpty():
            return current
        current = step.select("word", F.coalesce("next", "root").alias("root"))


def variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, noise: int = NOISE, times: int = TIMES, full: int = FULL,
) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` for every word of the documents.

    ``form`` is the most frequent word one edit away (ties: the least by code point) if it
    occurs at least ``times`` as often as the word; ``root`` follows forms to the last one.
    """
    counted = checkpointed(words(docs, min_length, min_count, noise))
    pairs = checkpointed(near(counted, full))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n"))
    )
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    often = -F.col("best.less") >= times * F.col("n")
    judged = checkpointed(
        counted.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(often, F.col("best.other")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n"),
        )
    )
    last = roots(judged.where("form is not null"))
    return judged.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))

"""Near copies by SimHash fingerprints and Golay-code fuzzy hashing.

A fingerprint is cut into three segments of 22, 21 and 21 bits, each read as a word of the
perfect [23, 12] Golay code. A segment's *home* is the index of the codeword within three
bits; its *keys* are the homes of all words within one bit. Two segments that differ in
at most one bit therefore meet: the home of one is among the keys of the other.

Two errors spread over three segments leave some pair of segments with one error between
them (pigeonhole). So each fingerprint is stored under three keys (a pair of segments and
their homes) and asks for the keys of each pair with one error in either segment. An equi
join brings candidates together, and the distance is verified.

A key under which more than ``bucket`` fingerprints are stored would give too many pairs.
Those fingerprints, and the ones that ask for such a key, are joined exactly another way:
each sends the 65 words within one bit of it, and two fingerprints are at distance two or
less exactly when they share one. Everything that shares a word is linked in a chain, so
the work stays linear however many near copies there are.

``drop_near_copies`` looks wider than two bits of one fingerprint: it finds candidates by
several independent fingerprints of the words, each by the method above, and verifies the
similarity of word shingles. Two texts of similarity 0.8 differ in about 4 of 64 bits, so one
fingerprint finds a part of such pairs only; several together find nearly all.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.components import connected
from loomline.llm.text import (
    Slice,
    checkpointed,
    find_words,
    hash_ranges,
    mixed,
    rolling,
    sized_broadcast,
    slices,
    small_batches,
    small_partitions,
)
from loomline.operators.groups import lookup_join

SHINGLE = 3
MAX_BITS = 2
BUCKET = 64
# Near copies that a pipeline drops: words of a shingle, least similarity, independent fingerprints.
NEAR_SHINGLE, NEAR_SIMILARITY, RUNS = 5, 0.8, 3
# Pairs of one row that a task verifies.
PAIRS_PER_PART = 4096
# Bits by which the fingerprints of a candidate may differ (all within two bits are found, others if they share a key).
NEAR_BITS = 8
# Bits of a sketch: each shingle flips one of them.
SKETCH = 512
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (0, 2), (1, 2))
# Generator polynomial of the [23, 12] Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANES = (256 * np.arange(8)).astype(np.int64)


def text_fingerprint(text: str | None) -> int:
    """The unsigned 64-bit fingerprint of a text."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), seed=42)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(b" ".join(s), 42) for s in zip(words, words[1:], words[2:])), np.uint64, len(words) - 2
    )
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        lanes = hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8) + _LANES
        counts = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256)
        ones += (counts @ _BITS).ravel()
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id, fp)`` per row: majority bits of the XXH64 of all word shingles, as a signed long.

    A null or blank text has fingerprint zero; fewer words than a shingle count as one shingle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((text_fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return small_partitions(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))).mapInArrow(
        run, f"id {kind}, fp bigint"
    )


# -- Golay code ---------------------------------------------------------------


def _remainder(words: np.ndarray) -> np.ndarray:
    """Syndrome: remainder of a 23-bit polynomial by the generator."""
    out = words.copy()
    for bit in range(22, 10, -1):
        out ^= np.where(out >> bit & 1, GENERATOR << (bit - 11), 0)
    return out


def _error_patterns() -> np.ndarray:
    """For each of the 2^11 syndromes, the one error of weight three or less."""
    bits = [1 << b for b in range(23)]
    errors = [sum(c) for weight in range(4) for c in combinations(bits, weight)]
    flat = np.array(errors, dtype=np.int64)
    table = np.zeros(2048, np.int64)
    table[_remainder(flat)] = flat
    return table


_PATTERNS = _error_patterns()


def home(segments: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword within three bits of each word."""
    return (segments ^ _PATTERNS[_remainder(segments)]) >> 11


def near_homes(segments: np.ndarray, width: int) -> np.ndarray:
    """Homes of the word and of all words within one bit of it in ``width`` bits: one row each."""
    flips = np.concatenate([[0], 1 << np.arange(width, dtype=np.int64)])
    return home((segments[:, None] ^ flips).ravel()).reshape(len(segments), -1)


def _keys(batches: Iterator[pa.RecordBatch], ask: bool, mark: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows of ``(fp, ...)`` with each of their keys; ``mark`` tells which of the asked keys the row is stored under."""
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for lo in range(0, len(fp), 4096):
            part = fp[lo : lo + 4096]
            bits = part.view(np.uint64)
            seg = [(bits >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
            homes = [home(s) for s in seg]
            near = [near_homes(s, n) for s, (_, n) in zip(seg, SEGMENTS)] if ask else None
            rows, keys, own = [], [], []
            for p, (i, j) in enumerate(PAIRS):
                base = np.int64(p) << 24
                mine = base | homes[i] << 12 | homes[j]
                if not ask:
                    rows.append(np.arange(len(part)))
                    keys.append(mine)
                    continue
                x = base | np.concatenate([near[i] << 12 | homes[j][:, None], homes[i][:, None] << 12 | near[j]], 1)
                x.sort(axis=1)
                new = np.ones(x.shape, bool)
                new[:, 1:] = x[:, 1:] != x[:, :-1]
                rows.append(np.repeat(np.arange(len(part)), new.sum(axis=1)))
                keys.append(x[new])
                own.append((x == mine[:, None])[new])
            at = pa.array(np.concatenate(rows) + lo)
            marks = [pa.array(np.concatenate(own))] if mark else []
            yield pa.RecordBatch.from_arrays(
                [*[c.take(at) for c in batch.columns], pa.array(np.concatenate(keys)), *marks],
                [*batch.schema.names, "key", *(["home"] if mark else [])],
            )


def stored_keys(prints: DataFrame) -> DataFrame:
    kept = ", ".join(f"{c} bigint" for c in prints.columns)
    return prints.mapInArrow(lambda b: _keys(b, False), f"{kept}, key bigint")


def asked_keys(prints: DataFrame, mark: bool = False) -> DataFrame:
    kept = ", ".join(f"{c} bigint" for c in prints.columns)
    return prints.mapInArrow(lambda b: _keys(b, True, mark), f"{kept}, key bigint" + (", home boolean" if mark else ""))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _chained(prints: DataFrame) -> DataFrame:
    """Exact links of fingerprints through the words within one bit of each."""
    flips = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), b) for b in range(64)])
    words = prints.select("fp", F.explode(F.transform(flips, lambda e: e.bitwiseXOR(F.col("fp")))).alias("word"))
    # every member of a word is within two bits of the word's smallest member
    least = words.groupBy("word").agg(F.min("fp").alias("a"), F.max("fp").alias("most"))
    least = least.where(F.col("a") < F.col("most")).select("word", "a")
    return words.join(least, "word").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints that connect all pairs within two bits.

    Every verified pair of a key with up to ``bucket`` fingerprints is returned; for fuller
    keys the edges connect the same fingerprints as all the pairs would.
    """
    stored = checkpointed(stored_keys(prints))
    sizes = stored.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    full = checkpointed(sizes.where(F.col("n") > bucket).select("key"))
    asked = asked_keys(prints)
    if full.isEmpty():
        rest, exact = stored, None
    else:
        asked = checkpointed(asked)
        rest = stored.join(full, "key", "left_anti")
        crowded = asked.join(full, "key", "left_semi").select("fp").distinct()
        exact = _chained(checkpointed(crowded))
    s = rest.select("key", F.col("fp").alias("b"))
    found = (
        asked.join(s, "key")
        .where((F.col("fp") != F.col("b")) & (distance(F.col("fp"), F.col("b")) <= MAX_BITS))
        .select(F.least("fp", "b").alias("a"), F.greatest("fp", "b").alias("b"))
    )
    return (found if exact is None else found.unionByName(exact)).distinct()


def near_copies(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", bucket: int = BUCKET) -> DataFrame:
    """``(doc_id, fp, component_id)``: the smallest id reachable through links of two bits or less.

    Null and empty texts share fingerprint zero and are linked like any other. Repeated ids
    keep their rows. An empty table gives an empty result.
    """
    prints = checkpointed(fingerprints(docs, text_col, id_col))
    groups = checkpointed(prints.groupBy("fp").agg(F.min("id").alias("least"), F.max("id").alias("most")))
    edges = checkpointed(links(groups.select("fp"), bucket))
    joined = connected(edges)
    # fingerprints with a copy or a link; all other documents stand alone
    classes = groups.join(joined.select(F.col("node").alias("fp"), "root"), "fp", "left").where(
        "root is not null or least < most"
    )
    root = F.coalesce("root", "fp")
    tops = classes.groupBy(root.alias("root")).agg(F.min("least").alias("component_id"))
    named = checkpointed(
        classes.select("fp", root.alias("root")).join(tops, "root").select("fp", "component_id")
    )
    return prints.join(named, "fp", "left").select(
        F.col("id").alias(id_col), "fp", F.coalesce("component_id", "id").alias("component_id")
    )


def hex_digits(fp: Column) -> Column:
    """A signed long as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# -- one document of each group of near copies --------------------------------


def word_fingerprints(batches: Iterator[pa.RecordBatch], runs: int, width: int) -> Iterator[pa.RecordBatch]:
    """``(row, text_hash, fps, size, sketch)`` of ``(row, text)``: a hash of the folded words in order, ``runs``
    fingerprints, and the number and the sketch of the shingles of ``width`` words.

    These are majority bits over the hashes of the different words: an edited word changes one of them,
    where it changes five shingles of five words.
    """
    for batch in batches:
        for s in slices(batch.column(1)):
            data = np.where((s.data >= 65) & (s.data <= 90), s.data + 32, s.data).astype(np.uint8)
            words = find_words(Slice(s.first, data, s.offsets))
            h = hash_ranges(data, words.starts, words.ends)
            place = rolling_rows(h, words.bounds)
            sets = _shingles(h, words.bounds, width)
            flips = [np.bincount((x % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1 for x in sets]
            sketch = np.packbits(np.array(flips, np.uint8).reshape(-1, SKETCH), axis=1, bitorder="little").view(np.int64)
            order = np.lexsort((h, words.row))
            h, row = h[order], words.row[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            h, row = h[new], row[new]
            count = np.bincount(row, minlength=s.n)
            fps = np.zeros((s.n, runs), np.uint64)
            for run in range(runs):
                ones = np.zeros((s.n, 64), np.int64)
                for lo in range(0, len(h), 1 << 15):
                    part = mixed(h[lo : lo + (1 << 15)] ^ mixed(np.full(1, run + 1, np.uint64)))
                    bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    mine = row[lo : lo + (1 << 15)]
                    begin = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
                    ones[mine[begin]] += np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
                fps[:, run] = np.packbits(2 * ones > count[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(s.first, s.n), pa.array(place.view(np.int64)), pa.array(list(fps.view(np.int64)), pa.list_(pa.int64())),
                    pa.array([len(x) for x in sets], pa.int64()), pa.array(list(sketch), pa.list_(pa.int64())),
                ],
                names=["row", "text_hash", "fps", "size", "sketch"],
            )


def _shingles(h: np.ndarray, bounds: np.ndarray, width: int) -> list[np.ndarray]:
    """Per row the sorted hashes of all runs of ``width`` words (fewer words: of all of them)."""
    return [np.unique(rolling(h[lo:hi], max(1, min(width, int(hi - lo))))) for lo, hi in zip(bounds[:-1], bounds[1:])]


def rolling_rows(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One hash per row of the sequence of its word hashes."""
    at = np.arange(len(h)) - np.repeat(bounds[:-1], np.diff(bounds))
    placed = mixed(h + mixed(at.astype(np.uint64)))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(placed, dtype=np.uint64)])
    return mixed(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64))


def shingle_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """``(row, shingles)``: sorted hashes of all runs of ``width`` folded words (fewer words: of all of them)."""
    for batch in batches:
        for s in slices(batch.column(1)):
            data = np.where((s.data >= 65) & (s.data <= 90), s.data + 32, s.data).astype(np.uint8)
            words = find_words(Slice(s.first, data, s.offsets))
            h = hash_ranges(data, words.starts, words.ends)
            sets = [x.tobytes() for x in _shingles(h, words.bounds, width)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.first, s.n), pa.array(sets, pa.binary())], names=["row", "shingles"])


def _similar(least: float):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True)) if min(len(x), len(y)) >= least * max(len(x), len(y)) else 0
                fine.append(both >= least * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(fine, pa.bool_()))

    return keep


def may_be_similar(x: str, y: str, least: float) -> Column:
    """False only for sets that can't have a similarity of ``least``, by their sizes and sketches.

    Sets that differ in n shingles have sketches that differ in n bits at most, and a similarity s of
    sets of p and q shingles leaves (p + q) * (1 - s) / (1 + s) different ones.
    """
    p, q = F.col(f"size_{x}"), F.col(f"size_{y}")
    apart = sum((distance(F.get(f"sketch_{x}", F.lit(i)), F.get(f"sketch_{y}", F.lit(i))) for i in range(SKETCH // 64)), F.lit(0))
    return (F.least(p, q) >= F.greatest(p, q) * (least - 1e-9)) & (apart <= (p + q) * ((1 - least) / (1 + least) + 1e-9))


def _verified(rows: DataFrame, pairs: DataFrame, width: int, least: float) -> DataFrame:
    """The stored pairs ``(a, b)`` of rows whose shingles have a similarity of ``least`` or more."""
    wanted = checkpointed(pairs.select(F.col("a").alias("row")).unionByName(pairs.select(F.col("b").alias("row"))).distinct())
    sets = checkpointed(rows.join(sized_broadcast(wanted), "row", "left_semi").select("row", F.col("text").cast("string")).mapInArrow(
        lambda b: shingle_sets(b, width), "row bigint, shingles binary"
    ))
    # sets are as large as texts, so they are never broadcast; those of rows in very many pairs are copied to several tasks
    parts = checkpointed(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_PART).alias("parts")))
    dealt = lookup_join(pairs, parts, ["a"]).select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"))
    x = lookup_join(sets.withColumnRenamed("row", "a"), parts, ["a"]).select(
        "a", F.col("shingles").alias("x"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part")
    )
    y = sets.select(F.col("row").alias("b"), F.col("shingles").alias("y"))
    met = dealt.join(x, ["a", "part"]).join(y, "b")
    return checkpointed(met.select("a", "b", "x", "y").mapInArrow(_similar(least), "a bigint, b bigint"))


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _unlinked_pairs(met: DataFrame, facts: DataFrame, labels: DataFrame, least: float) -> DataFrame:
    """Candidates ``(a, b)`` of the stored ``met`` that are in different groups so far, heads of keys left out.

    Members of a key's first group meet the others only, never each other. A key of very many
    stored rows is cut into parts, to each of which the rows that ask are copied.
    """
    others = met.where("held > 1 and row <> head").select("key", "row", "fp", "home")
    others = lookup_join(others, labels, ["row"], "left").withColumn("label", F.coalesce("label", "row"))
    others = checkpointed(others)
    keys = others.groupBy("key").agg(
        F.min("label").alias("main"), F.max("label").alias("last"), F.ceil(F.count_if("home") / PAIRS_PER_PART).alias("parts")
    )
    keys = checkpointed(keys.where("main < last and parts > 0").drop("last"))
    mixed_keys = lookup_join(others, keys, ["key"]).withColumn("in_main", F.col("label") == F.col("main"))
    known = checkpointed(lookup_join(mixed_keys, facts, ["row"]))

    def side(df: DataFrame, to: str) -> DataFrame:
        return df.select("key", "part", "meets", *[F.col(c).alias(f"{c}_{to}") for c in ("row", "fp", "label", "size", "sketch")])

    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
    asking = side(known.withColumn("part", every).withColumn("meets", F.col("in_main")), "x")
    whom = F.explode(F.when(F.col("in_main"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True))))
    held = side(known.where("home").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts"))).withColumn("meets", whom), "y")
    found = asking.join(held, ["key", "part", "meets"]).where(
        (F.col("label_x") != F.col("label_y")) & (distance(F.col("fp_x"), F.col("fp_y")) <= NEAR_BITS) & may_be_similar("x", "y", least)
    )
    return checkpointed(found.select(*_ordered("row_x", "row_y")).distinct())


def near_copy_groups(rows: DataFrame, width: int = NEAR_SHINGLE, least: float = NEAR_SIMILARITY, runs: int = RUNS) -> DataFrame:
    """``(row, group)`` of the stored ``(row, text)`` for rows that have an equal or near copy; ``group`` is one of its rows.

    Equal texts (words in order, A-Z lower-cased) meet by their hash. Of the others, pairs whose
    fingerprints meet in any of ``runs`` independent fingerprints (always if they differ in two bits or fewer)
    are candidates, and a candidate counts if the shingles of ``width`` words have a similarity of ``least`` or more.

    The groups are those of all candidates, however many rows share a key. First every row is compared with the
    first row of each of its keys. What that links needs no comparison any more; of the rest, all pairs of a key
    are compared whose sketches do not rule out the similarity.
    """
    prints = checkpointed(rows.select("row", F.col("text").cast("string")).mapInArrow(
        lambda b: word_fingerprints(b, runs, width), "row bigint, text_hash bigint, fps array<bigint>, size bigint, sketch array<bigint>"
    ))
    texts = checkpointed(prints.groupBy("text_hash").agg(
        F.min("row").alias("row"), *[F.first(c).alias(c) for c in ("fps", "size", "sketch")], F.count(F.lit(1)).alias("n")
    ))
    facts = texts.select("row", "size", "sketch")
    met = None
    for run in range(runs):
        members = texts.select(F.get("fps", F.lit(run)).alias("fp"), "row")
        heads = stored_keys(members).groupBy("key").agg(F.min(F.struct("row", "fp")).alias("first"), F.count(F.lit(1)).alias("held"))
        asked = asked_keys(members, mark=True).join(heads, "key").where("held > 1 or first.row <> row")
        found = asked.select(
            (F.col("key") + (run << 26)).alias("key"), "row", "fp", "home", "held", F.col("first.row").alias("head"), F.col("first.fp").alias("head_fp")
        )
        found = checkpointed(found)  # run after run: one plan of all would hold much of the driver's memory
        met = found if met is None else met.unionByName(found)
    starts = met.where((F.col("row") != F.col("head")) & (distance(F.col("fp"), F.col("head_fp")) <= NEAR_BITS))
    pairs = checkpointed(starts.select(*_ordered("row", "head")).distinct())
    for c in "ab":
        pairs = lookup_join(pairs, facts.select(*[F.col(f).alias(t) for f, t in (("row", c), ("size", f"size_{c}"), ("sketch", f"sketch_{c}"))]), [c])
    near = _verified(rows, checkpointed(pairs.where(may_be_similar("a", "b", least)).select("a", "b")), width, least)
    labels = checkpointed(connected(near).select(F.col("node").alias("row"), F.col("root").alias("label")))
    near = near.unionByName(_verified(rows, _unlinked_pairs(met, facts, labels, least), width, least))
    joined = checkpointed(connected(near).select(F.col("node").alias("first"), F.col("root").alias("group")))
    firsts = texts.select("text_hash", F.col("row").alias("first"), "n").join(joined, "first", "left").where("n > 1 or group is not null")
    named = firsts.select("text_hash", F.coalesce("group", "first").alias("group"))
    return lookup_join(prints.select("row", "text_hash"), named, ["text_hash"]).select("row", "group")


def drop_near_copies(docs: DataFrame, width: int = NEAR_SHINGLE, least: float = NEAR_SIMILARITY, runs: int = RUNS) -> DataFrame:
    """One row of each group of near copies stays: the one with the smallest id (null ids last, ties: any one row).

    Every row is judged by its text, so rows of one id but different texts are judged apart,
    and of wholly repeated rows one stays. Blank and null texts are copies of each other. The columns
    and their order are those of ``docs``.
    """
    small_batches(docs.sparkSession)
    rows = checkpointed(docs.withColumn("_near_row", F.monotonically_increasing_id()))
    groups = checkpointed(near_copy_groups(rows.select(F.col("_near_row").alias("row"), "text"), width, least, runs))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    ids = rows.select("doc_id", F.col("_near_row").alias("row"))
    kept = ids.join(groups, "row").groupBy("group").agg(F.min(order).alias("m")).select(F.col("m.row").alias("row"))
    gone = checkpointed(groups.join(kept, "row", "left_anti").select(F.col("row").alias("_near_row")))
    return rows.join(sized_broadcast(gone), "_near_row", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])

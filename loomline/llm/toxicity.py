"""Toxicity by class-conditional Kneser-Ney models of the characters of words.

Two models, toxic and ordinary, give the likelihood of each word byte by byte, from up to
``ORDER - 1`` preceding bytes of the word. Each discounts its own counts absolutely and
gives the freed mass to one backoff distribution that both share: Kneser-Ney continuation
counts (in how many contexts a byte was seen), pooled over both classes. An expression that
neither class has seen therefore adds only the difference of the two backoff weights, and a
rare one little.

A text is scored by length-normalised log-likelihood: toxic minus ordinary log-likelihood
per word, over the whole text and over its best passages of ``PASSAGES`` words. A logistic
curve over these figures turns them into a probability. It is fitted on labelled texts, each
scored by models that took no counts from the text's own fold.

Counts come from all labelled texts, as distributed sums. A model of up to ``MAX_GRAMS``
n-grams is collected and goes to the workers whole. A larger one stays distributed: the same
estimates are made by joins and sums over the n-grams, every distinct word gets its values by
joins, and texts meet the values of their words in units of bounded size. Both ways keep all
n-grams and give the same scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.text import (
    Slice,
    checkpointed,
    find_words,
    hash_ranges,
    sized_broadcast,
    signed,
    slices,
    small_batches,
    small_partitions,
)

ORDER = 6
PASSAGES = (2, 8)
FOLDS = 5
DISCOUNT = 0.9
MAX_GRAMS = 1_500_000
# Bytes after which a longer word goes on as a new one.
PIECE = 48
# Text bytes that a task works on at once; arrays of n-grams take many times that.
SLICE_BYTES = 1 << 18
# Text bytes that meet the values of their words in one group, about.
UNIT_BYTES = 16 << 20
# Labelled texts used to fit the logistic curve, at most.
CALIBRATION_ROWS = 20_000
LIMIT = 0.7
_SPACE = 32
_COUNTS = [f"{kind}{fold}" for fold in range(FOLDS) for kind in ("o", "t")]


def _lowered(column: pa.Array) -> Iterator[Slice]:
    return slices(pc.utf8_lower(column.cast(pa.large_string())), SLICE_BYTES)


def _pieces(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words of a slice, words over ``PIECE`` bytes cut up."""
    w = find_words(s)
    parts = np.maximum(1, -(-(w.ends - w.starts) // PIECE))
    if len(parts) and parts.max() > 1:
        at = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = np.repeat(w.starts, parts) + at * PIECE
        ends = np.minimum(starts + PIECE, np.repeat(w.ends, parts))
        return starts, ends, np.repeat(w.row, parts)
    return w.starts, w.ends, w.row


def _distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One byte range per distinct word, and which of them each word is."""
    _, first, which = np.unique(hash_ranges(data, starts, ends), return_index=True, return_inverse=True)
    return starts[first], ends[first], which


def _grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each byte of each word, closing space included: n-gram, its context, and the word.

    An n-gram is packed into a long: its bytes, newest lowest, and its length above them.
    The space before a word is part of the context; bytes before it are not.
    """
    size = ends - starts + 1
    total = int(size.sum())
    word = np.repeat(np.arange(len(starts)), size)
    depth = np.arange(total) - np.repeat(np.cumsum(size) - size, size)  # bytes of the word before this one
    source = np.repeat(starts, size) + depth
    closing = depth == np.repeat(size - 1, size)
    byte = np.where(closing, _SPACE, data[np.minimum(source, len(data) - 1)]).astype(np.int64)
    gram, length = byte.copy(), np.ones(total, np.int64)
    for back in range(1, ORDER):
        prev = np.empty(total, np.int64)
        prev[:back] = _SPACE
        prev[back:] = byte[:-back]
        prev = np.where(depth >= back, prev, _SPACE)
        known = depth >= back - 1  # the space before the word counts as one byte of context
        gram |= np.where(known, prev << (8 * back), 0)
        length += known
    tag = length << 48
    context = (gram >> 8) | (length - 1 << 48)
    return gram | tag, context, word


def gram_counts(labelled: DataFrame) -> DataFrame:
    """``(gram, t0, o0, t1, ...)``: toxic and ordinary counts by fold over all rows of ``(text, toxic, fold)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            kind = label + 2 * batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            for s in _lowered(batch.column(0)):
                starts, ends, row = _pieces(s)
                if not len(starts):
                    continue
                a, b, which = _distinct(s.data, starts, ends)
                gram, _, word = _grams(s.data, a, b)
                found, at = np.unique(gram, return_inverse=True)
                counts = []
                for k in range(2 * FOLDS):
                    words = np.bincount(which, kind[s.first + row] == k, len(a))
                    counts.append(pa.array(np.bincount(at, words[word], len(found)).astype(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(found), *counts], ["gram", *_COUNTS])

    parts = labelled.select("text", "toxic", "fold").mapInArrow(
        run, "gram bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS)
    )
    return parts.groupBy("gram").agg(*[F.sum(c).alias(c) for c in _COUNTS])


def _shorter(gram: np.ndarray) -> np.ndarray:
    """The n-gram without its oldest byte."""
    length = gram >> 48
    return (gram & (1 << 8 * (length - 1)) - 1) | (length - 1 << 48)


def _context(gram: np.ndarray) -> np.ndarray:
    length = gram >> 48
    return ((gram & (1 << 48) - 1) >> 8) | (length - 1 << 48)


def _shared(grams: np.ndarray) -> np.ndarray:
    """Kneser-Ney continuation probability of each n-gram, from the pooled types ``grams``."""
    levels: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    types = grams
    for n in range(ORDER - 1, 0, -1):
        longer = types[types >> 48 == n + 1]
        found, count = np.unique(_shorter(longer), return_counts=True)
        own = grams[grams >> 48 == n]  # begins at the start of a word: nothing longer continues it
        merged, at = np.unique(np.concatenate([found, own]), return_inverse=True)
        levels[n] = (merged, np.bincount(at, np.concatenate([count, np.ones(len(own))])))
        types = np.concatenate([types, found])
    below_at, below = np.zeros(1, np.int64), np.full(1, 1 / 256)
    for n in range(1, ORDER):
        found, count = levels[n]
        _, which = np.unique(_context(found), return_inverse=True)
        total, kinds = np.bincount(which, count), np.bincount(which)
        if n == 1:
            back = np.full(len(found), below[0])
        else:
            at = np.minimum(np.searchsorted(below_at, _shorter(found)), len(below_at) - 1)
            back = np.where(below_at[at] == _shorter(found), below[at], 1 / 256)
        p = (np.maximum(count - DISCOUNT, 0) + DISCOUNT * kinds[which] * back) / total[which]
        levels[n] = (found, p)
        below_at, below = found, p
    out = np.full(len(grams), 1 / 256)
    for n, (found, p) in levels.items():
        sel = np.flatnonzero(grams >> 48 == n + 1)
        at = np.minimum(np.searchsorted(found, _shorter(grams[sel])), len(found) - 1)
        out[sel] = np.where(found[at] == _shorter(grams[sel]), p[at], 1 / 256)
    return out


@dataclass
class Model:
    """Log-likelihood ratios of known n-grams and of the backoff of known contexts."""

    grams: np.ndarray
    ratio: np.ndarray
    contexts: np.ndarray
    back: np.ndarray

    def of_grams(self, gram: np.ndarray, context: np.ndarray) -> np.ndarray:
        if not len(self.grams):
            return np.zeros(len(gram))
        at = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        out = np.where(self.contexts[at] == context, self.back[at], 0)
        at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
        return np.where(self.grams[at] == gram, self.ratio[at], out)

    def of_words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        gram, context, word = _grams(data, starts, ends)
        return np.bincount(word, self.of_grams(gram, context), len(starts))


@dataclass
class WordValues:
    """Log-likelihood ratios of whole words, by the sorted hashes of the words."""

    hashes: np.ndarray
    value: np.ndarray

    def of_words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.value[np.searchsorted(self.hashes, signed(hash_ranges(data, starts, ends)))]


def collected(counts: DataFrame, max_grams: int = MAX_GRAMS) -> tuple[np.ndarray, np.ndarray]:
    """N-grams in order and their counts (one column each); at most ``max_grams`` reach the driver.

    Of more n-grams those seen least often are left out; ``train`` keeps such counts distributed instead.
    """
    n = reduce(lambda a, b: a + b, [F.col(c) for c in _COUNTS])
    if counts.count() > max_grams:
        by_size = counts.groupBy(n.alias("n")).agg(F.count(F.lit(1)).alias("grams"))
        sizes = by_size.orderBy(F.desc("n")).limit(max_grams).toPandas()
        fits = sizes[sizes.grams.cumsum() <= max_grams]
        counts = counts.where(n >= (int(fits.n.min()) if len(fits) else int(sizes.n.max()) + 1))
    got = counts.select("gram", *[F.col(c).cast("float") for c in _COUNTS]).toArrow()
    gram = got.column(0).to_numpy()
    order = gram.argsort()
    return gram[order], np.column_stack([got.column(c).to_numpy()[order] for c in _COUNTS])


def estimates(gram: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[Model]:
    """A model for each pair of toxic and ordinary counts of the n-grams ``gram`` (sorted).

    The models share the arrays of n-grams and contexts, and the backoff distribution.
    """
    if not len(gram):
        none = np.zeros(0)
        return [Model(none.astype(np.int64), none, none.astype(np.int64), none) for _ in pairs]
    ctx, which = np.unique(_context(gram), return_inverse=True)
    which, shared = which.astype(np.int32), _shared(gram)
    models = []
    for pair in pairs:
        ratio, back = 0.0, 0.0
        for sign, n in zip((1, -1), pair):
            total, kinds = np.bincount(which, n), np.bincount(which, n > 0)
            weight = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
            ratio += sign * np.log(np.maximum(n - DISCOUNT, 0) / np.maximum(total[which], 1) + weight[which] * shared)
            back += sign * np.log(weight)
        models.append(Model(gram, ratio.astype(np.float32), ctx, back.astype(np.float32)))
    return models


# --- the same estimates over any number of n-grams -----------------------------------------

def _suffix(n: int) -> Column:
    """The n-gram (of length ``n + 1``) without its oldest byte."""
    return F.col("gram").bitwiseAND((1 << 8 * n) - 1).bitwiseOR(n << 48)


def _prefix(gram: Column) -> Column:
    """``_context`` of a column."""
    length = F.shiftright(gram, 48)
    return F.shiftright(gram.bitwiseAND((1 << 48) - 1), 8).bitwiseOR(F.shiftleft(length - 1, 48))


def shared_table(grams: DataFrame) -> DataFrame:
    """``(gram, shared)``: ``_shared`` of the distinct n-grams of the stored table ``grams``."""
    def of_length(n: int) -> DataFrame:
        return grams.where(F.shiftright("gram", 48) == n).select("gram")

    levels: dict[int, DataFrame] = {}
    longer = of_length(ORDER)
    for n in range(ORDER - 1, 0, -1):
        found = checkpointed(longer.select(_suffix(n).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
        own = of_length(n).withColumn("n", F.lit(1).cast("bigint"))
        levels[n] = checkpointed(found.unionByName(own).groupBy("gram").agg(F.sum("n").alias("n")).withColumn("context", _prefix(F.col("gram"))))
        longer = of_length(n).unionByName(found.select("gram"))
    unseen, out, below = F.lit(1 / 256), [], None
    for n in range(1, ORDER):
        totals = levels[n].groupBy("context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        level = levels[n].join(totals, "context")
        if below is None:
            level = level.withColumn("back", unseen)
        else:
            level = level.withColumn("shorter", _suffix(n - 1)).join(below, "shorter", "left").withColumn("back", F.coalesce("p", unseen))
        p = (F.greatest(F.col("n") - F.lit(DISCOUNT), F.lit(0.0)) + F.lit(DISCOUNT) * F.col("kinds") * F.col("back")) / F.col("total")
        below = checkpointed(level.select(F.col("gram").alias("shorter"), p.alias("p")))
        longer = of_length(n + 1).withColumn("shorter", _suffix(n)).join(below, "shorter", "left")
        out.append(longer.select("gram", F.coalesce("p", unseen).alias("shared")))
    return reduce(DataFrame.unionByName, out)


@dataclass
class ModelTables:
    """The arrays of ``Model`` as tables; column 0 is the model of all counts, ``k + 1`` that without fold ``k``."""

    ratios: DataFrame  # gram, r0, r1, ...
    backs: DataFrame  # context, b0, b1, ...


def estimate_tables(counts: DataFrame) -> ModelTables:
    """``estimates`` of all counts and of those without one fold, by joins over the stored table ``counts``."""
    models = range(FOLDS + 1)
    n = {}
    for kind in "to":
        total = reduce(lambda a, b: a + b, [F.col(f"{kind}{k}") for k in range(FOLDS)])
        n |= {f"{kind}n{k}": total - F.col(f"{kind}{k - 1}") if k else total for k in models}
    rows = counts.select("gram", _prefix(F.col("gram")).alias("context"), *[c.alias(name) for name, c in n.items()])
    sums = rows.groupBy("context").agg(*[
        c for k in n for c in (F.sum(k).alias(f"{k}_total"), F.sum((F.col(k) > 0).cast("bigint")).alias(f"{k}_kinds"))
    ])

    def weight(k: str) -> Column:
        total = F.col(f"{k}_total")
        return F.when(total > 0, F.lit(DISCOUNT) * F.col(f"{k}_kinds") / F.greatest(total, F.lit(1))).otherwise(F.lit(1.0))

    sums = checkpointed(sums.select("context", *[F.col(f"{k}_total") for k in n], *[weight(k).alias(f"{k}_weight") for k in n]))

    def log_p(k: str) -> Column:
        own = F.greatest(F.col(k) - F.lit(DISCOUNT), F.lit(0.0)) / F.greatest(F.col(f"{k}_total"), F.lit(1))
        return F.log(own + F.col(f"{k}_weight") * F.col("shared"))

    met = rows.join(sums, "context").join(shared_table(counts.select("gram")), "gram")
    ratios = met.select("gram", *[(log_p(f"tn{k}") - log_p(f"on{k}")).cast("float").alias(f"r{k}") for k in models])
    backs = sums.select("context", *[
        (F.log(f"tn{k}_weight") - F.log(f"on{k}_weight")).cast("float").alias(f"b{k}") for k in models
    ])
    return ModelTables(checkpointed(ratios), checkpointed(backs))


def word_values(words: DataFrame, tables: ModelTables) -> DataFrame:
    """``(hash, v0, v1, ...)``: what each model gives for each word of ``(hash, word)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1).cast(pa.large_binary())
            _, offs, data = column.buffers()
            offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]
            if not len(column):
                continue
            gram, context, word = _grams(np.frombuffer(data, np.uint8), offsets[:-1], offsets[1:])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(word)), pa.array(gram), pa.array(context)], ["hash", "gram", "context"]
            )

    models = range(FOLDS + 1)
    grams = words.select("hash", "word").mapInArrow(run, "hash bigint, gram bigint, context bigint")
    met = grams.join(tables.ratios, "gram", "left").join(tables.backs, "context", "left")
    value = [F.sum(F.coalesce(f"r{k}", f"b{k}", F.lit(0.0)).cast("double")).alias(f"v{k}") for k in models]
    return met.groupBy("hash").agg(*value)


@dataclass
class Scorer:
    """The model of all counts, those that leave out one fold, and the curve's coefficients.

    Beyond ``MAX_GRAMS`` n-grams the models are ``tables`` and not held here.
    """

    whole: Model | None
    without: list[Model]
    curve: np.ndarray
    tables: ModelTables | None = None


def _features(model: Model | WordValues, column: pa.Array) -> np.ndarray:
    """Per row: ratio per word over the whole text, and over its best passage of each width."""
    out = np.zeros((len(column), 1 + len(PASSAGES)))
    for s in _lowered(column):
        starts, ends, row = _pieces(s)
        if not len(starts):
            continue
        a, b, which = _distinct(s.data, starts, ends)
        per_word = model.of_words(s.data, a, b)[which]
        sums = np.concatenate([[0.0], np.cumsum(per_word)])
        bounds = np.searchsorted(row, np.arange(s.n + 1))
        lo, hi = bounds[:-1], bounds[1:]
        some = np.flatnonzero(hi > lo)
        out[s.first + some, 0] = (sums[hi[some]] - sums[lo[some]]) / (hi[some] - lo[some])
        for k, width in enumerate(PASSAGES, 1):
            # a passage starts at every word and ends with the text at the latest
            left = np.maximum(np.minimum(np.arange(len(row)), hi[row] - width), lo[row])
            right = np.minimum(left + width, hi[row])
            best = (sums[right] - sums[left]) / (right - left)
            out[s.first + some, k] = np.maximum.reduceat(best, lo[some])
    return out


def _spread(x: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(x)), x])


def _fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, lightly ridged."""
    x, beta = _spread(x), np.zeros(x.shape[1] + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        g = x.T @ (y - p) - 1e-2 * beta
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(beta))
        step = np.linalg.solve(h, g)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def train(docs: DataFrame, labels: DataFrame, calibration_rows: int = CALIBRATION_ROWS, max_grams: int = MAX_GRAMS) -> Scorer:
    """Scorer from the texts of ``docs`` and the ``toxic`` marks of ``labels`` (both by ``doc_id``).

    All labelled texts give counts; at most ``calibration_rows`` of them fit the curve. Rows
    without a mark or with a mark other than 0 and 1 teach nothing. A document with several
    marks counts once with each. Without both marks every text scores the same.
    """
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    marks = checkpointed(labels.where("toxic in (0, 1) and doc_id is not null").select("doc_id", "toxic", fold))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    counts = checkpointed(gram_counts(texts.join(sized_broadcast(marks), "doc_id")))
    curve = np.zeros(2 + len(PASSAGES))
    if counts.count() > max_grams:
        scorer = Scorer(None, [], curve, estimate_tables(counts))
    else:
        gram, n = collected(counts, max_grams)
        t, o = n[:, 1::2], n[:, 0::2]
        pairs = [(t.sum(1), o.sum(1))] + [(t.sum(1) - t[:, k], o.sum(1) - o[:, k]) for k in range(FOLDS)]
        whole, *without = estimates(gram, pairs)
        scorer = Scorer(whole, without, curve)
    few = marks.orderBy(F.xxhash64("doc_id", F.lit("curve")), "doc_id").limit(calibration_rows)
    marked = texts.join(F.broadcast(checkpointed(few)), "doc_id").select("toxic", "fold", "text")
    got = _figures(marked, scorer, ["toxic", "fold"], own_fold=True).toPandas()
    if got.toxic.nunique() == 2:
        scorer.curve = _fit_curve(got[_FIGURES].to_numpy(), got.toxic.to_numpy(np.float64))
    return scorer


_FIGURES = [f"_ratio{k}" for k in range(1 + len(PASSAGES))]


def _kinds(docs: DataFrame, keep: list[str]) -> str:
    return ", ".join([f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep] + [f"{f} double" for f in _FIGURES])


def _figures(docs: DataFrame, scorer: Scorer, keep: list[str], own_fold: bool = False) -> DataFrame:
    """``keep`` columns with the length-normalised ratios; with ``own_fold`` by the model without that fold."""
    if scorer.tables is not None:
        return _figures_of_words(docs, scorer.tables, keep, own_fold)
    shared = docs.sparkSession.sparkContext.broadcast(scorer if own_fold else scorer.whole)
    sent, at = _sent(docs, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(at)
            if own_fold:
                fold = batch.column(1).to_numpy(zero_copy_only=False)
                x = np.zeros((batch.num_rows, len(_FIGURES)))
                for k, model in enumerate(shared.value.without):
                    x[fold == k] = _features(model, text.filter(pa.array(fold == k)))
            else:
                x = _features(shared.value, text)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], *[pa.array(c) for c in np.ascontiguousarray(x.T)]], [*keep, *_FIGURES]
            )

    return sent.mapInArrow(run, _kinds(docs, keep))


def _sent(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, int]:
    """``keep`` columns and the text, once, and the place of the text."""
    columns = [F.col(f"`{k}`") for k in keep]
    if "text" in keep and docs.schema["text"].dataType.simpleString() == "string":
        return docs.select(*columns), keep.index("text")
    return docs.select(*columns, F.col("text").cast("string").alias("_scored_text")), len(keep)


def _figures_of_words(docs: DataFrame, tables: ModelTables, keep: list[str], own_fold: bool) -> DataFrame:
    """``_figures`` by the values of words: texts are dealt to units, which meet the values of their distinct words."""
    sent, at = _sent(docs, keep)
    text = F.col(f"`{sent.columns[at]}`")
    units = math.ceil((sent.agg(F.sum(F.octet_length(text))).first()[0] or 0) / UNIT_BYTES) or 1
    dealt = sent.withColumn("_unit", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in sent.columns]), F.lit(units)))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = batch.column(1).to_numpy(zero_copy_only=False)
            for s in _lowered(batch.column(0)):
                starts, ends, row = _pieces(s)
                if not len(starts):
                    continue
                h, of = signed(hash_ranges(s.data, starts, ends)), unit[s.first + row]
                order = np.lexsort((h, of))
                new = np.ones(len(h), bool)
                new[1:] = (np.diff(h[order]) != 0) | (np.diff(of[order]) != 0)
                first = order[new]
                words = [s.data[starts[i] : ends[i]].tobytes() for i in first]
                yield pa.RecordBatch.from_arrays([pa.array(of[first]), pa.array(h[first]), pa.array(words, pa.binary())], ["_unit", "hash", "word"])

    found = dealt.select(text, "_unit").mapInArrow(find, "_unit bigint, hash bigint, word binary")
    found = checkpointed(found.groupBy("_unit", "hash").agg(F.first("word").alias("word")))
    values = word_values(found.groupBy("hash").agg(F.first("word").alias("word")), tables)
    wanted = [f"v{k}" for k in (range(1, FOLDS + 1) if own_fold else (0,))]
    valued = found.select("_unit", "hash").join(values.select("hash", *wanted), "hash")

    def meet(rows: pa.Table, words: pa.Table) -> pa.Table:
        column = rows.column(at).combine_chunks()
        words = words.sort_by("hash")
        h = words.column("hash").to_numpy()
        models = [WordValues(h, words.column(v).to_numpy()) for v in wanted]
        x = np.zeros((rows.num_rows, len(_FIGURES)))
        if own_fold:
            fold = rows.column(1).to_numpy()
            for k, model in enumerate(models):
                x[fold == k] = _features(model, column.filter(pa.array(fold == k)))
        elif rows.num_rows:
            x = _features(models[0], column)
        return pa.Table.from_arrays([*rows.columns[: len(keep)], *[pa.array(c) for c in np.ascontiguousarray(x.T)]], [*keep, *_FIGURES])

    return dealt.groupBy("_unit").cogroup(valued.groupBy("_unit")).applyInArrow(meet, _kinds(docs, keep))


def score(docs: DataFrame, scorer: Scorer, keep: list[str]) -> DataFrame:
    """``keep`` columns with ``_score`` in 0..1; null and empty texts score as a text without signal."""
    first, *rest = (float(v) for v in scorer.curve)
    z = reduce(lambda a, b: a + b, [F.lit(c) * F.col(f) for c, f in zip(rest, _FIGURES)], F.lit(first))
    figures = _figures(small_partitions(docs), scorer, keep)
    return figures.select(*[F.col(f"`{k}`") for k in keep], (1 / (1 + F.exp(-z))).alias("_score"))


def drop_toxic(docs: DataFrame, labels: DataFrame, limit: float = LIMIT) -> DataFrame:
    """Documents that score below ``limit``; the columns stay as they are."""
    small_batches(docs.sparkSession)
    model = train(docs, labels)
    kept = score(docs, model, docs.columns)
    return kept.where(F.col("_score") < limit).select(*docs.columns)

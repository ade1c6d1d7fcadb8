"""Quality rules with a robust multivariate outlier test.

Base rules judge a text by itself (too few words, too much repetition). The outlier test
compares it with its peers: the documents of one language and source, or of the language, or
all, whichever is the first with ``MIN_GROUP`` documents that pass the base rules. Each of
these groups is estimated over all its documents, whichever peers judge them. A text's statistics are shrunk to
typical values where it is short and transformed to even scales; location and scatter of each
group are minimum-covariance-determinant estimates, and a text whose squared Mahalanobis
distance exceeds ``CUTOFF`` is rejected.

The estimate starts from medians and interquartile ranges and takes concentration steps: the
``SHARE`` of documents with the smallest distances give the next location and scatter, until
the determinants stop falling. Each step is two combinable aggregations over all documents,
so a group that holds a third of them needs no task of its own. A floor on the scatter of
each statistic keeps groups in which it hardly varies from rejecting small deviations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.text import checkpointed, find_words, hash_ranges, mixed, rolling, sized_broadcast, slices, small_partitions

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_GROUP = 50
SHARE = 0.75
MAX_STEPS = 8
# Estimates of up to this many groups (some 250 bytes each) are broadcast, more are joined by shuffle.
GROUP_ROWS = 50_000
# Bound on the error of the distance quantiles is 1 / QUANTILE_ACCURACY of a group.
QUANTILE_ACCURACY = 1000
# Upper tail of the chi-square law that a document must fall in to be rejected, as a normal quantile (1e-6).
TAIL_Z = 4.753
# Statistics of the vector and the least standard deviation each is given.
FLOORS = {"log_words": 0.6, "word_length": 0.5, "symbols": 0.3, "repeats": 0.4, "lines": 0.5}

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_NAMES = list(FLOORS)
_P = len(_NAMES)
_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def chi_square(z: float, p: int = _P) -> float:
    """Quantile of the chi-square law by its cube-root normal form."""
    return p * (1 - 2 / (9 * p) + z * np.sqrt(2 / (9 * p))) ** 3


CUTOFF = chi_square(TAIL_Z)


def _statistics(column: pa.Array) -> np.ndarray:
    """Per text the counts ``_COLUMNS``."""
    out = np.zeros((len(column), len(_COLUMNS)), np.int64)
    for s in slices(column):
        w = find_words(s)
        rows = slice(s.first, s.first + s.n)
        out[rows, 0] = np.diff(w.bounds)
        # code points of words: their bytes without UTF-8 continuation bytes
        head = np.concatenate([[0], np.cumsum((s.data & 0xC0) != 0x80)])
        per_word = head[w.ends] - head[w.starts]
        sums = np.concatenate([[0], np.cumsum(per_word)])
        out[rows, 1] = np.diff(sums[w.bounds])
        out[rows, 2] = np.diff(np.searchsorted(np.flatnonzero(_SYMBOL[s.data]), s.offsets))
        raw = s.data.tobytes()
        for r in range(s.n):
            lines = [x for x in raw[s.offsets[r] : s.offsets[r + 1]].split(b"\n") if x.strip()]
            out[s.first + r, 3] = len(lines) - len(set(lines))
            out[s.first + r, 5] = len(lines)
        h = hash_ranges(s.data, w.starts, w.ends)
        windows = rolling(h, WINDOW)
        if len(windows):
            inside = np.flatnonzero(np.arange(len(windows)) + WINDOW <= w.bounds[1:][w.row[: len(windows)]])
            key = windows[inside] ^ mixed(w.row[inside].astype(np.uint64))
            _, which, n = np.unique(key, return_inverse=True, return_counts=True)
            twice = inside[n[which] > 1]
            edge = np.zeros(len(h) + 1, np.int64)
            edge[twice] += 1
            edge[twice + WINDOW] -= 1
            covered = np.cumsum(edge[:-1]) > 0
            out[rows, 4] = np.diff(np.concatenate([[0], np.cumsum(covered)])[w.bounds])
    return out


def statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns with the counts of every whole text; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = _statistics(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array(np.ascontiguousarray(c)) for c in counts.T]], [*keep, *_COLUMNS]
            )

    kinds = ", ".join([f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep] + [f"{c} bigint" for c in _COLUMNS])
    texts = docs.select(*keep, F.col("text").cast("string").alias("_judged_text"))
    return small_partitions(texts).mapInArrow(run, kinds)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def vector() -> list[Column]:
    """The transformed statistics, shrunk where there is little text."""
    n = F.col("n_words")
    return [
        F.log1p(n).alias("log_words"),
        ((F.col("word_chars") + 6 * 50) / (n + 50)).alias("word_length"),
        F.asinh(10 * F.col("n_symbols") / (n + 20)).alias("symbols"),
        F.asinh(10 * F.col("n_repeat_words") / (n + 20)).alias("repeats"),
        F.asinh(10 * F.col("n_dup_lines") / (F.col("n_lines") + 10)).alias("lines"),
    ]


def _distance() -> Column:
    """Squared Mahalanobis distance by the columns ``mean`` and ``inverse`` (row by row)."""
    d = [F.col(x) - F.get("mean", F.lit(i)) for i, x in enumerate(_NAMES)]
    terms = [
        F.get("inverse", F.lit(i * _P + j)) * d[i] * d[j] * (1 if i == j else 2) for i in range(_P) for j in range(i, _P)
    ]
    return sum(terms[1:], terms[0])


def _moments() -> list[Column]:
    pairs = [(i, j) for i in range(_P) for j in range(i, _P)]
    return [
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(x) for x in _NAMES]).alias("mean"),
        F.array(*[F.avg(F.col(_NAMES[i]) * F.col(_NAMES[j])) for i, j in pairs]).alias("products"),
    ]


def _inverted(groups: DataFrame) -> DataFrame:
    """``(peers, mean, inverse, logdet)`` from means, mean products and the factor ``scale``."""
    upper = np.triu_indices(_P)
    floor = np.diag(np.square(list(FLOORS.values())))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            inverse, logdet = [], []
            for mean, products, scale in zip(b["mean"], b["products"], b["scale"]):
                cov = np.zeros((_P, _P))
                cov[upper] = products
                cov = cov + np.triu(cov, 1).T - np.outer(mean, mean)
                cov = scale * cov + floor
                inverse.append(np.linalg.inv(cov).ravel())
                logdet.append(float(np.linalg.slogdet(cov)[1]))
            yield pd.DataFrame({"peers": b["peers"], "mean": b["mean"], "inverse": inverse, "logdet": logdet})

    return groups.select("peers", "mean", "products", "scale").mapInPandas(
        run, "peers string, mean array<double>, inverse array<double>, logdet double"
    )


def _peers(stats: DataFrame) -> DataFrame:
    """Add ``peers``, the smallest large enough group of language and source, language, or all, and ``teaches``.

    ``teaches`` holds those groups of the document that judge any document: it enters the estimate of each.
    """
    tag = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    keyed = stats.withColumns({"_lang": tag("lang"), "_both": F.to_json(F.array(tag("lang"), tag("source")))})
    passed = F.count(F.when(~F.col("base_failed"), 1))
    sizes = checkpointed(keyed.groupBy("_lang", "_both").agg(passed.alias("n")))
    wide = sizes.groupBy("_lang").agg(F.sum("n").alias("all"))
    chosen = checkpointed(sizes.join(wide, "_lang").select(
        "_lang", "_both",
        F.when(F.col("n") >= MIN_GROUP, F.col("_both")).when(F.col("all") >= MIN_GROUP, F.col("_lang")).otherwise("all").alias("peers"),
    ))
    # a language judges where one of its sources is small, all documents where one language is
    of_lang = chosen.groupBy("_lang").agg(F.max(F.col("peers") == F.col("_lang")).alias("judges"))
    of_all = chosen.agg(F.coalesce(F.max(F.col("peers") == "all"), F.lit(False))).first()[0]
    used = lambda key, when: F.when(when, F.array(key)).otherwise(F.array().cast("array<string>"))
    chosen = chosen.join(of_lang, "_lang").select(
        "_lang", "_both", "peers",
        F.concat(
            used(F.col("_both"), F.col("peers") == F.col("_both")), used(F.col("_lang"), F.col("judges")),
            used(F.lit("all"), F.lit(of_all)),
        ).alias("teaches"),
    )
    return keyed.join(sized_broadcast(checkpointed(chosen), GROUP_ROWS), ["_lang", "_both"]).drop("_lang", "_both")


def estimates(points: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant location and inverse scatter of each group of stored ``points``."""
    quartiles = [F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), QUANTILE_ACCURACY).alias(x) for x in _NAMES]
    start = points.groupBy("peers").agg(*quartiles)
    mid = [F.get(x, F.lit(1)) for x in _NAMES]
    spread = [(F.get(x, F.lit(2)) - F.get(x, F.lit(0))) / 1.349 for x in _NAMES]
    products = [mid[i] * mid[j] + (spread[i] * spread[i] if i == j else 0) for i in range(_P) for j in range(i, _P)]
    groups = checkpointed(_inverted(start.select("peers", F.array(*mid).alias("mean"), F.array(*products).alias("products"), F.lit(1.0).alias("scale"))))
    last = None
    for _ in range(MAX_STEPS):
        near = points.join(sized_broadcast(groups, GROUP_ROWS), "peers").withColumn("d2", _distance()).select("peers", *_NAMES, "d2")
        limit = checkpointed(near.groupBy("peers").agg(
            F.percentile_approx("d2", SHARE, QUANTILE_ACCURACY).alias("limit"), F.percentile_approx("d2", 0.5, QUANTILE_ACCURACY).alias("middle")
        ))
        inner = near.join(sized_broadcast(limit, GROUP_ROWS), "peers").where("d2 <= limit").groupBy("peers").agg(*_moments())
        groups = checkpointed(_inverted(inner.withColumn("scale", F.lit(1.0))))
        total = groups.agg(F.sum("logdet")).first()[0] or 0.0
        if last is not None and total > last - 1e-6 * max(1.0, abs(last)):
            break
        last = total
    # the half with the smallest distances should reach as far as a normal law's
    middle = points.join(sized_broadcast(groups, GROUP_ROWS), "peers").withColumn("d2", _distance()).groupBy("peers").agg(
        F.percentile_approx("d2", 0.5, QUANTILE_ACCURACY).alias("middle")
    )
    scale = F.greatest(F.lit(1.0), F.col("middle") / float(chi_square(0.0)))
    widened = groups.join(middle, "peers").withColumn("scale", scale)
    return checkpointed(widened.select("peers", "mean", F.transform("inverse", lambda x: x / F.col("scale")).alias("inverse")))


def judged(docs: DataFrame) -> DataFrame:
    """Counts, ``base_failed``, squared ``distance`` and ``kept`` of every document.

    Texts that fail the base rules don't enter the estimates and are not kept. Null language
    and source are values of their own. Repeated rows are judged each; an empty table gives
    an empty result.
    """
    stats = checkpointed(statistics(docs, ["doc_id", "lang", "source"]).withColumn("base_failed", base_failed()))
    points = checkpointed(_peers(stats).select("*", *vector()))
    teaching = points.where("not base_failed").select(F.explode("teaches").alias("peers"), *_NAMES)
    groups = estimates(teaching)
    far = points.join(sized_broadcast(groups, GROUP_ROWS), "peers", "left").withColumn("distance", _distance())
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= F.lit(float(CUTOFF)))
    return far.withColumn("kept", kept).select(
        "doc_id", *_COLUMNS[:5], "base_failed", "kept", "distance", "lang", "source", "peers"
    )

"""Column expressions shared by the feature builders. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: str | Column, den: str | Column, eps: float = 1e-9) -> Column:
    """``num / (den + eps)``: finite for a zero denominator."""
    return col(num) / (col(den) + F.lit(eps))


def micros(ts: str | Column) -> Column:
    return F.unix_micros(col(ts).cast("timestamp"))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Fractional seconds from ``start`` to ``end``."""
    return (micros(end) - micros(start)) / F.lit(1e6)


def abs_seconds_between(a: str | Column, b: str | Column) -> Column:
    return F.abs(micros(a) - micros(b)) / F.lit(1e6)


def hour_of_day(ts: str | Column) -> Column:
    return F.hour(col(ts))


def day_of_week(ts: str | Column) -> Column:
    """Monday is 0."""
    return F.weekday(col(ts))


def is_weekend(ts: str | Column) -> Column:
    return (F.weekday(col(ts)) >= 5).cast("int")


def hour_bucket(ts: str | Column) -> Column:
    """Six-hour quarter of the day as 0.0 .. 3.0."""
    return F.floor(F.hour(col(ts)) / 6).cast("double")


def md5_int(value: str | Column) -> Column:
    """First 32 bits of the MD5 of the value's text, as a non-negative long."""
    digest = F.md5(col(value).cast("string").cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def cells_text(*parts: str | Column) -> Column:
    """The parts as one text that no other list of as many parts gives: ``length:text`` or ``-`` for null."""
    texts = [col(p).cast("string") for p in parts]
    return F.concat_ws("|", *[
        F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ])


def md5_long(*parts: str | Column) -> Column:
    """60-bit non-negative integer from the MD5 of the parts.

    A function of the values only, so samples and splits built on it do not change
    with partitioning or retries. Parts are written with their lengths and null as a
    mark of its own, so different lists of parts give different texts.
    """
    text = cells_text(*parts)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def hash_bucket(value: str | Column, buckets: int) -> Column:
    """Process-independent bucket of a value; null maps to -1."""
    return F.coalesce(md5_int(value) % F.lit(buckets), F.lit(-1).cast("bigint"))


def vocabulary_code(value: str | Column, vocabulary: list[str]) -> Column:
    """Position in a fixed vocabulary; unknown and null map to -1."""
    position = F.array_position(F.array(*[F.lit(v) for v in vocabulary]), col(value))
    return F.coalesce(position - 1, F.lit(-1).cast("bigint"))


def changed_flag(a: str | Column, b: str | Column) -> Column:
    """1 when the values differ; a null on either side counts as a difference."""
    return F.coalesce(col(a) != col(b), F.lit(True)).cast("int")


def equal_flag(a: str | Column, b: str | Column) -> Column:
    """1 when both are present and equal."""
    return F.coalesce(col(a) == col(b), F.lit(False)).cast("int")


def null_equal_flag(a: str | Column, b: str | Column) -> Column:
    """1 when equal, with null equal to null."""
    return col(a).eqNullSafe(col(b)).cast("int")


def both_present(a: str | Column, b: str | Column) -> Column:
    return (col(a).isNotNull() & col(b).isNotNull()).cast("int")


def one_present(a: str | Column, b: str | Column) -> Column:
    return (col(a).isNotNull() != col(b).isNotNull()).cast("int")


def none_present(a: str | Column, b: str | Column) -> Column:
    return (col(a).isNull() & col(b).isNull()).cast("int")


def distance_2d(x: str | Column, y: str | Column, px, py) -> Column:
    dx, dy = col(x) - F.lit(px), col(y) - F.lit(py)
    return F.sqrt(dx * dx + dy * dy)


def clipped_sqrt(value: str | Column) -> Column:
    return F.sqrt(F.greatest(col(value), F.lit(0.0)))


def label_code(value: str | Column, codes: dict[str, int]) -> Column:
    """Integer code of a label; labels not listed become null."""
    expr = F.lit(None).cast("int")
    for label, code in codes.items():
        expr = F.when(col(value) == label, F.lit(code)).otherwise(expr)
    return expr


def prefixed_id(prefix: str, value: str | Column) -> Column:
    return F.concat(F.lit(prefix), col(value).cast("string"))


def word_list(text: str | Column) -> Column:
    """Lower-case runs of letters a-z and digits, in order; null text gives no words."""
    words = F.regexp_extract_all(F.lower(col(text)), F.lit("([a-z0-9]+)"), F.lit(1))
    return F.coalesce(words, F.array().cast("array<string>"))


def word_set(text: str | Column) -> Column:
    return F.array_distinct(word_list(text))


def overlap_size(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def jaccard(a: Column, b: Column) -> Column:
    """|a & b| / |a | b|, and 0 when both sets are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, overlap_size(a, b) / union).otherwise(F.lit(0.0))


def first_word(words: Column) -> Column:
    return F.coalesce(F.get(words, F.lit(0)), F.lit(""))


def floored_price(price: str | Column, floor: float = 0.01) -> Column:
    """Price with null, NaN and anything below ``floor`` raised to ``floor``."""
    return F.greatest(F.lit(floor), F.nanvl(col(price).cast("double"), F.lit(floor)))


def abs_log_ratio(a: str | Column, b: str | Column) -> Column:
    return F.abs(F.log(floored_price(a)) - F.log(floored_price(b)))


def l2_squared(a: str | Column, b: str | Column) -> Column:
    parts = F.zip_with(col(a), col(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: str | Column, b: str | Column) -> Column:
    parts = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: str | Column, b: str | Column) -> Column:
    """Cosine similarity, 0 when either vector has zero length."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms).otherwise(F.lit(0.0))

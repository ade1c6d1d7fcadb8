"""Repeatable splits and samples: functions of row keys, not of partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions import scalar as S
from loomline.operators.groups import first_n, top_k


def with_split(df: DataFrame, key: Sequence[str], test_fraction: float = 0.2, seed: int = 42, name: str = "is_test") -> DataFrame:
    """Add a boolean that is true for about ``test_fraction`` of the keys."""
    bucket = S.md5_long(F.lit(str(seed)), *key) % 1_000_000
    return df.withColumn(name, bucket < int(test_fraction * 1_000_000))


def train_test(df: DataFrame, key: Sequence[str], test_fraction: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    marked = with_split(df, key, test_fraction, seed, "_is_test")
    return marked.where("NOT _is_test").drop("_is_test"), marked.where("_is_test").drop("_is_test")


def sample_n(df: DataFrame, key: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` rows without replacement, by hash order of the key."""
    hashed = df.withColumn("_h", S.md5_long(F.lit(str(seed)), *key))
    return first_n(hashed, [F.col("_h"), *[F.col(k) for k in key]], n).drop("_h")


def stratified_sample(df: DataFrame, stratum: str, key: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` rows per stratum, by hash order of the key."""
    hashed = df.withColumn("_h", S.md5_long(F.lit(str(seed)), *key))
    picked = top_k(hashed, [stratum], [F.col("_h"), *[F.col(k) for k in key]], n, "_r")
    return picked.drop("_h", "_r")


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in key order."""
    return first_n(df, [F.col(c) for c in order], n)

"""Preparing user-item interactions: de-duplication, k-core, dense ids and hold-out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions import scalar as S
from loomline.operators.groups import (
    checkpointed,
    lookup_join,
    with_position,
)

# Fixed values.
MIN_USERS_PER_ITEM = 3
MIN_ITEMS_PER_USER = 3
HOLDOUT_FRACTION = 0.20
MIN_HOLDOUT_SIZE = 3
MAX_INT = 2**31 - 1


def require_columns(df: DataFrame, needed: Sequence[str]) -> DataFrame:
    """Return ``df``; raise with the missing names if its schema lacks any."""
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"input is missing columns: {missing}")
    return df


def keep_last(df: DataFrame, keys: Sequence[str], recency: Sequence[str]) -> DataFrame:
    """One row per key: the largest by ``recency``. Combines map-side."""
    rest = [c for c in df.columns if c not in keys and c not in recency]
    newest = F.max(F.struct(*recency, *rest)).alias("_last")
    kept = df.groupBy(*keys).agg(newest)
    return kept.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns])


def partner_counts(df: DataFrame, key: str, partner: str) -> DataFrame:
    """Distinct partners per key."""
    return df.groupBy(key).agg(F.count_distinct(partner).alias("n_partners"))


def k_core(
    df: DataFrame, user: str = "user_id", item: str = "item_id",
    min_users: int = MIN_USERS_PER_ITEM, min_items: int = MIN_ITEMS_PER_USER,
    max_passes: int | None = None,
) -> DataFrame:
    """Drop items with few users, then users with few items, until nothing changes.

    ``max_passes`` ends earlier: the result may then hold keys below the minimum.

    Each pass removes the keys below the minimum by anti-join: those keys have few
    rows by definition, so the removed side is never hot. Rows that are unique by user and
    item are counted as they are, so a pass moves counts only; otherwise partners are made
    distinct in every pass.
    """
    current = checkpointed(df)
    before = current.count()
    same = current.where(F.col(user).isNotNull() & F.col(item).isNotNull()).groupBy(user, item).agg(F.count(F.lit(1)).alias("_n"))
    unique = same.where("_n > 1").isEmpty()

    def weak(rows: DataFrame, key: str, partner: str, least: int) -> DataFrame:
        if unique:
            n = rows.groupBy(key).agg(F.count(partner).alias("n_partners"))  # null partners do not count
        else:
            n = partner_counts(rows, key, partner)
        return n.where(F.col("n_partners") < least).select(key)

    for _ in count() if max_passes is None else range(max_passes):
        step = lookup_join(current, weak(current, item, user, min_users), [item], "left_anti")
        step = lookup_join(step, weak(step, user, item, min_items), [user], "left_anti")
        current = checkpointed(step.where(F.col(user).isNotNull() & F.col(item).isNotNull()))
        after = current.count()
        if after == before:
            break
        before = after
    return current


def dense_ids(df: DataFrame, column: str, index: str) -> DataFrame:
    """Distinct non-null values numbered 0..n-1 in sorted order, as an int column.

    Numbering is by range slices with per-slice offsets: no single-task window and
    no vocabulary on the driver.
    """
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    numbered = with_position(values, [], [F.col(column)], index)
    limit = F.lit(MAX_INT)
    too_many = F.raise_error(F.lit(f"more than {MAX_INT} distinct values of {column}"))
    return numbered.select(
        column, F.when(F.col(index) > limit, too_many.cast("int")).otherwise(F.col(index).cast("int")).alias(index)
    )


def leave_k_out(
    df: DataFrame, user: str = "user_id", item: str = "item_id",
    fraction: float = HOLDOUT_FRACTION, min_size: int = MIN_HOLDOUT_SIZE, seed: int = 42,
) -> DataFrame:
    """Add ``is_test``: a random ``max(1, round(n * fraction))`` items per user.

    Users with fewer than ``min_size`` items stay in training. The order is a hash
    of (seed, user, item), so the split does not depend on partitioning.
    """
    hashed = df.withColumn("_h", S.md5_long(F.lit(str(seed)), user, item))
    sized = with_position(hashed, [user], [F.col("_h"), F.col(item)], "_pos", size="_n")
    n_test = F.greatest(F.lit(1), F.bround(F.col("_n") * F.lit(fraction)).cast("bigint"))
    is_test = (F.col("_n") >= min_size) & (F.col("_pos") < n_test)
    return sized.withColumn("is_test", is_test).drop("_h", "_pos", "_n")


@dataclass(frozen=True)
class InteractionData:
    """Prepared interactions in long form with their index tables."""

    train: DataFrame  # user_idx, item_idx, weight
    test: DataFrame  # user_idx, item_idx, weight
    entity_index: DataFrame  # entity_id, entity_idx
    item_index: DataFrame  # item_idx, item_id


def prepare_interactions(
    df: DataFrame, recency: Sequence[str], seed: int = 42,
) -> InteractionData:
    """Keep-last per pair, k-core, dense ids, then the per-user hold-out."""
    require_columns(df, ["user_id", "item_id", "weight", *recency])
    pairs = keep_last(df, ["user_id", "item_id"], recency).select("user_id", "item_id", "weight")
    core = k_core(pairs)
    if core.isEmpty():
        raise ValueError("no interactions remain after filtering; lower the minimum counts")
    users = dense_ids(core, "user_id", "user_idx")
    items = dense_ids(core, "item_id", "item_idx")
    indexed = lookup_join(lookup_join(core, users, ["user_id"]), items, ["item_id"])
    indexed = indexed.select("user_idx", "item_idx", F.col("weight").cast("float").alias("weight"))
    labelled = checkpointed(leave_k_out(indexed, "user_idx", "item_idx", seed=seed))
    return InteractionData(
        train=labelled.where("NOT is_test").drop("is_test"),
        test=labelled.where("is_test").drop("is_test"),
        entity_index=users.select(F.col("user_id").alias("entity_id"), F.col("user_idx").alias("entity_idx")),
        item_index=items.select("item_idx", "item_id"),
    )


def items_per_user(df: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Each user's distinct items as a sorted array, for interfaces that need arrays.

    The operators here work on long rows instead; this is only for output.
    """
    return df.groupBy(user).agg(F.array_sort(F.collect_set(item)).alias("items"))


def interaction_summary(df: DataFrame, user: str = "user_id", item: str = "item_id", weight: str = "weight") -> DataFrame:
    """Row, user and item counts, density and weight range in one row."""
    n_rows, n_users, n_items = F.count(F.lit(1)), F.count_distinct(user), F.count_distinct(item)
    totals = df.agg(
        n_rows.alias("n_rows"), n_users.alias("n_users"), n_items.alias("n_items"),
        F.min(weight).alias("weight_min"), F.max(weight).alias("weight_max"),
    )
    return totals.withColumn(
        "density", F.col("n_rows") / (F.col("n_users").cast("double") * F.col("n_items"))
    )



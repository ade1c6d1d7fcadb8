"""Fitting a factor model, ranking items per user, and popularity fallback."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.operators.groups import (
    checkpointed,
    ensure_checkpoint_dir,
    lookup_join,
    needs_split,
    top_k,
    with_lag,
    with_position,
)

# Users or items in a block of factors at most, and users of a block at least.
# A block is copied to every block of the other side, so what is shuffled falls with the size of blocks.
BLOCK_ROWS = 1 << 17
LEAST_ROWS = 4096
# Users and items scored by one matrix product: its result stays in a core's cache.
TILE_USERS, TILE_ITEMS = 512, 1024
# Iterations after which the factors are stored and the shuffle files of earlier iterations deleted.
STORE_EVERY = 2
# Fixed values.
ALS_DEFAULTS = {"als_factors": 32, "als_iterations": 10, "als_regularization": 0.01, "als_alpha": 20.0}


def fit_als(train: DataFrame, params: dict | None = None, seed: int = 42) -> ALSModel:
    """Implicit-feedback factorization of (user_idx, item_idx, weight); zero weights carry no signal."""
    p = ALS_DEFAULTS | (params or {})
    ensure_checkpoint_dir(train.sparkSession)
    als = ALS(
        userCol="user_idx", itemCol="item_idx", ratingCol="weight", implicitPrefs=True,
        rank=int(p["als_factors"]), maxIter=int(p["als_iterations"]),
        regParam=float(p["als_regularization"]), alpha=float(p["als_alpha"]),
        coldStartStrategy="nan", seed=seed, checkpointInterval=STORE_EVERY,
    )
    return als.fit(train.where("weight <> 0"))


def _places(marks: np.ndarray) -> np.ndarray:
    """Where a flat array of few true values has them: eight at a time are looked at first."""
    whole = len(marks) // 8 * 8
    near = (np.flatnonzero(marks[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([near[marks[near]], whole + np.flatnonzero(marks[whole:])])


def _best_in_block(
    x: np.ndarray, ids: np.ndarray, y: np.ndarray, hidden: list[np.ndarray], k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per user the ``k`` best (item, score) of one block of items sorted by id; ties by item.

    ``hidden`` has each user's masked places in ``ids``, sorted. Items come tile by tile, the longest
    vectors first; after the first tile a user's ``k``-th best score so far is the bound that others
    have to reach. A product is at most the lengths of its two vectors, so tiles of vectors too short
    for any user of a tile are left out; users are put together by the length that they ask for.
    """
    length = lambda m: np.sqrt((m.astype(np.float64) ** 2).sum(1))
    far = length(y)
    order = np.argsort(-far, kind="stable")
    ids, y, far = ids[order], y[order], far[order]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    sizes = np.array([len(m) for m in hidden], np.int64)
    starts = np.append(0, np.cumsum(sizes))
    masked = place[np.concatenate(hidden).astype(np.int64)] if len(hidden) else np.zeros(0, np.int64)
    # what a product in this precision may exceed the exact one by
    reach = length(x) * (1 + 4 * (x.shape[1] + 2) * float(np.finfo(x.dtype).eps)) if len(x) else np.zeros(0)
    values = np.full((len(x), k), -np.inf, x.dtype)
    items = np.zeros((len(x), k), ids.dtype)
    products, marks = (np.empty(min(len(x), TILE_USERS) * min(len(y), TILE_ITEMS), t) for t in (x.dtype, bool))

    def merge(users: np.ndarray, found: list[tuple[np.ndarray, ...]]) -> None:
        row, item, value = (np.concatenate(v) for v in zip(*found, (np.repeat(np.arange(len(users)), k), items[users].ravel(), values[users].ravel())))
        real = np.flatnonzero(value > -np.inf)
        real = real[np.lexsort((item[real], -value[real], row[real]))]
        row = row[real]
        at = np.arange(len(row)) - np.searchsorted(row, np.arange(len(users)))[row]
        real, row, at = real[at < k], row[at < k], at[at < k]
        values[users[row], at], items[users[row], at] = value[real], item[real]

    def search(users: np.ndarray, first: int, last: int) -> None:
        mine, n = x[users], sizes[users]
        who = np.repeat(np.arange(len(users)), n)
        where = masked[np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[users], n)]
        by_place = np.argsort(where, kind="stable")
        who, where = who[by_place], where[by_place]
        found, waiting = [], 0
        for lo in range(first, last, TILE_ITEMS):
            bound = values[users, -1]
            if not (reach[users] * far[lo] >= bound).any():
                break
            shape = len(users), min(lo + TILE_ITEMS, last) - lo
            scores, reached = (v[: shape[0] * shape[1]].reshape(shape) for v in (products, marks))
            np.matmul(mine, y[lo : lo + shape[1]].T, out=scores)
            begin, end = np.searchsorted(where, [lo, lo + scores.shape[1]])
            scores[who[begin:end], where[begin:end] - lo] = -np.inf
            if lo == 0 and scores.shape[1] > k:
                bound = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
            np.greater_equal(scores, bound[:, None], out=reached)
            row, col = np.divmod(_places(reached.ravel()), scores.shape[1])
            found.append((row, ids[lo + col], scores[row, col]))
            waiting += len(row)
            if waiting > 2 * k * len(users):
                merge(users, found)
                found, waiting = [], 0
        if waiting:
            merge(users, found)

    everyone = np.arange(len(x))
    for lo in range(0, len(x), TILE_USERS):
        search(everyone[lo : lo + TILE_USERS], 0, min(TILE_ITEMS, len(y)))
    with np.errstate(divide="ignore", invalid="ignore"):
        everyone = np.argsort(np.nan_to_num(values[:, -1] / reach, nan=-np.inf), kind="stable")
    for lo in range(0, len(x) if len(y) > TILE_ITEMS else 0, TILE_USERS):
        search(everyone[lo : lo + TILE_USERS], TILE_ITEMS, len(y))
    full = (values > -np.inf).sum(1)
    return [(items[i, :n], values[i, :n]) for i, n in enumerate(full)]


def _packed(rows: pd.DataFrame, block: str) -> pd.DataFrame:
    """A block of factors as one row: ids and vectors in the order of ids."""
    rows = rows.sort_values("id")
    vectors = np.stack([np.asarray(f, dtype=np.float32) for f in rows["features"]])
    return pd.DataFrame({
        block: [rows[block].iloc[0]], "ids": [rows["id"].to_numpy(np.int32).tobytes()], "vectors": [vectors.tobytes()],
    })


def _unpacked(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(rows["ids"].iloc[0], np.int32)
    return ids, np.frombuffer(rows["vectors"].iloc[0], np.float32).reshape(len(ids), -1)


def _score_block(asked: pd.DataFrame, found: pd.DataFrame, k: int) -> pd.DataFrame:
    users = asked[asked["ids"].notna()]
    if users.empty or found.empty:
        return pd.DataFrame({"user_idx": [], "item_idx": [], "score": []})
    (who, x), (ids, y) = _unpacked(users), _unpacked(found)
    seen = asked[asked["ids"].isna()]
    row = np.searchsorted(who, seen["user_idx"].to_numpy())
    col = np.searchsorted(ids, seen["item_idx"].to_numpy())
    fits = (row < len(who)) & (col < len(ids))
    row, col = row[fits], col[fits]
    fits = (who[row] == seen["user_idx"].to_numpy()[fits]) & (ids[col] == seen["item_idx"].to_numpy()[fits])
    row, col = row[fits], col[fits]
    order = np.argsort(row, kind="stable")
    hidden = np.split(col[order], np.searchsorted(row[order], np.arange(1, len(who))))
    best = _best_in_block(x, ids, y, hidden, k)
    return pd.DataFrame({
        "user_idx": np.repeat(who, [len(i) for i, _ in best]),
        "item_idx": np.concatenate([i for i, _ in best]), "score": np.concatenate([v for _, v in best]),
    })


def block_counts(n_users: int, n_items: int, block_rows: int, cores: int) -> tuple[int, int]:
    """Blocks of users and of items: as few as their size allows, of users enough for all cores."""
    u_blocks, i_blocks = (max(1, math.ceil(n / block_rows)) for n in (n_users, n_items))
    return max(u_blocks, min(math.ceil(n_users / LEAST_ROWS), math.ceil(2 * cores / i_blocks))), i_blocks


def recommend(
    model: ALSModel, users: DataFrame, k: int, seen: DataFrame | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Top ``k`` items per user as (user_idx, item_idx, score, rank), ties by item.

    User and item factors are cut into blocks, each one packed row, and each pair of blocks is scored by
    matrix products that keep ``k`` items per user. With ``seen`` (user_idx, item_idx)
    those items are masked inside the product, so memory stays ``k`` rows per user and
    block, however many items a user has seen. Users without factors get no rows. Blocks are as
    large as ``block_rows`` allows, but users are cut into enough of them to keep all cores busy.
    """
    wanted = checkpointed(users.select("user_idx").distinct())
    mine = checkpointed(lookup_join(model.userFactors, wanted.withColumnRenamed("user_idx", "id"), ["id"], "left_semi"))
    items = checkpointed(model.itemFactors)
    cores = mine.sparkSession.sparkContext.defaultParallelism
    u_blocks, i_blocks = block_counts(mine.count(), items.count(), block_rows, cores)

    def block(column: str, n: int):
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")

    def packed(factors: DataFrame, name: str, n: int, other: str, copies: int) -> DataFrame:
        rows = factors.select(block("id", n).alias(name), "id", "features").where(F.col("id").isNotNull() & F.col("features").isNotNull())
        rows = rows.groupBy(name).applyInPandas(lambda pdf: _packed(pdf, name), f"{name} int, ids binary, vectors binary")
        return checkpointed(rows).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))

    asked = packed(mine, "_ub", u_blocks, "_ib", i_blocks).select("_ub", "_ib", F.lit(0).alias("user_idx"), F.lit(0).alias("item_idx"), "ids", "vectors")
    if seen is not None:
        known = lookup_join(seen.select("user_idx", "item_idx").distinct(), wanted, ["user_idx"], "left_semi")
        none = F.lit(None).cast("binary")
        asked = asked.unionByName(known.select(
            block("user_idx", u_blocks).alias("_ub"), block("item_idx", i_blocks).alias("_ib"), "user_idx", "item_idx",
            none.alias("ids"), none.alias("vectors"),
        ))
    found = packed(items, "_ib", i_blocks, "_ub", u_blocks)
    scored = asked.groupBy("_ub", "_ib").cogroup(found.groupBy("_ub", "_ib")).applyInPandas(
        lambda a, b: _score_block(a, b, k), "user_idx int, item_idx int, score float"
    )
    return top_k(scored, ["user_idx"], [F.desc("score"), F.col("item_idx")], k)


def recommendation_lists(
    requests: DataFrame, recs: DataFrame, entity_index: DataFrame, item_index: DataFrame,
) -> DataFrame:
    """One row per requested ``entity_id`` with its ranked item ids; unknown entities get an empty list."""
    named = lookup_join(recs, item_index, ["item_idx"])
    lists = named.groupBy("user_idx").agg(
        F.array_sort(F.collect_list(F.struct("rank", "item_id"))).alias("_ranked")
    )
    lists = lists.select(F.col("user_idx").alias("entity_idx"), F.col("_ranked.item_id").alias("items"))
    known = lookup_join(requests, entity_index, ["entity_id"], "left")
    answered = lookup_join(known, lists, ["entity_idx"], "left")
    empty = F.array().cast(lists.schema["items"].dataType)
    return answered.select("entity_id", F.coalesce("items", empty).alias("items"))


def popularity(interactions: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Items with their distinct users and 0-based popularity position, ties by item."""
    counts = interactions.groupBy(item).agg(F.count_distinct(user).alias("n_users"))
    return with_position(counts, [], [F.desc("n_users"), F.col(item)], "popularity")


def popular_unseen(
    users: DataFrame, seen: DataFrame, k: int, user: str = "user_id", item: str = "item_id",
    ranked: DataFrame | None = None,
) -> DataFrame:
    """Top ``k`` most popular items each user has not seen, as (user, item, rank).

    A user's seen items cut the popularity order into gaps; the unseen items are
    the gaps, read from the front until ``k`` are found. The work is one row per
    seen item plus ``k`` per user, whatever the number of items.
    """
    ranked = ranked if ranked is not None else popularity(seen, user, item)
    ranked = checkpointed(ranked.select(item, F.col("popularity").alias("_at")))
    n_items = ranked.count()
    marks = lookup_join(seen.select(user, item).distinct(), ranked, [item]).select(user, "_at")
    marks = lookup_join(marks, users.select(user).distinct(), [user], "left_semi")
    ends = users.select(user).distinct().withColumn("_at", F.lit(n_items).cast("bigint"))
    marks = marks.unionByName(ends)
    split = needs_split(marks, [user])
    order = [F.col("_at")]
    marks = with_lag(marks, [user], order, {"_before": "_at"}, split)
    marks = with_position(marks, [user], order, "_i", split)
    start = F.coalesce(F.col("_before"), F.lit(-1)) + 1
    first_rank = start - F.col("_i")  # 0-based rank of the gap's first unseen item
    stop = F.least(F.col("_at") - 1, start + F.lit(k) - first_rank - 1)
    gaps = marks.select(user, "_i", start.alias("_start"), stop.alias("_stop"))
    gaps = gaps.where("_stop >= _start")
    filled = gaps.select(user, "_i", F.explode(F.sequence("_start", "_stop")).alias("_at"))
    filled = filled.select(user, (F.col("_at") - F.col("_i") + 1).cast("int").alias("rank"), "_at")
    return lookup_join(filled, ranked, ["_at"]).select(user, item, "rank")



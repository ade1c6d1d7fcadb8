"""Implicit-feedback factorization with confidence ``1 + alpha * weight``, and fold-in of new users.

The loss is ``sum c (1 if seen - x.y)^2`` over all user-item pairs, with confidence ``c`` of 1
for pairs not seen, plus ``reg`` times all squared factors. Its sum over unseen pairs needs no
rows: ``x' Y'Y x``, with the Gram matrix ``Y'Y`` of the other side's factors, added up by Spark
and ``rank`` squared numbers on the driver. A user's equations add ``alpha * w`` times the outer
product of each item seen; these sums stream over the user's rows, so no group is held in
memory, and users with very many rows are cut into parts whose sums are added by Spark. The
equations are solved by conjugate gradients.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions import scalar as S
from loomline.operators.groups import ROWS_PER_TASK, checkpointed, lookup_join

# Fixed values.
DEFAULTS = {"factors": 32, "iterations": 10, "regularization": 0.01, "alpha": 20.0, "seed": 42, "cg_steps": 6}
# Rows whose outer products are held at once.
TILE_ROWS = 4096


def solved(gram: np.ndarray, a: np.ndarray, b: np.ndarray, reg: float, steps: int, start: np.ndarray | None = None) -> np.ndarray:
    """``x`` with ``(gram + a + reg) x = b`` for every row, by conjugate gradients."""
    m = gram[None] + a + reg * np.eye(len(gram))[None]
    x = np.zeros_like(b) if start is None else start.copy()
    r = b - np.einsum("nij,nj->ni", m, x)
    d, rr = r.copy(), (r * r).sum(1)
    for _ in range(steps):
        live = rr > 1e-20
        if not live.any():
            break
        md = np.einsum("nij,nj->ni", m, d)
        step = np.where(live, rr / np.maximum((d * md).sum(1), 1e-300), 0.0)
        x += step[:, None] * d
        r -= step[:, None] * md
        new = (r * r).sum(1)
        d = r + np.where(live, new / np.maximum(rr, 1e-300), 0.0)[:, None] * d
        rr = new
    return x


def gram(factors: DataFrame, rank: int) -> np.ndarray:
    """``Y'Y`` of the factors, summed over partitions by Spark."""
    def outer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((rank, rank))
        for pdf in frames:
            if len(pdf):
                y = np.stack(pdf["f"].to_list())
                total += y.T @ y
        yield pd.DataFrame({"v": [total.ravel()]})

    parts = factors.select("f").mapInPandas(outer, "v array<double>")
    row = parts.agg(Summarizer.sum(array_to_vector("v")).alias("v")).select(vector_to_array("v").alias("v")).first()
    return np.array(row.v).reshape(rank, rank) if row.v is not None else np.zeros((rank, rank))


def _equations(ids: np.ndarray, weight: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of ``w y y'`` and ``(1 + w) y`` per run of equal ids (``w`` already times alpha)."""
    begin = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    a = np.add.reduceat(weight[:, None, None] * y[:, :, None] * y[:, None, :], begin)
    return ids[begin], a, np.add.reduceat((1.0 + weight)[:, None] * y, begin)


def half_step(rows: DataFrame, factors: DataFrame, p: dict, rank: int, whole: np.ndarray | None = None) -> DataFrame:
    """``(id, f)``: factors of one side, given rows ``(id, other, w)`` and the other side's ``(id, f)``."""
    whole = gram(factors, rank) if whole is None else whole
    alpha, reg, steps = float(p["alpha"]), float(p["regularization"]), int(p["cg_steps"])
    limit = int(rows.sparkSession.conf.get("spark.loomline.rowsPerTask", str(ROWS_PER_TASK)))
    counts = rows.groupBy("id").agg(F.ceil(F.count(F.lit(1)) / limit).alias("parts")).where("parts > 1")
    hot = checkpointed(counts)
    cut = rows.withColumn("parts", F.lit(1).cast("bigint")) if hot.isEmpty() else lookup_join(rows, hot, ["id"], "left").fillna(1, ["parts"])
    met = lookup_join(cut, factors.withColumnRenamed("id", "other"), ["other"])
    # one order of a user's rows, so that its sums do not depend on how they arrived
    dealt = met.withColumn("part", S.md5_long("other") % F.col("parts")).repartition("id", "part").sortWithinPartitions("id", "part", "other", "w")

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the last user's sums so far: its rows may go on
        for pdf in frames:
            for lo in range(0, len(pdf), TILE_ROWS):
                part = pdf.iloc[lo : lo + TILE_ROWS]
                if not len(part):
                    continue
                ids, a, b = _equations(part["id"].to_numpy(), alpha * part["w"].to_numpy(np.float64), np.stack(part["f"].to_list()))
                several = part["parts"].to_numpy()[np.searchsorted(part["id"].to_numpy(), ids)] > 1
                if held is not None:
                    if held[0][0] == ids[0]:
                        a[0] += held[1][0]
                        b[0] += held[2][0]
                    else:
                        yield finish(*held)
                if len(ids) > 1:
                    yield finish(ids[:-1], a[:-1], b[:-1], several[:-1])
                held = ids[-1:], a[-1:], b[-1:], several[-1:]
        if held is not None:
            yield finish(*held)

    def finish(ids, a, b, several) -> pd.DataFrame:
        x = solved(whole, a, b, reg, steps)
        sums = [np.concatenate([u.ravel(), v]) if s else None for u, v, s in zip(a, b, several)]
        return pd.DataFrame({"id": ids, "f": [None if s else v for v, s in zip(x, several)], "sums": sums})

    kind = rows.schema["id"].dataType.simpleString()
    found = dealt.select("id", "w", "f", "parts").mapInPandas(sums, f"id {kind}, f array<double>, sums array<double>")
    if hot.isEmpty():
        return found.select("id", "f")

    def together(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                v = np.stack(pdf["v"].to_list())
                x = solved(whole, v[:, : rank * rank].reshape(-1, rank, rank), v[:, rank * rank :], reg, steps)
                yield pd.DataFrame({"id": pdf["id"], "f": list(x)})

    found = checkpointed(found)
    parts = found.where("sums is not null").groupBy("id").agg(Summarizer.sum(array_to_vector("sums")).alias("v"))
    many = parts.select("id", vector_to_array("v").alias("v")).mapInPandas(together, f"id {kind}, f array<double>")
    return found.where("sums is null").select("id", "f").unionByName(many)


def _first(ids: DataFrame, rank: int, seed: int) -> DataFrame:
    """Small first factors from a hash of the id."""
    places = [(S.md5_long(F.lit(str(seed)), F.lit(str(j)), "id") / F.lit(float(1 << 60)) - 0.5) * (0.2 / math.sqrt(rank)) for j in range(rank)]
    return ids.select("id", F.array(*places).alias("f"))


def fit_implicit(train: DataFrame, params: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """User and item factors ``(id, f)``, stored, of ``(user_idx, item_idx, weight)`` with one row per pair.

    Rows with a null or non-positive weight say nothing and are left out.
    """
    p = DEFAULTS | (params or {})
    rank = int(p["factors"])
    seen = checkpointed(train.where(F.col("weight") > 0).select("user_idx", "item_idx", F.col("weight").cast("double").alias("w")))
    by_user = seen.select(F.col("user_idx").alias("id"), F.col("item_idx").alias("other"), "w")
    by_item = seen.select(F.col("item_idx").alias("id"), F.col("user_idx").alias("other"), "w")
    items = checkpointed(_first(by_item.select("id").distinct(), rank, int(p["seed"])))
    users = items.limit(0)
    for _ in range(int(p["iterations"])):
        users = checkpointed(half_step(by_user, items, p, rank))
        items = checkpointed(half_step(by_item, users, p, rank))
    return users, items


@dataclass(frozen=True)
class ImplicitFactors:
    """Factors as the ranking of ``recommend`` reads them."""

    userFactors: DataFrame  # id, features
    itemFactors: DataFrame

    @staticmethod
    def of(users: DataFrame, items: DataFrame) -> ImplicitFactors:
        named = [df.select("id", F.col("f").cast("array<float>").alias("features")) for df in (users, items)]
        return ImplicitFactors(*named)


def fold_in(rows: DataFrame, items: DataFrame, params: dict | None = None) -> DataFrame:
    """``(id, f)`` for users that the model does not know, from their rows ``(id, other, w)``: one solve each.

    Items without factors are left out; a user with none of the model's items gets no row.
    """
    p = DEFAULTS | (params or {})
    return half_step(rows.where(F.col("w") > 0), items, p, int(p["factors"]))


def implicit_loss(train: DataFrame, users: DataFrame, items: DataFrame, params: dict | None = None) -> float:
    """The loss over all pairs, by Gram matrices for the unseen ones."""
    p = DEFAULTS | (params or {})
    rank = int(p["factors"])
    gx, gy = gram(users, rank), gram(items, rank)
    rows = train.where(F.col("weight") > 0).select(F.col("user_idx").alias("id"), F.col("item_idx").alias("other"), F.col("weight").cast("double").alias("w"))
    met = lookup_join(lookup_join(rows, users, ["id"]), items.select(F.col("id").alias("other"), F.col("f").alias("g")), ["other"])
    s = F.aggregate(F.zip_with("f", "g", lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)
    c = 1.0 + float(p["alpha"]) * F.col("w")
    # a seen pair counts c (1 - s)^2 instead of the s^2 that the Gram matrices gave it
    own = met.select((c * (1.0 - s) * (1.0 - s) - s * s).alias("v")).agg(F.sum("v")).first()[0] or 0.0
    return float((gx * gy).sum() + own + float(p["regularization"]) * (np.trace(gx) + np.trace(gy)))

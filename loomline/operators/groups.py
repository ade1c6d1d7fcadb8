"""Ordered-window and join building blocks that stay balanced under hot keys.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task, and a
shuffle join does the same for the key's larger side. Both are fine until one
key holds a large share of the table. The functions here use the plain Spark
form when no group is too large for a task; otherwise they range-partition on
``(key, order)`` so that a hot group is spread over many tasks, work inside each
slice, and carry the few boundary values from one slice to the next.

A slice boundary cuts at most one group, so the carried tables have at most two
rows per range partition and are safe to broadcast whatever the data size.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Inputs below this size fit in a single task, so no group in them can be hot.
SMALL_INPUT_BYTES = 64 * 1024 * 1024
# Inputs below this size are not counted.
TINY_INPUT_BYTES = 8 * 1024 * 1024
# Sides up to this estimated size are broadcast.
BROADCAST_BYTES = 32 * 1024 * 1024
# Groups above this many rows are split.
ROWS_PER_TASK = 2_000_000
# Input bytes per slice when a group or a whole table is split into ranges.
SLICE_BYTES = 16 * 1024 * 1024
MAX_SLICES = 100_000
# Estimates from here on mean that the optimizer does not know a size.
UNKNOWN_BYTES = 2**60
ROW_BYTES = 64
# Assumed size of one value when a counted table is weighed for broadcasting.
CELL_BYTES = 32
# Upper bound on the number of keys treated as hot (bounds what is broadcast).
MAX_HOT_KEYS = 20_000

_PART = "_slice"
# Intermediate tables written by this process and not yet released.
_STORED: list[str] = []


def _setting(spark: SparkSession, name: str, default: int) -> int:
    return int(spark.conf.get(f"spark.loomline.{name}", str(default)))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a folder of our own only for local runs."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="loomline-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    This cuts the lineage, survives lost executors, and unlike an RDD checkpoint
    keeps column pruning and gives the optimizer real sizes.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/loomline/{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STORED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables stored so far; call it when no result that reads them is in use.

    Results are lazy, so the library can't know when that is. Returns how many were deleted.
    """
    paths, _STORED[:] = list(_STORED), []
    for path in paths:
        remove_stored(spark, path)
    return len(paths)


def stored_so_far() -> int:
    """How many intermediate tables are stored: a mark for ``drop_since``."""
    return len(_STORED)


def drop_since(spark: SparkSession, mark: int, kept: int) -> None:
    """Delete the tables stored since ``mark`` but for the last ``kept``, which must not be read through the others."""
    last = len(_STORED) - kept
    for path in _STORED[mark:last]:
        remove_stored(spark, path)
    del _STORED[mark:last]


def remove_stored(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate results that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def spread(stored: DataFrame) -> DataFrame:
    """Give a stored table at least as many partitions as the cluster has cores.

    For iterative training over a table whose few files would leave cores idle; a
    table with more partitions than cores is returned as it is.
    """
    cores = stored.sparkSession.sparkContext.defaultParallelism
    return stored.repartition(cores) if stored.rdd.getNumPartitions() < cores else stored


def dealt_by_value(stored: DataFrame) -> DataFrame:
    """A stored table in partitions and an order that depend on its rows alone, not on its files.

    For training that draws by partition and row, so that a refit on the same rows gives the same
    model. There are at least as many partitions as the cluster has cores.
    """
    cores = stored.sparkSession.sparkContext.defaultParallelism
    n = max(cores, math.ceil(stored.count() / ROWS_PER_TASK))
    columns = [F.col(f"`{c}`") for c in stored.columns]
    return stored.repartition(n, *columns).sortWithinPartitions(*columns)


def input_bytes(df: DataFrame) -> int:
    """Optimizer's size estimate summed over the plan's leaves (no job)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    total = 0
    for i in range(leaves.size()):
        total += int(str(leaves.apply(i).stats().sizeInBytes()))
    return total


def output_bytes(df: DataFrame) -> int:
    """Optimizer's size estimate of the result (no job)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small_input(df: DataFrame) -> bool:
    """Whether the whole of ``df`` fits in one task, by its leaves' bytes and by its own rows.

    Rows are counted unless the leaves are tiny: constant keys compress to almost nothing,
    and joins and explodes give more rows than the leaves have.
    """
    size = input_bytes(df)
    if size > _setting(df.sparkSession, "smallInputBytes", SMALL_INPUT_BYTES):
        return False
    return size <= TINY_INPUT_BYTES or df.count() <= _setting(df.sparkSession, "rowsPerTask", ROWS_PER_TASK)


def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Keys with more rows than one task should hold, or ``None``.

    The threshold is at least ``total / MAX_HOT_KEYS``, so no more than
    ``MAX_HOT_KEYS`` keys can exceed it and the result may be broadcast at any scale.
    """
    if is_small_input(df):
        return None
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = df.count()
    limit = max(_setting(df.sparkSession, "rowsPerTask", ROWS_PER_TASK), total / MAX_HOT_KEYS)
    hot = checkpointed(counts.where(F.col("_rows") > limit).select(*keys))
    return None if hot.isEmpty() else hot


def needs_split(df: DataFrame, keys: Sequence[str]) -> bool:
    """True when some group of ``keys`` is too large for one task."""
    if is_small_input(df):
        return False
    if not keys:
        return True
    limit = _setting(df.sparkSession, "rowsPerTask", ROWS_PER_TASK)
    biggest = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).agg(F.max("_rows")).first()[0]
    )
    return biggest is not None and biggest > limit


def _range_slices(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Range-partition on (keys, order) and record the slice each row fell in.

    The slice number comes from the physical partition, so the frame is written
    to reliable storage once; later steps and task retries all see the same one.
    """
    per_slice = max(1, _setting(df.sparkSession, "sliceBytes", SLICE_BYTES))
    size = input_bytes(df)
    if size >= UNKNOWN_BYTES:  # some leaf has no size: count rows instead
        size = df.count() * ROW_BYTES
    slices = min(max(2, math.ceil(size / per_slice)), MAX_SLICES)
    sorted_parts = df.repartitionByRange(slices, *[F.col(k) for k in keys], *order)
    return checkpointed(sorted_parts.withColumn(_PART, F.spark_partition_id()))


def _join_carry(df: DataFrame, carry: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    on = [*keys, _PART]
    renamed = carry.select(*[F.col(k).alias(f"_c_{k}") for k in on], *cols)
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in on])
    return df.join(F.broadcast(renamed), cond, "left").drop(*[f"_c_{k}" for k in on])


def with_lag(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], cols: dict[str, str],
    split: bool | None = None,
) -> DataFrame:
    """Add ``new = previous row's source`` within each group, for ``{new: source}``."""
    keys = list(keys)
    if split is None:
        split = needs_split(df, keys)
    if not split:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({new: F.lag(src).over(w) for new, src in cols.items()})
    parts = _range_slices(df, keys, order)
    unordered = Window.partitionBy(*keys, _PART)
    local = unordered.orderBy(*order)
    out = parts.withColumns(
        {new: F.lag(src).over(local) for new, src in cols.items()}
        | {"_rn": F.row_number().over(local)}
    )
    tails = (
        parts.withColumns({"_rn": F.row_number().over(local), "_n": F.count(F.lit(1)).over(unordered)})
        .where("_rn = _n")
        .select(*keys, _PART, F.struct(*[F.col(s).alias(n) for n, s in cols.items()]).alias("_tail"))
    )
    across = Window.partitionBy(*keys).orderBy(_PART)
    carry = (
        tails.withColumn("_next", F.lead(_PART).over(across))
        .where(F.col("_next").isNotNull())
        .select(*keys, F.col("_next").alias(_PART), "_tail")
    )
    out = _join_carry(out, carry, keys, ["_tail"])
    return out.withColumns(
        {n: F.when(F.col("_rn") == 1, F.col(f"_tail.{n}")).otherwise(F.col(n)) for n in cols}
    ).drop("_rn", "_tail", _PART)


def with_running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], cols: dict[str, str | Column],
    split: bool | None = None, totals: dict[str, str] | None = None,
) -> DataFrame:
    """Add inclusive running sums ``{new: source}`` in ``order`` within each group.

    ``totals`` adds ``{new: running sum's name}``: the same sum over the whole group.
    """
    keys, totals = list(keys), totals or {}
    if split is None:
        split = needs_split(df, keys)
    rows_so_far = (Window.unboundedPreceding, 0)
    if keys and not split:
        whole = Window.partitionBy(*keys)
        ordered = whole.orderBy(*order).rowsBetween(*rows_so_far)
        return df.withColumns(
            {new: F.sum(src).over(ordered) for new, src in cols.items()}
            | {t: F.sum(cols[new]).over(whole) for t, new in totals.items()}
        )
    parts = _range_slices(df, keys, order)
    whole = Window.partitionBy(*keys, _PART)
    ordered = whole.orderBy(*order).rowsBetween(*rows_so_far)
    out = parts.withColumns(
        {new: F.sum(src).over(ordered) for new, src in cols.items()}
        | {t: F.sum(cols[new]).over(whole) for t, new in totals.items()}
    )
    across = Window.partitionBy(*keys)
    before = across.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        parts.groupBy(*keys, _PART)
        .agg(*[F.sum(src).alias(f"_s_{new}") for new, src in cols.items()])
        .withColumns(
            {f"_o_{new}": F.sum(f"_s_{new}").over(before) for new in cols}
            | {f"_t_{t}": F.sum(f"_s_{new}").over(across) for t, new in totals.items()}
            | {"_slices": F.count(F.lit(1)).over(across)}
        )
        .where("_slices > 1")
    )
    out = _join_carry(out, carry, keys, [f"_o_{new}" for new in cols] + [f"_t_{t}" for t in totals])
    return out.withColumns(
        {n: F.col(n) + F.coalesce(F.col(f"_o_{n}"), F.lit(0)) for n in cols}
        | {t: F.coalesce(F.col(f"_t_{t}"), F.col(t)) for t in totals}
    ).drop(_PART, *[f"_o_{n}" for n in cols], *[f"_t_{t}" for t in totals])


def with_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "position",
    split: bool | None = None, size: str | None = None,
) -> DataFrame:
    """Number rows 0..n-1 in ``order`` within each group (the whole table if no keys).

    ``size`` names a further column with the number of rows of the group.
    """
    numbered = with_running_sum(
        df.withColumn("_one", F.lit(1).cast("bigint")), keys, order, {name: "_one"}, split,
        totals={size: name} if size else None,
    )
    return numbered.withColumn(name, F.col(name) - 1).drop("_one")


def with_last_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], cols: dict[str, str],
    split: bool | None = None,
) -> DataFrame:
    """Add ``new = latest non-null source`` at or before each row of its group."""
    keys = list(keys)
    if split is None:
        split = needs_split(df, keys)
    rows_so_far = (Window.unboundedPreceding, 0)
    if not split:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*rows_so_far)
        return df.withColumns({n: F.last(s, ignorenulls=True).over(w) for n, s in cols.items()})
    parts = _range_slices(df, keys, order)
    unordered = Window.partitionBy(*keys, _PART)
    ordered = unordered.orderBy(*order)
    local = ordered.rowsBetween(*rows_so_far)
    out = parts.withColumns({n: F.last(s, ignorenulls=True).over(local) for n, s in cols.items()})
    before = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        out.withColumns({"_rn": F.row_number().over(ordered), "_n": F.count(F.lit(1)).over(unordered)})
        .where("_rn = _n")
        .withColumns(
            {f"_k_{n}": F.last(n, ignorenulls=True).over(before) for n in cols}
            | {"_earlier": F.count(F.lit(1)).over(before)}
        )
        .where("_earlier > 0")
    )
    out = _join_carry(out, carry, keys, [f"_k_{n}" for n in cols])
    return out.withColumns(
        {n: F.coalesce(F.col(n), F.col(f"_k_{n}")) for n in cols}
    ).drop(_PART, *[f"_k_{n}" for n in cols])


def group_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float],
    split: bool | None = None,
) -> DataFrame:
    """Exact linearly interpolated percentiles of ``value`` per group.

    Spark's ``percentile`` keeps a group's distinct values in memory. For groups
    too large for that, equal values are counted first and the two neighbouring
    order statistics are picked by their running count.
    """
    keys = list(keys)
    if split is None:
        split = needs_split(df, keys)
    if not split:
        return df.groupBy(*keys).agg(
            *[F.percentile(value, p).alias(n) for n, p in probs.items()]
        )
    # a null value counts zero times but keeps its group
    freq = df.groupBy(*keys, value).agg(F.count(value).alias("_c"))
    ranked = with_running_sum(freq, keys, [F.col(value)], {"_hi": "_c"}, True, totals={"_n": "_hi"})
    aggs = []
    for i, p in enumerate(probs.values()):
        at = F.lit(p) * (F.col("_n") - 1)
        for tag, rank in (("lo", F.floor(at)), ("up", F.ceil(at))):
            here = (F.col("_hi") - F.col("_c") <= rank) & (rank < F.col("_hi"))
            aggs.append(F.max(F.when(here, F.col(value))).alias(f"_{tag}{i}"))
    picked = ranked.groupBy(*keys).agg(F.first("_n").alias("_n"), *aggs)
    cols = []
    for i, (name, p) in enumerate(probs.items()):
        at = F.lit(p) * (F.col("_n") - 1)
        frac = at - F.floor(at)
        cols.append((F.col(f"_lo{i}") * (1 - frac) + F.col(f"_up{i}") * frac).alias(name))
    return picked.select(*keys, *cols)


def lookup_join(facts: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``facts`` to ``dim`` (one row per key) without piling a hot key on one task.

    A small ``dim`` is broadcast: by the optimizer's estimate, or, when that is over
    the limit, by the counted size of the written ``dim`` (estimates of aggregates
    are far too high). Otherwise rows of hot keys are joined to a
    broadcast of just those keys' ``dim`` rows (at most ``MAX_HOT_KEYS``), and all
    other rows go through the ordinary shuffle join. Rows with a null key match
    nothing and take no part in it. ``how`` is any join that keeps rows of
    ``facts``: inner, left, left_semi or left_anti.
    """
    on = list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type for a lookup: {how}")
    limit = _setting(facts.sparkSession, "broadcastBytes", BROADCAST_BYTES)
    if output_bytes(dim) <= limit:
        return facts.join(F.broadcast(dim), on, how)
    dim = checkpointed(dim)
    if dim.count() * len(dim.columns) * CELL_BYTES <= limit:
        return facts.join(F.broadcast(dim), on, how)
    if not is_small_input(facts):
        facts = checkpointed(facts)  # counted, split and joined from here on
    absent = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    keyed = facts.where(~absent)
    hot = hot_keys(keyed, on)
    joined = keyed.join(dim, on, how) if hot is None else _hot_and_cold(keyed, dim, hot, on, how)
    if how in ("inner", "left_semi"):
        return joined
    return joined.unionByName(facts.where(absent), allowMissingColumns=True)


def _hot_and_cold(facts: DataFrame, dim: DataFrame, hot: DataFrame, on: list[str], how: str) -> DataFrame:
    hot_dim = dim.join(F.broadcast(hot), on, "left_semi")
    hot_facts = facts.join(F.broadcast(hot), on, "left_semi")
    cold_facts = facts.join(F.broadcast(hot), on, "left_anti")
    return hot_facts.join(F.broadcast(hot_dim), on, how).unionByName(cold_facts.join(dim, on, how))


def first_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows in ``order``; ``n`` may be as large as the table.

    ``orderBy().limit(n)`` ends in a single task, so large ``n`` numbers the rows
    by range slices and filters instead.
    """
    if n <= 10_000:
        return df.orderBy(*order).limit(n)
    return with_position(df, [], order, "_nth").where(F.col("_nth") < n).drop("_nth")


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group with their 1-based rank.

    Spark cuts each map-side partition to ``k`` rows per key before the shuffle,
    so a hot key moves at most ``k`` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)

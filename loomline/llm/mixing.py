"""Mixing sources to target weights by blocks of tokens.

The documents of a source are laid end to end in a pseudorandom order and cut into blocks of
``BLOCK`` tokens. The mix is a row of slots, one block each, and ``SHARD`` slots make an
output shard. Which source fills a slot is drawn at random: a pseudorandom permutation of all
slots deals each source its exact number of them, so the source counts of a shard are a
multinomial draw, conditioned on the totals that the targets fix. The slots of a source run
through its blocks in full passes, then through a prefix of a pseudorandom permutation of
the block indices; the last slot is cut where the source meets its target. Slots and blocks
are joined on (source, block index).

Permutations are "swap or not" shuffles: an exact permutation of ``0 .. n - 1`` for any ``n``,
computed for each index alone, with no state and no cycle walking. Reruns agree.

All work is DataFrame expressions. A hot source is no hot key: running sums are taken in
``BUCKETS`` parts of each source and joined on; slots and blocks are keyed by block index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.text import WORD, checkpointed, small_partitions

BLOCK = 64
SHARD = 1 << 14
# Parts that each source's running sum is taken in.
BUCKETS = 1024
# No document is taken more often than this.
MAX_PASSES = 3
ROUNDS = 24
SLOTS_PER_ROW = 1 << 12


def permuted(index: Column, size: Column, key: Column | str, rounds: int = ROUNDS) -> Column:
    """Pseudorandom permutation of ``0 .. size - 1`` applied to ``index``, different for each ``key``."""
    key = F.lit(key) if isinstance(key, str) else key
    size = F.greatest(size, F.lit(1))

    def step(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(key, r), size) - x, size)
        swap = F.xxhash64(key, r, F.greatest(x, partner)).bitwiseAND(F.lit(1).cast("long")) == 1
        return F.when(swap, partner).otherwise(x)

    # bound once: the accumulator is a variable, so its uses do not repeat the whole expression
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index.cast("long"), step)


def sizes(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(doc_id, source, size)``: words of every text, 0 for null."""
    count = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(f"({WORD})")), F.lit(0))
    return small_partitions(docs).select("doc_id", "source", count.cast("long").alias("size"))


def cyclic_weights(sources: DataFrame, weights: tuple[float, ...] = (1, 2, 3)) -> DataFrame:
    """``sources`` with ``weight``: the given weights repeat over sources by code point, null last."""
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    values = F.array(*[F.lit(float(w)) for w in weights])
    return sources.withColumn("weight", F.element_at(values, (at % len(weights) + 1).cast("int")))


def with_targets(sources: DataFrame, cap: float = MAX_PASSES) -> DataFrame:
    """Add ``target``: shares of all sizes by weight, none above ``cap`` times the source's size.

    What a capped source leaves is shared again by weight. With sources ordered by size per
    weight, the smallest ratio meets its cap first, so the capped ones are a prefix: source i
    is capped when its weight's share of what the earlier ones leave exceeds its cap.
    """
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    share = F.col("_left") / F.col("_weight_left")
    out = sources.withColumns({"_left": left, "_weight_left": weight_left})
    out = out.withColumn("_capped", F.col("weight") * share >= cap * F.col("source_size"))
    # the first source that is not capped fixes the share of all that follow
    first = F.first(F.when(~F.col("_capped"), share), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.when(F.col("_capped"), cap * F.col("source_size")).otherwise(F.col("weight") * first)
    return out.withColumn("target", target.cast("double")).drop("_left", "_weight_left", "_capped")


def _source_key() -> Column:
    """The source as a joinable key: null differs from every text."""
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))


def plan(sized: DataFrame, weights: DataFrame | None = None, block: int = BLOCK, shard: int = SHARD) -> dict[str, DataFrame]:
    """The mix of ``(doc_id, source, size)``.

    ``sources``: size, target, blocks and slots of each source. ``slots``: one row per slot
    ``(shard, slot, key, block, words)`` with the number of words it takes of the block.
    ``documents``: where each document lies in its source, ``(key, begin, end)``.
    ``weights`` has ``(source, weight)``; by default 1, 2, 3 repeat.
    """
    sized = checkpointed(sized.withColumns({"key": _source_key(), "bucket": F.pmod(F.xxhash64("doc_id", F.lit("order")), F.lit(BUCKETS))}))
    parts = checkpointed(sized.groupBy("key", "bucket").agg(F.first("source").alias("source"), F.sum("size").alias("words")))
    by_source = parts.groupBy("key").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    if weights is None:
        weighed = cyclic_weights(by_source)
    else:
        named = weights.select(_source_key().alias("key"), F.col("weight").cast("double"))
        weighed = by_source.join(named, "key")
    every = Window.orderBy("key")
    sources = with_targets(weighed).withColumn("goal", F.round("target").cast("long"))
    sources = sources.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("goal") / F.col("source_size"))).otherwise(0).cast("long"))
    sources = sources.withColumn("rest", F.col("goal") - F.col("passes") * F.col("source_size"))
    whole = F.ceil(F.col("source_size") / block)
    sources = sources.withColumns({"blocks": whole, "slots": F.col("passes") * whole + F.ceil(F.col("rest") / block)})
    sources = checkpointed(sources.withColumn("first_slot", F.sum("slots").over(every) - F.col("slots")))

    # blocks: running sums inside each part of a source, carried on from the parts before
    inside = Window.partitionBy("key", "bucket").orderBy(F.xxhash64("doc_id"), "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    carried = parts.withColumn(
        "carry", F.sum("words").over(Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")
    ).select("key", "bucket", "carry")
    placed = sized.withColumn("stop", F.sum("size").over(inside)).join(carried, ["key", "bucket"])
    documents = placed.withColumn("end", F.col("carry") + F.col("stop")).withColumn("begin", F.col("end") - F.col("size"))

    total = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    rows = sources.where("slots > 0").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / SLOTS_PER_ROW)))
    )
    cores = sized.sparkSession.sparkContext.defaultParallelism
    rows = rows.repartition(4 * cores, "key", "chunk")
    low = F.col("chunk") * SLOTS_PER_ROW
    high = F.least(low + SLOTS_PER_ROW, F.col("slots")) - 1
    slot = rows.withColumn("r", F.explode(F.sequence(low, high)))
    full = F.col("r") < F.col("passes") * F.col("blocks")
    in_rest = F.col("r") - F.col("passes") * F.col("blocks")
    tail_free = F.floor(F.col("source_size") / block)  # blocks that are not cut short
    index = F.when(full, F.pmod("r", F.col("blocks"))).otherwise(in_rest)
    # a pass visits whole blocks in pseudorandom order and a short last block at its end
    turn = F.when(full, F.floor(F.col("r") / F.col("blocks"))).otherwise(F.col("passes"))
    mapped = F.when(index < tail_free, permuted(index, tail_free, F.concat_ws("#", "key", turn.cast("string")))).otherwise(index)
    words = F.when(
        full, F.least(F.lit(block), F.col("source_size") - mapped * block)
    ).otherwise(F.least(F.lit(block), F.col("rest") - in_rest * block))
    position = permuted(F.col("first_slot") + F.col("r"), F.lit(max(total, 1)).cast("long"), "slots")
    slots = slot.select(
        F.floor(position / shard).alias("shard"), F.pmod(position, F.lit(shard)).alias("slot"), "key",
        mapped.alias("block"), words.cast("long").alias("words"),
    )
    return {"sources": sources, "slots": slots, "documents": documents}


def taken(docs: DataFrame, weights: DataFrame | None = None, text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)``: words of each document in the mix.

    Null and empty texts have size 0 and are taken 0 times; a null source is a source of its
    own, last in order. Rows are placed one by one, so repeated rows count each. An empty
    table gives an empty result; sources without a word have target 0.
    """
    mix = plan(sizes(docs, text_col), weights, block)
    # how often each block is taken whole, and up to which of its words once more
    use = checkpointed(
        mix["slots"].groupBy("key", "block").agg(F.count(F.lit(1)).alias("times"), F.min("words").alias("least"), F.max("words").alias("most"))
    )
    documents = checkpointed(mix["documents"])
    placed = documents.where("size > 0").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("end") - 1) / block)))
    )
    share = placed.join(use, ["key", "block"])
    start, stop = F.greatest(F.col("begin") - F.col("block") * block, F.lit(0)), F.least(F.col("end") - F.col("block") * block, F.lit(block))
    overlap = lambda upto: F.greatest(F.least(stop, upto) - start, F.lit(0))
    words = (F.col("times") - 1) * overlap(F.col("most")) + overlap(F.col("least"))
    got = share.groupBy("key", "begin", "end").agg(F.sum(words).alias("taken"))
    targets = mix["sources"].select("key", "source_size", "target")
    return (
        documents.join(got, ["key", "begin", "end"], "left").join(targets, "key")
        .select("doc_id", "source", "size", "source_size", "target",
                F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0).cast("long").alias("taken"))
    )

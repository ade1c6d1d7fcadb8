"""Adapters from the bundled test tables to the shapes the operators expect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators.sessions import REFERRERS
from loomline.session import tune

# Fixed values.
EVENT_TYPE_MAP = {
    "view": "page_view",
    "click": "click",
    "signup": "add_to_cart",
    "error": "checkout",
    "purchase": "conversion",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def clickstream(spark: SparkSession, sf_dir: str, types: Sequence[str] | None = None) -> DataFrame:
    """The clickstream, or only its events of some types: that filter reaches the parquet scan."""
    events = table(spark, sf_dir, "events")
    if types is not None:
        stored = [raw for raw, name in EVENT_TYPE_MAP.items() if name in types]
        events = events.where(F.col("event_type").isin(stored))
    return clickstream_from(events)


def clickstream_from(events: DataFrame) -> DataFrame:
    """Events as a clickstream: three-day sessions per user, nullable identifiers."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    ev = events.withColumn("k", k)
    event_type = F.coalesce(*[F.when(F.col("event_type") == a, b) for a, b in EVENT_TYPE_MAP.items()])
    days = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    known = [F.when(F.col("k") % 7 == i, r) for i, r in enumerate(REFERRERS)]
    referrer = F.coalesce(*known, F.when(F.col("event_id") % 2 == 0, "bing"))  # one outside the vocabulary, some null
    return ev.select(
        "event_id",
        F.col("ts").alias("timestamp"),
        (F.col("user_id") * 1000 + F.floor(days / 3)).alias("session_id"),
        F.when(F.col("k") % 3 != 0, F.col("user_id")).alias("user_id"),
        F.concat(
            F.lit("fp_"), F.substring(F.md5((F.col("user_id") % 100).cast("string").cast("binary")), 1, 8)
        ).alias("device_fingerprint"),
        F.when(F.col("k") % 11 != 0, F.col("user_id") % 50).alias("ip_bucket"),
        event_type.alias("event_type"),
        referrer.alias("referrer"),
        "value",
        F.col("user_id").alias("true_user_id"),
    )


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as user-item interactions, with a full tuple to break recency ties."""
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
    return joined.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("weight"),
        "o_orderdate", "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice",
    )


RECENCY = ["o_orderdate", "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "weight"]


def offerings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One offering per (part, supplier) with a title, category, price and optional gtin."""
    part = table(spark, sf_dir, "part")
    pairs = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(
        F.count(F.lit(1)).alias("n_lines")
    )
    joined = pairs.join(part, pairs.l_partkey == part.p_partkey, "inner")
    catalog_id = F.col("l_partkey") * 1000000 + F.col("l_suppkey")
    title = F.concat_ws(" ", "p_brand", "p_name", "p_type")
    return joined.select(
        catalog_id.alias("catalog_id"),
        (F.col("l_suppkey") % 6).alias("retailer"),
        F.when(
            F.col("l_suppkey") % 4 != 0, F.md5(F.col("l_partkey").cast("string").cast("binary"))
        ).alias("gtin"),
        F.when(F.col("l_suppkey") % 3 == 0, F.lower(title)).otherwise(
            F.when(F.col("l_suppkey") % 17 != 0, title)
        ).alias("title"),
        F.col("p_type").alias("category"),
        (F.col("p_retailprice") * (1 + (F.col("l_suppkey") % 10) / F.lit(50.0))).alias("list_price"),
        F.col("l_partkey").alias("true_canonical_id"),
        F.col("p_type").alias("true_category_path"),
    )


def housing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a numeric table with two coordinate-like columns and a target."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_quantity") / 5.0).alias("MedInc"),
        (F.col("l_linenumber") * 7.0).alias("HouseAge"),
        (F.col("l_tax") * 100.0 + 1.0).alias("AveRooms"),
        (F.col("l_discount") * 10.0 + 0.5).alias("AveBedrms"),
        (F.col("l_quantity") * 30.0 + F.col("l_linenumber")).alias("Population"),
        (F.col("l_discount") * 20.0 + 1.0).alias("AveOccup"),
        (F.lit(32.5) + (F.col("l_partkey") % 1000) / 100.0).alias("Latitude"),
        (F.lit(-124.0) + (F.col("l_suppkey") % 1000) / 100.0).alias("Longitude"),
        (F.col("l_quantity") * (1.0 - F.col("l_discount")) / 10.0 + F.col("l_extendedprice") / 1000000.0).alias("target"),
    )


def graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a deterministic score in [0, 1) that leans on the label, and two predictions."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    joined = table(spark, sf_dir, "labels").join(docs, "doc_id")
    noise = F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 2), 16, 10).cast("int")
    score = (noise + 64 * F.col("quality")) / F.lit(320.0)
    three = F.when(F.col("n_chars") < 500, 0).when(F.col("n_chars") < 2000, 1).otherwise(2)
    return joined.select(
        "doc_id", "lang", "n_chars", "quality", "toxic", score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
        three.alias("size_class"), (noise % 3).alias("size_guess"),
    )

"""Registered queries of the operators: each reads whole tables and returns its full result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm import (
    centroids, decontaminate, language, mixing, packing, quality, secret_scan, simhash, spelling, substrings, toxicity, url_templates, wrappers,
)
from loomline.llm import oracles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(fold: int, parts: int):
    """Whether crc32 of the id as text leaves the remainder ``fold``."""
    return (F.crc32(F.col("doc_id").cast("string")) % parts) == fold


@query
def op9_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-copy component of every document."""
    found = simhash.near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op6_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; rows with crc32 mod 3 of one teach nothing."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out(1, 3))
    model = toxicity.train(docs.where("not held_out"), table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, ["doc_id", "held_out"])
    return scored.select(
        "doc_id", "held_out", F.col("_score").alias("score"), F.when(F.col("_score") >= toxicity.LIMIT, 1).otherwise(0).alias("predicted")
    )


@query
def op8_seeded_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test items that leaked into documents, with the aligned stretch of words."""
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.round("score", 6).alias("score"), "start", "end")


@query
def op7_block_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    mixed = mixing.taken(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op5_forest_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every finding that the forest takes for a secret, with its place in the document."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.where(F.col("score") >= secret_scan.LIMIT).select(
        "doc_id", "position", F.sha2("value", 256).alias("secret_sha256"), F.length("value").alias("length"),
        F.round("score", 6).alias("score"),
    )


@query
def op10_mcd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document, the base rules and the outlier verdict."""
    found = quality.judged(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


#: Rules of the registered query: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


@query
def op1_template_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page: the longest rule's, else the template tree's."""
    found = url_templates.judged(table(spark, sf_dir, "pages"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "template", F.round("purity", 6).alias("purity"))


@query
def op3_anchor_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeated passages of 20 words cover, and what is left."""
    found = substrings.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op2_gru_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; rows with crc32 mod 4 of two teach nothing."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out(2, 4))
    net = language.train(docs.where("not held_out").select("doc_id", "text", "lang"))
    found = language.identify(docs, net, ["doc_id", "held_out"])
    return found.withColumnRenamed("lang_score", "score")


@query
def op4_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return wrappers.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


@query
def op11_chunk_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its usual form, the root of its forms and its near words."""
    found = spelling.variants(table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query
def op12_va_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and exact distance of every vector after ten rounds, with inertias and centroid digests."""
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


@query
def op13_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of at most 2048 tokens."""
    import public_tokenizers

    found = packing.packed(table(spark, sf_dir, "documents"), str(public_tokenizers.path(packing.TOKENIZER)))
    return found.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


SQL["op11_chunk_variants"] = oracles.SPELLING
SQL["op12_va_clusters"] = oracles.CENTROIDS

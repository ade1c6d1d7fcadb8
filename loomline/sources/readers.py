"""Readers for training folders, delimited files, warehouse queries and feature views."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.operators.asof import FeatureView
from loomline.operators.groups import with_position

# Fixed values.
DATA_SUFFIXES = [".csv", ".parquet"]
PREFERRED_STEM = "training"


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Sorted entry names of a folder on whatever filesystem its path names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path))


def read_file(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One parquet or headed CSV dataset. Give CSV a schema to avoid the inference pass."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if path.endswith(".parquet"):
        return reader.parquet(path)
    return reader.csv(path, header=True, inferSchema=schema is None)


def read_training(
    spark: SparkSession, folder: str, schema: T.StructType | str | None = None, prefer: bool = True,
) -> DataFrame:
    """The folder's data file: ``training.*`` if present, else the first by name."""
    names = [n for n in list_names(spark, folder) if n.endswith(tuple(DATA_SUFFIXES))]
    if not names:
        raise FileNotFoundError(f"no .csv or .parquet found in {folder}")
    preferred = [n for n in names if prefer and n.rsplit(".", 1)[0] == PREFERRED_STEM]
    return read_file(spark, f"{folder}/{(preferred or names)[0]}", schema)


def read_delimited(
    spark: SparkSession, path: str, columns: Sequence[tuple[str, str]], sep: str = ","
) -> DataFrame:
    """A headerless delimited file with given (name, type) columns."""
    schema = ", ".join(f"`{n}` {t}" for n, t in columns)
    return spark.read.schema(schema).option("sep", sep).csv(path, header=False)


def query_result(
    spark: SparkSession, sql: str, sources: dict[str, DataFrame] | None = None,
    as_of: datetime | None = None, ingested_at: str | None = None,
) -> DataFrame:
    """Run SQL over named sources, seen as they were at ``as_of``.

    With ``as_of`` each source is first cut to rows whose ``ingested_at`` column is
    not later, so the anchor really decides what the query can see.
    """
    for name, df in (sources or {}).items():
        if as_of is not None:
            if ingested_at is None:
                raise ValueError("as_of needs the name of the ingest time column")
            df = df.where(F.col(ingested_at) <= F.lit(as_of).cast(df.schema[ingested_at].dataType))
        df.createOrReplaceTempView(name)
    result = spark.sql(sql)
    for name in sources or {}:  # the analysed query holds them already
        spark.catalog.dropTempView(name)
    return result


def read_warehouse(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A query over JDBC. Pass ``partitionColumn`` and bounds to read it in parallel."""
    reader = spark.read.format("jdbc").option("url", url)
    for key, value in options.items():
        reader = reader.option(key, value)
    if "partitionColumn" in options:
        return reader.option("dbtable", f"({query}) q").load()
    return reader.option("query", query).load()


def read_feature_view(
    spark: SparkSession, path: str, name: str, keys: Sequence[str], timestamp_col: str,
    features: Sequence[str], ttl: timedelta | None = timedelta(days=365), feature_type: str = "float",
) -> FeatureView:
    """A feature view over parquet, its features cast to the declared type."""
    raw = spark.read.parquet(path)
    typed = raw.select(
        *[F.col(k).cast("bigint").alias(k) for k in keys], F.col(timestamp_col),
        *[F.col(f).cast(feature_type).alias(f) for f in features],
    )
    return FeatureView(name, tuple(keys), timestamp_col, tuple(features), typed, ttl)


def read_entities(
    spark: SparkSession, path: str, keys: Sequence[str], timestamp_col: str = "event_timestamp",
    label: str = "target",
) -> DataFrame:
    return spark.read.parquet(path).select(*keys, timestamp_col, label)


def read_observed_and_truth(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The observed table and its ground truth, kept apart."""
    return (
        spark.read.parquet(f"{folder}/training.parquet"),
        spark.read.parquet(f"{folder}/ground_truth.parquet"),
    )


def query_inputs(spark: SparkSession, queries: str | Sequence[str] | DataFrame) -> DataFrame:
    """Search input as (query_id, query_text): one text, a list of texts, or a frame with
    column ``query`` or ``text`` (and its own ``query_id``, or else the rows are numbered by
    text: equal texts keep a query each)."""
    if isinstance(queries, DataFrame):
        for c in ("query", "text"):
            if c in queries.columns:
                text = F.col(c).cast("string")
                if "query_id" in queries.columns:
                    return queries.select("query_id", text.alias("query_text"))
                return with_position(
                    queries.select(text.alias("query_text")), [], [F.col("query_text")], "query_id"
                ).select("query_id", "query_text")
        raise ValueError("queries need a column named query or text")
    texts = [queries] if isinstance(queries, str) else list(queries)
    return spark.createDataFrame(list(enumerate(texts)), "query_id bigint, query_text string")

"""Incremental latest features per entity, and session counts over an event stream."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomline.operators.asof import FeatureView, latest_rows
from loomline.sources.readers import list_names


# Folder below the online table for rows after a run's cutoff; readers of the table skip it.
HELD = "_held"


def _append_latest(view: FeatureView, path: str, until: datetime | None) -> Callable[[DataFrame, int], None]:
    """Write a micro-batch's newest row per entity under its batch id.

    A replayed batch overwrites its own folder, and readers take the newest row
    over all batches, so neither replays nor late rows can undo a newer value.
    Rows after ``until`` are held: a later run takes them in.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        due = batch
        if until is not None:
            after = _after(batch, view, until)
            due = batch.where(~after)
            batch.where(after).write.mode("overwrite").parquet(f"{path}/{HELD}/batch_id={batch_id}")
        latest_rows(replace(view, source=due)).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def _after(rows: DataFrame, view: FeatureView, until: datetime) -> Column:
    kind = rows.schema[view.timestamp_col].dataType
    return F.coalesce(F.col(view.timestamp_col) > F.lit(until).cast(kind), F.lit(False))


def _release(spark: SparkSession, view: FeatureView, path: str, until: datetime | None) -> None:
    """Take held rows that are due now into the table. Taking a row in twice changes nothing."""
    held = f"{path}/{HELD}"
    if not list_names(spark, held):
        return
    rows = spark.read.parquet(held).drop("batch_id")
    due = rows if until is None else rows.where(~_after(rows, view, until))
    seconds = 2**40 if until is None else int(until.timestamp())
    latest_rows(replace(view, source=due)).write.mode("overwrite").parquet(f"{path}/batch_id={-2 - seconds}")


def materialize_stream(
    stream: DataFrame, view: FeatureView, path: str, checkpoint: str, until: datetime | None = None,
) -> StreamingQuery:
    """Start a run that folds all feature rows now available into the online table.

    Rows after ``until`` are kept aside and taken in by the first later run whose own
    ``until`` they meet. The next run with the same checkpoint reads only new input.
    """
    _release(stream.sparkSession, view, path, until)
    return (
        stream.writeStream.foreachBatch(_append_latest(view, path, until))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_online(spark: SparkSession, path: str, view: FeatureView) -> DataFrame:
    """The newest row per entity over all materialized batches."""
    batches = spark.read.parquet(path)
    return latest_rows(replace(view, source=batches))


def compact(spark: SparkSession, path: str, view: FeatureView, new_path: str) -> None:
    """Fold all batches into one in a new folder, for readers to switch to."""
    read_online(spark, path, view).write.mode("overwrite").parquet(f"{new_path}/batch_id=-1")


_COUNTS = ["n_page_views", "n_clicks", "n_events"]


def session_totals(events: DataFrame) -> DataFrame:
    """Event counts and the conversion flag per session of a table or micro-batch."""
    return events.groupBy("session_id").agg(
        F.count_if(F.col("event_type") == "page_view").alias("n_page_views"),
        F.count_if(F.col("event_type") == "click").alias("n_clicks"),
        F.count(F.lit(1)).alias("n_events"),
        F.max((F.col("event_type") == "conversion").cast("int")).alias("session_converted"),
    )


def upsert_sessions(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Add each micro-batch's part of the session totals; ``read_sessions`` sums them.

    Totals are sums, so no state is held between batches and an event of any lateness
    counts. A replayed batch overwrites its own part.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        session_totals(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Totals per session over all micro-batches."""
    return _summed(spark.read.parquet(path))


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("session_id").agg(
        *[F.sum(c).alias(c) for c in _COUNTS], F.max("session_converted").alias("session_converted")
    )


def compact_sessions(spark: SparkSession, path: str, new_path: str) -> None:
    """Fold all parts into one in a new folder, for readers to switch to."""
    read_sessions(spark, path).write.mode("overwrite").parquet(f"{new_path}/batch_id=-1")

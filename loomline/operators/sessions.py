"""Per-session features from a clickstream.

Only events before the decision (page views and clicks) enter the features; the
label comes from the whole session. Input columns: ``event_id, timestamp,
session_id, user_id, device_fingerprint, ip_bucket, event_type, referrer``.

Everything per session comes from one ordered pass (previous event within the
session) followed by one aggregation on the same key, so the events are
shuffled once. Groups too large for a task take the split forms of ``groups``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions import scalar as S
from loomline.operators.groups import (
    group_percentiles,
    lookup_join,
    needs_split,
    with_lag,
    with_last_known,
)

# Fixed values.
PRE_DECISION_TYPES = ["page_view", "click"]
REFERRERS = ["google", "direct", "facebook", "email", "affiliate", "organic"]
RAPID_GAP_SECONDS = 5.0
DEVICE_BUCKETS = [16, 32, 64]
GAP_QUANTILES = {"p25_gap_s": 0.25, "median_gap_s": 0.5, "p75_gap_s": 0.75}

KEY = "session_id"


def pre_decision(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type").isin(PRE_DECISION_TYPES))


def _order_key() -> Column:
    return F.struct("timestamp", "event_id")


def _first(value: str) -> Column:
    """First non-null value in (timestamp, event_id) order."""
    return F.min_by(F.col(value), F.when(F.col(value).isNotNull(), _order_key()))


def _last(value: str) -> Column:
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), _order_key()))


def with_previous(pre: DataFrame, split: bool | None = None) -> DataFrame:
    """Add the previous event's time and type, and the gap in seconds."""
    lagged = with_lag(
        pre, [KEY], [F.col("timestamp"), F.col("event_id")],
        {"prev_timestamp": "timestamp", "prev_type": "event_type"}, split,
    )
    gap_us = S.micros("timestamp") - S.micros("prev_timestamp")
    return lagged.withColumn("gap_us", gap_us).withColumn("gap_s", F.col("gap_us") / F.lit(1e6))


# --- aggregate expressions, one list per feature family -----------------------------------

def type_count_aggs() -> list[Column]:
    return [
        F.count_if(F.col("event_type") == "page_view").alias("n_page_views"),
        F.count_if(F.col("event_type") == "click").alias("n_clicks"),
    ]


def with_type_ratios(df: DataFrame) -> DataFrame:
    df = df.withColumn("n_pre_events", F.col("n_page_views") + F.col("n_clicks"))
    return df.withColumns({
        "click_ratio": S.safe_ratio("n_clicks", "n_pre_events"),
        "page_view_ratio": S.safe_ratio("n_page_views", "n_pre_events"),
        "log_n_clicks": F.log1p("n_clicks"),
        "log_n_page_views": F.log1p("n_page_views"),
        "log_n_pre_events": F.log1p("n_pre_events"),
    })


def context_aggs() -> list[Column]:
    return [
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        F.count_distinct("referrer").alias("n_referrers"),
        _first("ip_bucket").alias("ip_bucket"),
        F.max(F.col("user_id").isNotNull().cast("int")).alias("has_user_id"),
    ]


def with_context(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "pre_duration_s": S.seconds_between("first_ts", "last_ts"),
        "hour_of_day": S.hour_of_day("first_ts"),
        "day_of_week": S.day_of_week("first_ts"),
        "is_weekend": S.is_weekend("first_ts"),
        "hour_bucket": S.hour_bucket("first_ts"),
    }).withColumn("log_duration_s", F.log1p("pre_duration_s")).drop("first_ts", "last_ts")


def gap_aggs(with_quantiles: bool = True) -> list[Column]:
    """Gap statistics; sessions with a single event get zeros."""
    zero = F.lit(0.0)
    aggs = [
        F.coalesce(F.max("gap_s"), zero).alias("max_gap_s"),
        F.coalesce(F.min("gap_s"), zero).alias("min_gap_s"),
        F.coalesce(F.stddev_samp("gap_s"), zero).alias("std_gap_s"),
        F.coalesce(F.avg("gap_us") / F.lit(1e6), zero).alias("mean_gap_s"),
        F.count_if(F.col("gap_s") < RAPID_GAP_SECONDS).cast("double").alias("n_rapid_events"),
    ]
    if with_quantiles:
        aggs += [F.coalesce(F.percentile("gap_s", p), zero).alias(n) for n, p in GAP_QUANTILES.items()]
    return aggs


def referrer_aggs(vocabulary: Sequence[str] = REFERRERS) -> list[Column]:
    counts = [F.count_if(F.col("referrer") == r).alias(f"ref_{r}") for r in vocabulary]
    return [*counts, F.count("referrer").alias("_n_ref")]


def with_referrer_ratios(df: DataFrame, vocabulary: Sequence[str] = REFERRERS) -> DataFrame:
    """Shares among all events with a referrer, those outside the vocabulary included."""
    total = F.greatest(F.col("_n_ref"), F.lit(1))
    return df.withColumns({f"ref_{r}_ratio": F.col(f"ref_{r}") / total for r in vocabulary}).drop("_n_ref")


def referrer_sequence_aggs() -> list[Column]:
    return [_first("referrer").alias("first_referrer"), _last("referrer").alias("last_referrer")]


def with_referrer_codes(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "first_referrer_enc": S.vocabulary_code("first_referrer", REFERRERS).cast("double"),
        "last_referrer_enc": S.vocabulary_code("last_referrer", REFERRERS).cast("double"),
        "referrer_changed": S.changed_flag("first_referrer", "last_referrer"),
    }).drop("first_referrer", "last_referrer")


def device_aggs() -> list[Column]:
    return [_first("device_fingerprint").alias("device_fp")]


def with_device_buckets(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {f"device_bucket_{n}": S.hash_bucket("device_fp", n) for n in DEVICE_BUCKETS}
    ).drop("device_fp")


def transition_aggs() -> list[Column]:
    prev, cur = F.col("prev_type"), F.col("event_type")
    return [
        F.count_if((prev == "page_view") & (cur == "click")).cast("double").alias("click_after_pageview"),
        F.count_if((prev == "click") & (cur == "page_view")).cast("double").alias("pageview_after_click"),
        (
            F.count_if(prev != cur)
            / F.greatest(F.count_if(prev.isNotNull()), F.lit(1).cast("bigint"))
        ).alias("alternation_rate"),
    ]


def with_ip_frequency(sessions: DataFrame) -> DataFrame:
    """Number of sessions that share the session's ip bucket (0 when it is null)."""
    freq = (
        sessions.where(F.col("ip_bucket").isNotNull())
        .groupBy("ip_bucket")
        .agg(F.count(F.lit(1)).alias("ip_bucket_freq"))
    )
    joined = lookup_join(sessions, freq, ["ip_bucket"], "left")
    return joined.withColumn("ip_bucket_freq", F.coalesce("ip_bucket_freq", F.lit(0).cast("bigint")))


def with_interactions(df: DataFrame) -> DataFrame:
    out = {
        "duration_per_event": S.safe_ratio("pre_duration_s", "n_pre_events"),
        "clicks_per_minute": S.safe_ratio("n_clicks", F.col("pre_duration_s") / F.lit(60.0)),
        "page_views_per_minute": S.safe_ratio("n_page_views", F.col("pre_duration_s") / F.lit(60.0)),
        "click_ratio_x_duration": F.col("click_ratio") * F.col("log_duration_s"),
        "gap_cv": S.safe_ratio("std_gap_s", "mean_gap_s"),
        "gap_iqr": F.col("p75_gap_s") - F.col("p25_gap_s"),
    }
    for r in ("google", "email"):
        if f"ref_{r}_ratio" in df.columns:
            out[f"clicks_x_{r}"] = F.col("n_clicks") * F.col(f"ref_{r}_ratio")
    return df.withColumns(out)


# --- feature tables ------------------------------------------------------------------------

def session_type_counts(events: DataFrame) -> DataFrame:
    return with_type_ratios(pre_decision(events).groupBy(KEY).agg(*type_count_aggs()))


def session_context(events: DataFrame) -> DataFrame:
    return with_context(pre_decision(events).groupBy(KEY).agg(*context_aggs()))


def _gap_table(pre: DataFrame, aggs: list[Column]) -> DataFrame:
    """Aggregate ``aggs`` and the gap statistics per session in one pass when possible."""
    split = needs_split(pre, [KEY])
    lagged = with_previous(pre, split)
    if not split:
        return lagged.groupBy(KEY).agg(*aggs, *gap_aggs())
    quantiles = group_percentiles(lagged.select(KEY, "gap_s"), [KEY], "gap_s", GAP_QUANTILES, split=True)
    table = lagged.groupBy(KEY).agg(*aggs, *gap_aggs(with_quantiles=False))
    return table.join(quantiles, KEY, "left").fillna(0.0, list(GAP_QUANTILES))


def session_gaps(events: DataFrame) -> DataFrame:
    gaps = _gap_table(pre_decision(events).select(KEY, "event_id", "timestamp", "event_type"), [])
    return gaps.withColumns({
        "gap_cv": S.safe_ratio("std_gap_s", "mean_gap_s"),
        "gap_iqr": F.col("p75_gap_s") - F.col("p25_gap_s"),
    })


def session_transitions(events: DataFrame) -> DataFrame:
    pre = pre_decision(events).select(KEY, "event_id", "timestamp", "event_type")
    return with_previous(pre).groupBy(KEY).agg(*transition_aggs())


def fit_referrer_vocabulary(events: DataFrame, max_values: int = 1000) -> list[str]:
    """Distinct referrers of the pre-decision events, to be stored with the model.

    They become columns, so more than ``max_values`` of them is an error rather
    than something to truncate.
    """
    rows = (
        pre_decision(events).where(F.col("referrer").isNotNull())
        .select("referrer").distinct().limit(max_values + 1).collect()
    )
    if len(rows) > max_values:
        raise ValueError(f"more than {max_values} referrers: group rare values first")
    return sorted(r[0] for r in rows)


def session_referrers(events: DataFrame, vocabulary: Sequence[str] = REFERRERS) -> DataFrame:
    counts = pre_decision(events).groupBy(KEY).agg(*referrer_aggs(vocabulary))
    return with_referrer_ratios(counts, vocabulary)


def session_referrer_sequence(events: DataFrame) -> DataFrame:
    return with_referrer_codes(pre_decision(events).groupBy(KEY).agg(*referrer_sequence_aggs()))


def session_device_buckets(events: DataFrame) -> DataFrame:
    return with_device_buckets(pre_decision(events).groupBy(KEY).agg(*device_aggs()))


def session_ip_frequency(events: DataFrame) -> DataFrame:
    firsts = pre_decision(events).groupBy(KEY).agg(_first("ip_bucket").alias("ip_bucket"))
    return with_ip_frequency(firsts)


def session_labels(events: DataFrame, label: Column | None = None) -> DataFrame:
    """One label per session over all its events; by default any conversion."""
    if label is None:
        label = F.max((F.col("event_type") == "conversion").cast("int"))
    return events.groupBy(KEY).agg(label.alias("target"))


def with_session_converted(events: DataFrame) -> DataFrame:
    """Mark every event of a session that contains a conversion."""
    labels = session_labels(events).withColumnRenamed("target", "session_converted")
    return lookup_join(events, labels, [KEY], "left")


def session_features(
    events: DataFrame,
    vocabulary: Sequence[str] = REFERRERS,
    label: Column | None = None,
    null_ip_bucket: int = -1,
    labels: DataFrame | None = None,
) -> DataFrame:
    """All session features (55 with the standard vocabulary) plus ``target``.

    ``labels`` (session_id, target) may be given separately; ``events`` then needs
    only the pre-decision rows, which lets a filtered scan feed the features.
    """
    aggs = [
        *type_count_aggs(), *context_aggs(), *referrer_aggs(vocabulary),
        *device_aggs(), *referrer_sequence_aggs(), *transition_aggs(),
    ]
    df = _gap_table(pre_decision(events), aggs)
    df = with_type_ratios(df)
    df = with_context(df)
    df = with_referrer_ratios(df, vocabulary)
    df = with_device_buckets(df)
    df = with_referrer_codes(df)
    df = with_ip_frequency(df)
    df = df.fillna({"ip_bucket": null_ip_bucket}).fillna(0)
    df = with_interactions(df)
    if labels is None:
        labels = session_labels(events, label)
    return df.join(labels, KEY, "inner")


def last_click_attribution(events: DataFrame) -> DataFrame:
    """For each conversion, the session's latest click before it (nulls when there is none)."""
    click = F.when(
        F.col("event_type") == "click", F.struct(F.col("event_id"), F.col("referrer"))
    )
    marked = events.where(F.col("event_type").isin("click", "conversion")).withColumn("_click", click)
    order = [F.col("timestamp"), F.col("event_id")]
    known = with_last_known(marked, [KEY], order, {"_last": "_click"}).where("event_type = 'conversion'")
    return known.withColumns(
        {"click_event_id": F.col("_last.event_id"), "click_referrer": F.col("_last.referrer")}
    ).drop("_click", "_last")

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loomline.operators import sessions

T0 = datetime(2024, 1, 5, 5, 59, 50)  # a Friday
SCHEMA = ("event_id long, timestamp timestamp_ntz, session_id long, user_id long, device_fingerprint string, "
          "ip_bucket long, event_type string, referrer string")


def event(i, s, seconds, kind, ref=None, user=None, ip=None, fp=None):
    return (i, T0 + timedelta(seconds=seconds), s, user, fp, ip, kind, ref)


@pytest.fixture
def events(spark):
    return spark.createDataFrame([
        event(1, 1, 0, "page_view", None, None, None, None),
        event(2, 1, 3, "click", "google", 7, 5, "fp_a"),
        event(3, 1, 3, "page_view", "email", 7, 6, "fp_b"),
        event(4, 1, 13, "click", None, None, 6, "fp_b"),
        event(5, 1, 99, "conversion", "direct", 7, 6, "fp_b"),
        event(6, 2, 10, "page_view", None, None, None, None),  # one event, everything null
        event(7, 3, 20, "checkout", "google", 1, 5, "fp_c"),  # nothing before the decision
        event(8, 4, 30, "click", "partner", None, 5, "fp_d"),  # referrer outside the vocabulary
    ], SCHEMA)


def test_referrer_ratios_count_every_referrer(spark):
    rows = [event(1, 1, 0, "click", "google")] + [event(i, 1, i, "click", "bing") for i in (2, 3, 4)] + [event(5, 1, 9, "click")]
    got = sessions.session_features(spark.createDataFrame(rows, SCHEMA)).first()
    assert got["ref_google_ratio"] == 0.25 and got["ref_email_ratio"] == 0.0


def test_features_of_a_session(events, grouping):
    rows = {r["session_id"]: r.asDict() for r in sessions.session_features(events).collect()}
    assert set(rows) == {1, 2, 4}  # session 3 has no pre-decision event
    one = rows[1]
    assert (one["n_page_views"], one["n_clicks"], one["n_pre_events"], one["target"]) == (2, 2, 4, 1)
    assert (one["ip_bucket"], one["ip_bucket_freq"]) == (5, 2)  # first non-null, shared with session 4
    assert (one["min_gap_s"], one["max_gap_s"], one["median_gap_s"], one["n_rapid_events"]) == (0.0, 10.0, 3.0, 2.0)
    assert (one["p25_gap_s"], one["p75_gap_s"]) == (1.5, 6.5)
    assert (one["click_after_pageview"], one["pageview_after_click"]) == (2.0, 1.0)
    assert one["alternation_rate"] == 1.0
    assert (one["first_referrer_enc"], one["last_referrer_enc"], one["referrer_changed"]) == (0.0, 3.0, 1)
    assert (one["ref_google"], one["ref_email_ratio"], one["n_referrers"]) == (1, 0.5, 2)
    assert (one["hour_of_day"], one["day_of_week"], one["is_weekend"], one["hour_bucket"]) == (5, 4, 0, 0.0)
    assert (one["pre_duration_s"], one["has_user_id"]) == (13.0, 1)


def test_null_rules(events, grouping):
    rows = {r["session_id"]: r.asDict() for r in sessions.session_features(events).collect()}
    two = rows[2]
    assert two["referrer_changed"] == 1  # null against null counts as changed
    assert (two["first_referrer_enc"], two["ip_bucket"], two["ip_bucket_freq"]) == (-1.0, -1, 0)
    assert (two["device_bucket_16"], two["device_bucket_32"], two["device_bucket_64"]) == (-1, -1, -1)
    assert (two["std_gap_s"], two["mean_gap_s"], two["alternation_rate"], two["has_user_id"]) == (0, 0, 0, 0)
    assert rows[4]["first_referrer_enc"] == -1.0
    assert all(v is not None for r in rows.values() for v in r.values())


def test_published_fill_value_is_available(events):
    rows = {r["session_id"]: r["ip_bucket"] for r in sessions.session_features(events, null_ip_bucket=0).collect()}
    assert rows[2] == 0


def test_there_are_55_features(events):
    assert len(sessions.session_features(events).columns) == 55 + 2


def test_vocabulary_is_fitted_and_bounded(events):
    assert sessions.fit_referrer_vocabulary(events) == ["email", "google", "partner"]
    with pytest.raises(ValueError):
        sessions.fit_referrer_vocabulary(events, max_values=2)
    wide = sessions.session_features(events, vocabulary=["partner"])
    assert "clicks_x_google" not in wide.columns
    assert wide.where("session_id = 4").first()["ref_partner_ratio"] == 1.0


def test_label_reaches_every_event(events, grouping):
    marked = sessions.with_session_converted(events)
    assert marked.count() == 8
    assert {r["event_id"] for r in marked.where("session_converted = 1").collect()} == {1, 2, 3, 4, 5}


def test_features_do_not_see_the_decision(events):
    later = events.withColumn(
        "timestamp",
        F.when(F.col("event_type") == "conversion", F.lit(T0 + timedelta(days=3)).cast("timestamp_ntz"))
        .otherwise(F.col("timestamp")),
    )
    key = "session_id"
    a = sessions.session_features(events).orderBy(key).collect()
    b = sessions.session_features(later).orderBy(key).collect()
    assert a == b


def test_results_do_not_depend_on_partitioning(events):
    a = sessions.session_features(events.repartition(1)).orderBy("session_id").collect()
    b = sessions.session_features(events.repartition(7)).orderBy("session_id").collect()
    assert a == b


def test_last_click(events):
    got = sessions.last_click_attribution(events).collect()
    assert [(r["event_id"], r["click_event_id"], r["click_referrer"]) for r in got] == [(5, 4, None)]

from datetime import datetime, timedelta

import pytest

from loomline.operators.asof import (
    FeatureView,
    as_of_join,
    historical_features,
    latest_rows,
    online_features,
    online_lookup,
)
from loomline.sources.readers import read_entities, read_feature_view

D = datetime(2024, 3, 1)


def view(spark, ttl=timedelta(days=2)):
    rows = [
        ("a", D, 1.0), ("a", D + timedelta(days=1), 2.0), ("a", D + timedelta(days=9), 9.0),
        ("b", D + timedelta(days=5), 5.0), ("c", D, None), (None, D, 7.0),
    ]
    src = spark.createDataFrame(rows, "k string, at timestamp_ntz, x double")
    return FeatureView("v", ("k",), "at", ("x",), src, ttl)


@pytest.fixture
def asked(spark):
    return spark.createDataFrame([
        (1, "a", D - timedelta(seconds=1)),  # only future rows
        (2, "a", D),  # same instant
        (3, "a", D + timedelta(days=3)),  # exactly at the limit
        (4, "a", D + timedelta(days=3, microseconds=1)),  # just past it
        (5, "b", D + timedelta(days=4)),
        (6, "zzz", D),  # unknown entity
        (7, "c", D),  # known but null value
        (8, None, D + timedelta(hours=1)),  # null key never matches
        (9, "a", D + timedelta(days=9, hours=1)),
    ], "id int, k string, event_timestamp timestamp_ntz")


def test_as_of(spark, asked, grouping):
    got = {r["id"]: r["x"] for r in as_of_join(asked, view(spark)).collect()}
    assert got == {1: None, 2: 1.0, 3: 2.0, 4: None, 5: None, 6: None, 7: None, 8: None, 9: 9.0}


def test_as_of_without_ttl_and_with_time(spark, asked):
    got = {r["id"]: (r["x"], r["seen"]) for r in as_of_join(asked, view(spark, None), feature_ts="seen").collect()}
    assert got[4] == (2.0, D + timedelta(days=1))
    assert got[7] == (None, D)


def test_no_future_value_is_ever_used(spark, asked):
    rows = as_of_join(asked, view(spark, None), feature_ts="seen").where("seen > event_timestamp")
    assert rows.count() == 0


def test_latest_and_lookup(spark, grouping):
    v = view(spark)
    latest = latest_rows(v)
    assert {r["k"]: r["x"] for r in latest.collect()} == {"a": 9.0, "b": 5.0, "c": None}
    asked = spark.createDataFrame([("a", D + timedelta(days=10)), ("a", D + timedelta(days=30)), ("q", D)], "k string, now timestamp_ntz")
    assert sorted(str(r["x"]) for r in online_lookup(asked, latest, v).collect()) == ["9.0", "9.0", "None"]
    assert sorted(str(r["x"]) for r in online_lookup(asked, latest, v, now="now").collect()) == ["9.0", "None", "None"]


def test_features_by_reference(spark, asked):
    prices = spark.createDataFrame([("a", D, 10, 1), ("a", D + timedelta(days=1), 20, 2)], "k string, at timestamp_ntz, price int, stock int")
    views = [view(spark, None), FeatureView("shop", ("k",), "at", ("price", "stock"), prices)]
    got = historical_features(asked, views, ["v:x", "shop:price"])
    assert got.columns == [*asked.columns, "x", "price"]
    assert {r["id"]: (r["x"], r["price"]) for r in got.where("id in (2, 3, 5)").collect()} == {2: (1.0, 10), 3: (2.0, 20), 5: (None, None)}
    keys = spark.createDataFrame([("a",), ("q",)], "k string")
    now = online_features(keys, views, ["shop:stock"], {"shop": latest_rows(views[1])})
    assert {r["k"]: r["stock"] for r in now.collect()} == {"a": 2, "q": None}
    for bad in ("nowhere:x", "shop:colour"):
        with pytest.raises(ValueError):
            historical_features(asked, views, [bad])


def test_view_and_entities_from_files(spark, tmp_path):
    rows = [(1, D, 0.5, 3.0), (2, D, 0.25, 4.0)]
    spark.createDataFrame(rows, "signal_id int, event_timestamp timestamp, f0 double, f1 double").write.parquet(f"{tmp_path}/f")
    v = read_feature_view(spark, f"{tmp_path}/f", "s", ["signal_id"], "event_timestamp", ["f0", "f1"])
    assert dict(v.source.dtypes) == {"signal_id": "bigint", "event_timestamp": "timestamp", "f0": "float", "f1": "float"}
    assert v.ttl == timedelta(days=365)
    spark.createDataFrame([(1, D + timedelta(days=365), 1)], "signal_id long, event_timestamp timestamp, target int").write.parquet(f"{tmp_path}/l")
    labels = read_entities(spark, f"{tmp_path}/l", ["signal_id"])
    assert [(r["target"], r["f0"], r["f1"]) for r in as_of_join(labels, v).collect()] == [(1, 0.5, 3.0)]


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_many_views_in_one_pass(spark, asked, grouping):
    """Four views with their own time to live and tie-break equal four single passes, in one exchange."""
    first = view(spark)
    again = spark.createDataFrame(
        [("a", D, 1.0, 1), ("a", D, 2.0, 3), ("a", D, 3.0, 2), ("a", D, 9.0, None), ("b", D, 4.0, 1)],
        "k string, at timestamp_ntz, y double, made int",
    )
    views = [
        first, FeatureView("w", ("k",), "at", ("x",), first.source, None),
        FeatureView("t", ("k",), "at", ("y",), again, timedelta(days=4), "made"),
        FeatureView("u", ("k",), "at", ("x",), first.source, timedelta(seconds=1)),
    ]
    refs = ["v:x", "w:x", "t:y", "u:x"]
    both = historical_features(asked, views, refs, full_names=True)
    passes = exchanges(both)  # of the plan before it runs
    want = None
    for v in views:
        one = {r.id: r[v.features[0]] for r in as_of_join(asked, v).collect()}
        want = {i: (*(want[i] if want else ()), x) for i, x in one.items()}
    assert {r.id: (r.v__x, r.w__x, r.t__y, r.u__x) for r in both.collect()} == want
    assert want[2] == (1.0, 1.0, 2.0, 1.0) and want[4] == (None, 2.0, 2.0, None) and want[8] == (None,) * 4
    if grouping == "plain":
        assert passes == 1


def test_views_with_clashing_features_need_full_names(spark, asked):
    views = [view(spark), FeatureView("w", ("k",), "at", ("x",), view(spark).source)]
    with pytest.raises(ValueError, match="several columns"):
        historical_features(asked, views, ["v:x", "w:x"])
    wrong = FeatureView("z", ("id",), "at", ("x",), spark.createDataFrame([(1, D, 1.0)], "id int, at timestamp_ntz, x double"))
    out = historical_features(asked, [view(spark), wrong], ["v:x", "z:x"], full_names=True)
    assert {r.id: r.z__x for r in out.collect()} == {1: None, 2: 1.0} | {i: None for i in range(3, 10)} | {1: None}

import random

import pytest
from pyspark.sql import functions as F

from loomline.operators import groups as G


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds a third of the rows; times repeat; values have nulls."""
    rng = random.Random(7)
    data = []
    for i in range(600):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rng.randrange(40)}")
        data.append((key, rng.randrange(60), i, None if rng.random() < 0.4 else rng.randrange(1000)))
    return data


@pytest.fixture
def frame(spark, rows):
    return spark.createDataFrame(rows, "key string, t int, id int, v int").repartition(5)


def by_group(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        out.setdefault(r[0], []).append(r)
    return out


def order():
    return [F.col("t"), F.col("id")]


def test_lag(frame, rows, grouping):
    got = {r["id"]: r["prev"] for r in G.with_lag(frame, ["key"], order(), {"prev": "id"}).collect()}
    want = {}
    for group in by_group(rows).values():
        for before, row in zip([None, *group], group):
            want[row[2]] = before[2] if before else None
    assert got == want


def test_last_known(frame, rows, grouping):
    got = {r["id"]: r["known"] for r in G.with_last_known(frame, ["key"], order(), {"known": "v"}).collect()}
    want = {}
    for group in by_group(rows).values():
        known = None
        for row in group:
            known = row[3] if row[3] is not None else known
            want[row[2]] = known
    assert got == want


def test_position_and_running_sum(frame, rows, grouping):
    placed = G.with_position(frame, ["key"], order(), "pos")
    summed = G.with_running_sum(placed, ["key"], order(), {"total": F.coalesce("v", F.lit(0))})
    got = {r["id"]: (r["pos"], r["total"]) for r in summed.collect()}
    want = {}
    for group in by_group(rows).values():
        total = 0
        for i, row in enumerate(group):
            total += row[3] or 0
            want[row[2]] = (i, total)
    assert got == want


def test_whole_table_position(frame, rows, grouping):
    got = {r["id"]: r["pos"] for r in G.with_position(frame, [], [F.desc("t"), F.col("id")], "pos").collect()}
    ranked = sorted(rows, key=lambda r: (-r[1], r[2]))
    assert got == {r[2]: i for i, r in enumerate(ranked)}


def test_percentiles(frame, rows, grouping):
    import numpy as np

    got = {r["key"]: (r["p25"], r["p90"]) for r in G.group_percentiles(
        frame.where("key is not null"), ["key"], "v", {"p25": 0.25, "p90": 0.9}).collect()}
    for key, group in by_group(rows).items():
        values = [r[3] for r in group if r[3] is not None]
        if key is not None and values:
            assert got[key] == pytest.approx(tuple(np.percentile(values, [25, 90])))


def test_stored_tables_can_be_released(spark):
    import os

    stored = G.checkpointed(spark.range(5))
    path = G._STORED[-1]
    assert os.path.isdir(path) and stored.count() == 5
    assert G.release(spark) >= 1 and not os.path.exists(path) and G.release(spark) == 0


def test_percentiles_of_a_group_of_nulls(spark, grouping):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0), ("b", None)], "key string, v double")
    got = {r["key"]: r["m"] for r in G.group_percentiles(df, ["key"], "v", {"m": 0.5}).collect()}
    assert got == {"a": None, "b": 1.0}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_of_null_keys_needs_no_shuffle(spark, how):
    """95 % null keys beyond the broadcast limit: right rows, and none of the nulls in the shuffle."""
    facts = spark.range(4000).select(F.when(F.col("id") % 20 == 0, F.col("id") % 7).alias("key"), "id")
    dim = spark.range(5).select(F.col("id").alias("key"), (F.col("id") * 10).alias("d"))
    spark.conf.set("spark.loomline.broadcastBytes", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = G.lookup_join(facts, dim, ["key"], how)
        rows = [r.asDict() for r in got.collect()]
    finally:
        spark.conf.unset("spark.loomline.broadcastBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    key = {i: i % 7 if i % 20 == 0 else None for i in range(4000)}
    want = {"inner": {i for i, k in key.items() if k is not None and k < 5}, "left": set(key)}
    want |= {"left_semi": want["inner"], "left_anti": set(key) - want["inner"]}
    assert len(rows) == len(want[how]) and {r["id"] for r in rows} == want[how]
    if how in ("inner", "left"):
        assert all(r["d"] == (None if key[r["id"]] is None or key[r["id"]] > 4 else 10 * key[r["id"]]) for r in rows)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(key" in plan


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join(spark, frame, rows, grouping, how):
    dim = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("absent", 4)], "key string, d int")
    got = sorted((r["id"], r["d"] if "d" in r else None) for r in
                 [x.asDict() for x in G.lookup_join(frame, dim, ["key"], how).collect()])
    known = {"hot": 1, "k1": 2, "k2": 3}
    if how == "left":
        want = [(r[2], known.get(r[0])) for r in rows]
    elif how == "left_anti":
        want = [(r[2], None) for r in rows if r[0] not in known]
    else:
        want = [(r[2], known[r[0]] if how == "inner" else None) for r in rows if r[0] in known]
    assert got == sorted(want)


def test_hot_keys_are_bounded_and_exact(spark, frame, rows):
    spark.conf.set("spark.loomline.smallInputBytes", "0")
    spark.conf.set("spark.loomline.rowsPerTask", "100")
    try:
        assert [r["key"] for r in G.hot_keys(frame, ["key"]).collect()] == ["hot"]
        assert G.needs_split(frame, ["key"])
        spark.conf.set("spark.loomline.rowsPerTask", "1000")
        assert G.hot_keys(frame, ["key"]) is None
        assert not G.needs_split(frame, ["key"])
    finally:
        spark.conf.unset("spark.loomline.smallInputBytes")
        spark.conf.unset("spark.loomline.rowsPerTask")


def test_first_n_large_and_small(frame, rows):
    assert G.first_n(frame, [F.col("id")], 7).count() == 7
    got = sorted(r["id"] for r in G.first_n(frame, [F.col("id")], 10_001).collect())
    assert got == sorted(r[2] for r in rows)


def test_top_k_limits_before_the_shuffle(frame):
    top = G.top_k(frame, ["key"], [F.desc("t"), F.col("id")], 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert top.groupBy("key").count().agg(F.max("count")).first()[0] == 3

import random

import numpy as np
import pytest
from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import functions as F

from loomline.operators import interactions as I
from loomline.operators import metrics, recommend
from loomline.sources import sinks


def test_required_columns(spark):
    with pytest.raises(ValueError, match="item_id"):
        I.require_columns(spark.range(1).withColumnRenamed("id", "user_id"), ["user_id", "item_id"])


def test_keep_last(spark):
    df = spark.createDataFrame([("u", "i", 1, 5.0), ("u", "i", 3, 2.0), ("u", "i", 2, 9.0), ("v", "i", 1, 1.0)],
                               "user_id string, item_id string, ts int, weight double")
    got = I.keep_last(df, ["user_id", "item_id"], ["ts"])
    assert got.columns == df.columns
    assert sorted(tuple(r) for r in got.collect()) == [("u", "i", 3, 2.0), ("v", "i", 1, 1.0)]


def brute_core(pairs, a, b, passes):
    for _ in range(passes):
        before = len(pairs)
        users = {i: {u for u, j in pairs if j == i} for _, i in pairs}
        pairs = {(u, i) for u, i in pairs if len(users[i]) >= a}
        items = {u: {i for v, i in pairs if v == u} for u, _ in pairs}
        pairs = {(u, i) for u, i in pairs if len(items[u]) >= b}
        if len(pairs) == before:
            break
    return pairs


def test_k_core_runs_to_its_end(spark):
    """A chain that loses one user at each end per pass, far more often than five times."""
    pairs = [(u, i) for u in range(40) for i in (u, u + 1)]
    df = spark.createDataFrame(pairs, "user_id int, item_id int")
    assert I.k_core(df, min_users=2, min_items=2).count() == 0
    ring = [(u, i % 12) for u in range(12) for i in (u, u + 1)] + [(100 + u, i) for u in range(9) for i in (100 + u, 101 + u)]
    core = I.k_core(spark.createDataFrame(ring, "user_id int, item_id int"), min_users=2, min_items=2)
    assert core.count() == 24


@pytest.mark.parametrize("passes", [1, 2, 5])
def test_k_core_needs_several_passes(spark, grouping, passes):
    rng = random.Random(3)
    pairs = {(rng.randrange(30), rng.randrange(30)) for _ in range(150)} | {(0, i) for i in range(30)}
    df = spark.createDataFrame(sorted(pairs), "user_id int, item_id int")
    got = {tuple(r) for r in I.k_core(df, min_users=4, min_items=4, max_passes=passes).collect()}
    assert got == brute_core(pairs, 4, 4, passes)


def test_dense_ids(spark):
    df = spark.createDataFrame([("c",), ("a",), (None,), ("b",), ("a",)], "v string").repartition(3)
    assert sorted(tuple(r) for r in I.dense_ids(df, "v", "idx").collect()) == [("a", 0), ("b", 1), ("c", 2)]
    assert dict(I.dense_ids(df, "v", "idx").dtypes)["idx"] == "int"


def test_leave_k_out(spark, grouping):
    sizes = {1: 1, 2: 2, 3: 3, 4: 8, 5: 13, 6: 60}
    rows = [(u, 10 * u + i) for u, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "user_id int, item_id int")
    got = I.leave_k_out(df)
    held = {r["user_id"]: r["n"] for r in got.groupBy("user_id").agg(F.count_if("is_test").alias("n")).collect()}
    assert held == {1: 0, 2: 0, 3: 1, 4: 2, 5: 3, 6: 12}
    assert sorted(got.repartition(4).collect()) == sorted(I.leave_k_out(df.repartition(5)).collect())


def test_popular_unseen(spark, grouping):
    rng = random.Random(5)
    seen = {(u, rng.randrange(25)) for u in range(12) for _ in range(rng.randrange(1, 20))} | {(0, i) for i in range(25)}
    df = spark.createDataFrame(sorted(seen), "user_id int, item_id int")
    users = spark.createDataFrame([(u,) for u in range(14)], "user_id int")
    got = {}
    for r in recommend.popular_unseen(users, df, 6).collect():
        got.setdefault(r["user_id"], {})[r["rank"]] = r["item_id"]
    counts = {i: len({u for u, j in seen if j == i}) for _, i in seen}
    order = sorted(counts, key=lambda i: (-counts[i], i))
    for u in range(14):
        want = [i for i in order if (u, i) not in seen][:6]
        assert [got.get(u, {})[r] for r in sorted(got.get(u, {}))] == want
    assert 0 not in got  # saw everything


def test_ranking_metrics_against_the_built_in(spark):
    rng = random.Random(11)
    recs = [(u, i, r + 1) for u in range(20) for r, i in enumerate(rng.sample(range(40), 3 if u == 4 else 10))]
    truth = [(u, i) for u in range(22) for i in rng.sample(range(40), 1 + u % 7)]
    rec_df = spark.createDataFrame(recs, "user_idx int, item_idx int, rank int")
    truth_df = spark.createDataFrame(truth, "user_idx int, item_idx int")
    got = metrics.ranking_metrics(rec_df, truth_df, 10).first().asDict()
    lists = {}
    for u, i, _ in recs:
        lists.setdefault(u, []).append(float(i))
    both = spark.createDataFrame(
        [(lists.get(u, []), [float(i) for v, i in truth if v == u]) for u in range(22)],
        "prediction array<double>, label array<double>")
    for name, theirs in [("recall", "recallAtK"), ("precision", "precisionAtK"), ("ndcg", "ndcgAtK"), ("map", "meanAveragePrecisionAtK")]:
        assert got[f"{name}_at_10"] == pytest.approx(RankingEvaluator(metricName=theirs, k=10).evaluate(both)), name
    hit = sum(any(i in [x for v, x in truth if v == u] for i in lists.get(u, [])) for u in range(22)) / 22
    assert got["hit_rate_at_10"] == pytest.approx(hit)
    assert got["n_entities_evaluated"] == 22


@pytest.fixture(scope="module")
def clustered(spark):
    """Users of two tastes; one user interacts with far more items than the others."""
    rng = random.Random(2)
    rows = []
    for u in range(40):
        own = [i for i in range(60) if i % 2 == u % 2]
        for i in rng.sample(own, 28 if u == 0 else 12):
            rows.append((f"user-{u}", f"item-{i}", 1.0, u))
    return spark.createDataFrame(rows, "user_id string, item_id string, weight double, timestamp long")


def test_als_end_to_end(spark, clustered, tmp_path):
    data = I.prepare_interactions(clustered, ["timestamp"])
    assert data.train.join(data.test, ["user_idx", "item_idx"]).count() == 0
    model = recommend.fit_als(data.train, {"als_factors": 4, "als_iterations": 5})
    users = data.entity_index.select(F.col("entity_idx").alias("user_idx"))
    recs = recommend.recommend(model, users, 5, seen=data.train)
    assert recs.join(data.train, ["user_idx", "item_idx"]).count() == 0
    assert recs.groupBy("user_idx").count().where("count <> 5").count() == 0
    got = metrics.ranking_metrics(recs, data.test, 5).first()
    assert got["hit_rate_at_5"] > 0.3  # the tastes are learned; chance is far lower
    sinks.save_recommender(model, data.entity_index, data.item_index, str(tmp_path), {"k": 5})
    loaded, entities, items, config = sinks.load_recommender(spark, str(tmp_path))
    asked = spark.createDataFrame([("user-0",), ("stranger",)], "entity_id string")
    lists = recommend.recommendation_lists(asked, recommend.recommend(loaded, users, 5), entities, items)
    lists = {r["entity_id"]: r["items"] for r in lists.collect()}
    assert lists["stranger"] == [] and len(lists["user-0"]) == 5 and config == {"k": 5}


def test_seen_items_are_excluded_exactly(spark, clustered):
    """Same as scoring every item and filtering, also for the user who has seen most."""
    data = I.prepare_interactions(clustered, ["timestamp"])
    model = recommend.fit_als(data.train, {"als_factors": 4, "als_iterations": 3})
    users = data.train.select("user_idx").distinct()
    n_items = data.item_index.count()
    everything = recommend.recommend(model, users, n_items)
    left = everything.join(data.train.select("user_idx", "item_idx"), ["user_idx", "item_idx"], "left_anti")
    best = {}
    for r in left.collect():
        best.setdefault(r["user_idx"], []).append((-r["score"], r["item_idx"]))
    got = {}
    for r in recommend.recommend(model, users, 7, seen=data.train).collect():
        got.setdefault(r["user_idx"], []).append((-r["score"], r["item_idx"]))
    assert {u: sorted(v) for u, v in got.items()} == {u: sorted(v)[:7] for u, v in best.items()}


def test_empty_after_filtering_is_an_error(spark):
    df = spark.createDataFrame([("u", "i", 1.0, 1)], "user_id string, item_id string, weight double, timestamp long")
    with pytest.raises(ValueError, match="no interactions"):
        I.prepare_interactions(df, ["timestamp"])


def test_copies_of_factors_stay_few():
    """Rows shuffled by the ranking for 900,000 users and 1,200,000 items: under 20 for each of them."""
    users, items = 900_000, 1_200_000
    u, i = recommend.block_counts(users, items, recommend.BLOCK_ROWS, 12)
    assert users * i + items * u < 20 * (users + items)
    assert u * i >= 24  # and enough cells for the cores
    assert recommend.block_counts(90_000, 120_000, recommend.BLOCK_ROWS, 12)[0] >= 22


def test_best_of_a_block_over_several_tiles(monkeypatch):
    monkeypatch.setattr(recommend, "TILE_ITEMS", 7)
    rng = np.random.default_rng(4)
    x, y = rng.integers(-3, 4, (9, 3)).astype(np.float32), rng.integers(-3, 4, (60, 3)).astype(np.float32)  # many ties
    hidden = [np.sort(rng.choice(60, n, replace=False)) for n in (0, 1, 5, 20, 58, 60, 3, 0, 7)]
    for got, row, mask in zip(recommend._best_in_block(x, np.arange(100, 160), y, hidden, 4), x @ y.T, hidden):
        free = [j for j in np.lexsort((np.arange(60), -row)) if j not in set(mask)][:4]
        assert got[0].tolist() == [100 + j for j in free] and got[1].tolist() == [row[j] for j in free]


@pytest.mark.parametrize("copies", [1, 3])
def test_k_core_makes_partners_distinct_only_if_rows_repeat(spark, monkeypatch, copies):
    pairs = {(u, i) for u in range(12) for i in range(10) if (u * i) % 7 < 4 and u + i < 16}
    rows = [(u, i, float(c)) for u, i in pairs for c in range(copies)] + [(None, 1, 0.0), (1, None, 0.0), (None, None, 0.0)]
    asked, made = [], I.partner_counts
    monkeypatch.setattr(I, "partner_counts", lambda *a: asked.append(a) or made(*a))
    df = spark.createDataFrame(rows, "user_id int, item_id int, weight double")
    got = I.k_core(df, min_users=6, min_items=4).collect()
    while True:
        kept = {(u, i) for u, i in pairs if sum(j == i for _, j in pairs) >= 6}
        kept = {(u, i) for u, i in kept if sum(v == u for v, _ in kept) >= 4}
        if kept == pairs:
            break
        pairs = kept
    assert pairs and sorted((r.user_id, r.item_id) for r in got) == sorted(p for p in pairs for _ in range(copies))
    assert bool(asked) == (copies > 1)


def test_tiles_of_vectors_too_short_to_matter_are_left_out(monkeypatch):
    monkeypatch.setattr(recommend, "TILE_ITEMS", 16)
    monkeypatch.setattr(recommend, "TILE_USERS", 8)
    looked, places = [], recommend._places
    monkeypatch.setattr(recommend, "_places", lambda marks: looked.append(len(marks)) or places(marks))
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(50, 4)).astype(np.float32), rng.normal(size=(400, 4)).astype(np.float32)
    y[rng.permutation(400)[:360]] *= 1e-3  # the long ones lie anywhere
    x[7] = 0  # all its scores are ties
    hidden = [np.sort(rng.choice(400, n, replace=False)) for n in rng.integers(0, 9, 50)]
    got = recommend._best_in_block(x, np.arange(400), y, hidden, 5)
    for (ids, _), row, mask in zip(got, x @ y.T, hidden):
        assert ids.tolist() == [j for j in np.lexsort((np.arange(400), -row)) if j not in set(mask)][:5]
    assert len(looked) < 7 * 25 / 2  # of 7 x 25 products


@pytest.mark.parametrize("block_rows", [4, 1000])
def test_blocks_of_factors_give_the_scores_of_all_pairs(spark, block_rows):
    rng = np.random.default_rng(6)
    x, y = rng.integers(-3, 4, (23, 3)), rng.integers(-3, 4, (31, 3))
    rows = lambda m: spark.createDataFrame([(i, [float(v) for v in f]) for i, f in enumerate(m)], "id int, features array<float>")
    model = type("Factors", (), {"userFactors": rows(x), "itemFactors": rows(y)})
    seen = {(int(u), int(i)) for u, i in zip(rng.integers(0, 23, 90), rng.integers(0, 31, 90))} | {(3, i) for i in range(31)}
    users = spark.createDataFrame([(u,) for u in [*range(20), 20, 20, 99, None]], "user_idx int")  # 99 has no factors
    seen_df = spark.createDataFrame(sorted(seen) + [(99, 1), (None, 2), (1, None)], "user_idx int, item_idx int")
    got = {}
    for r in recommend.recommend(model, users, 6, seen=seen_df, block_rows=block_rows).collect():
        got.setdefault(r.user_idx, {})[r.rank] = r.item_idx
    for u in range(23):
        free = [i for i in np.lexsort((np.arange(31), -(y @ x[u]))).tolist() if (u, i) not in seen][:6]
        assert got.get(u, {}) == ({r + 1: i for r, i in enumerate(free)} if u < 21 else {})
    assert set(got) == set(range(21)) - {3}

import math
import random

import pytest
from pyspark.sql import functions as F

from loomline.operators import metrics, models, profile, splits, tabular


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(1)
    rows = [(i, rng.random() < 0.3, rng.randrange(20) / 20) for i in range(400)]
    return spark.createDataFrame([(i, int(y), s) for i, y, s in rows], "id int, y int, s double").cache()


def brute_auc(rows):
    pos = [s for _, y, s in rows if y == 1]
    neg = [s for _, y, s in rows if y != 1]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_with_ties(scored, grouping):
    assert metrics.roc_auc(scored, "y", "s").first()["auc"] == pytest.approx(brute_auc(scored.collect()))


def test_auc_by_group_and_single_class(spark, scored, grouping):
    df = scored.withColumn("g", F.col("id") % 3)
    got = {r["g"]: r["auc"] for r in metrics.roc_auc(df, "y", "s", ["g"]).collect()}
    for g in range(3):
        assert got[g] == pytest.approx(brute_auc(df.where(f"g = {g}").select("id", "y", "s").collect()))
    one = scored.where("y = 1")
    assert metrics.roc_auc(one, "y", "s").first()["auc"] is None
    fallback = metrics.auc_or_accuracy(one.withColumn("p", F.lit(1)), "y", "s", "p").first()
    assert tuple(fallback) == ("validation_accuracy", 1.0)
    both = metrics.auc_or_accuracy(scored.withColumn("p", F.lit(1)), "y", "s", "p").first()
    assert both["metric"] == "validation_auc"


@pytest.mark.parametrize("labels", [(0, 1), (1, 2), (-1, 1), (3, 7)])
def test_auc_takes_the_larger_label_as_positive(spark, labels):
    low, top = labels
    df = spark.createDataFrame([(low, 0.1), (low, 0.2), (top, 0.8), (top, 0.9), (None, 0.5)], "y int, s double")
    row = metrics.roc_auc(df, "y", "s").first()
    assert (row["auc"], row["n_pos"], row["n_neg"]) == (1.0, 2, 2)


def test_curve_and_sweep(scored, grouping):
    rows = scored.collect()
    n_pos = sum(r["y"] for r in rows)
    curve = {r["threshold"]: r for r in metrics.roc_curve(scored, "y", "s").collect()}
    sweep = {r["threshold"]: r for r in metrics.threshold_sweep(scored, "y", "s").collect()}
    for t in {r["s"] for r in rows}:
        tp = sum(r["y"] for r in rows if r["s"] >= t)
        chosen = sum(1 for r in rows if r["s"] >= t)
        assert (curve[t]["tp"], curve[t]["fp"]) == (tp, chosen - tp)
        p, r_ = tp / chosen, tp / n_pos
        assert sweep[t]["precision"] == pytest.approx(p) and sweep[t]["recall"] == pytest.approx(r_)
        assert sweep[t]["f1"] == pytest.approx(2 * p * r_ / (p + r_) if p + r_ else 0.0)


def test_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(0.15,), (0.1499,)], "p double")
    assert [r[0] for r in df.select(metrics.apply_threshold("p", 0.15)).collect()] == [1, 0]


def test_reports(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (1, 0)], "y int, p int")
    r = metrics.classification_report(df, "y", "p").first().asDict()
    assert (r["validation_accuracy"], r["averaging"], r["n_test"], r["classes"]) == (0.6, "binary", 5, "0,1")
    assert (r["precision"], r["recall"]) == (pytest.approx(2 / 3), pytest.approx(2 / 3))
    multi = spark.createDataFrame([(0, 0), (1, 2), (2, 2), (2, 1)], "y int, p int")
    r = metrics.classification_report(multi, "y", "p").first().asDict()
    assert (r["averaging"], r["precision"], r["recall"]) == ("macro", pytest.approx(0.5), pytest.approx(0.5))
    never = spark.createDataFrame([(0, 0), (1, 0)], "y int, p int")
    r = metrics.classification_report(never, "y", "p").first().asDict()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)
    reg = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (4.0, 3.0)], "y double, p double")
    r = metrics.evaluate("regression", reg, "y", "p").first().asDict()
    assert r["rmse"] == pytest.approx(math.sqrt(2 / 3)) and r["mae"] == pytest.approx(2 / 3)
    assert r["validation_r2"] == pytest.approx(1 - 2 / (14 / 3)) and r["n_test"] == 3
    assert metrics.with_gate(metrics.regression_report(reg, "y", "p"), "validation_r2", 0.6).first()["passed"] is False
    assert metrics.residual_summary(reg, "y", "p").first()["n_match"] == 1
    with pytest.raises(ValueError):
        metrics.evaluate("poetry", reg)


def test_leak_check(spark, scored):
    df = scored.withColumn("leak", F.col("y") * 2.0).withColumn("mirror", F.col("y") * -1.0)
    got = {r["feature"]: r["leaks"] for r in metrics.feature_auc(df, "y", ["leak", "mirror", "s"]).collect()}
    assert got == {"leak": True, "mirror": True, "s": False}


def test_parity(spark, scored):
    shifted = scored.withColumn("s", F.col("s") + F.when(F.col("id") == 3, 0.5).otherwise(0.0))
    assert metrics.prediction_parity(scored, scored, "id", "s").first()["all_close"]
    row = metrics.prediction_parity(scored, shifted, "id", "s").first()
    assert not row["all_close"] and row["max_abs_diff"] == pytest.approx(0.5) and row["n_matched"] == 400


def test_splits(scored):
    train, test = splits.train_test(scored, ["id"])
    assert train.join(test, "id").count() == 0 and train.count() + test.count() == 400
    assert 50 <= test.count() <= 110
    assert sorted(test.collect()) == sorted(splits.train_test(scored.repartition(9), ["id"])[1].collect())
    sample = splits.sample_n(scored, ["id"], 200)
    assert sample.count() == 200 == sample.distinct().count()
    per = splits.stratified_sample(scored, "y", ["id"], 5).groupBy("y").count().collect()
    assert sorted(tuple(r) for r in per) == [(0, 5), (1, 5)]
    assert [r["id"] for r in splits.first_rows(scored, ["id"], 3).collect()] == [0, 1, 2]


def test_profiles(spark, scored, grouping):
    assert {r["y"]: r["n"] for r in profile.value_counts(scored, "y").collect()}[1] == scored.where("y = 1").count()
    assert tuple(profile.class_summary(scored, "y").first()) == (2, 2)
    weighted = profile.with_balanced_weight(scored, "y").groupBy("y").agg(F.sum("class_weight").alias("w"))
    assert all(r["w"] == pytest.approx(200) for r in weighted.collect())
    row = profile.profile(scored, ["s"]).first()
    assert row["count"] == 400 and row["min"] == 0.0 and row["min"] <= row["p25"] <= row["p50"] <= row["p75"] <= row["max"]
    assert profile.dataset_summary(scored, "y").first()["n_cols"] == 3


def test_unseen_categories(spark, grouping):
    train = spark.createDataFrame([("chrome",), ("firefox",), ("safari",), (None,)], "browser string")
    seen = profile.fit_vocabulary(train, "browser")
    df = spark.createDataFrame([("edge",), ("firefox",), (None,)], "browser string")
    coded = df.select(profile.category_code("browser", seen).alias("c"), profile.one_hot("browser", seen).alias("h"))
    assert [(r["c"], r["h"]) for r in coded.collect()] == [(-1, [0, 0, 0]), (1, [0, 1, 0]), (-1, [0, 0, 0])]
    with pytest.raises(Exception, match="unseen value in browser: edge"):
        df.where("browser = 'edge'").select(profile.category_code("browser", seen, unseen="error")).collect()
    with pytest.raises(ValueError):
        profile.fit_vocabulary(train, "browser", max_values=2)
    many = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [(None,)], "v string")
    got = {r["v"]: r["count"] for r in profile.with_rare_grouped(many, "v", 3).groupBy("v").count().collect()}
    assert got == {"a": 5, "other": 2, None: 1}


def test_drift_and_boundaries(spark, scored):
    same = profile.drift(scored, scored, "s").first()
    assert same["psi"] == pytest.approx(0.0) and same["kl"] == pytest.approx(0.0)
    assert profile.drift(scored, scored.where("s > 0.5"), "s").first()["psi"] > 1
    df = spark.createDataFrame([(1, "a"), (None, "b"), (-1, None)], "n int, c string")
    rules = {"positive": F.col("n") > 0, "known": F.col("c").isin("a", "b")}
    assert {r["rule"]: r["n_bad"] for r in profile.boundary_checks(df, rules).collect()} == {"positive": 2, "known": 1}
    assert profile.offenders(df, rules["known"]).count() == 1


def test_price_zscore(spark, grouping):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", 5.0), ("c", 9.0)], "g string, p double")
    got = sorted((r["g"], round(r["z"], 6)) for r in profile.price_zscore(df, ["g"], "p").collect())
    assert got == [("a", -0.707107), ("a", 0.707107), ("b", 0.0), ("b", 0.0), ("c", 0.0)]


def test_housing_features(spark):
    rows = [(8.3252, 41.0, 6.98, 1.02, 322.0, 2.55, 37.88, -122.23), (-1.0, 1.0, 0.0, 0.0, 0.0, 0.0, 34.05, -118.24)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in tabular.RAW_COLUMNS))
    out = tabular.housing_features(df)
    assert len(out.columns) == 8 + 44
    a, b = (r.asDict() for r in out.orderBy(F.desc("MedInc")).collect())
    assert a["rooms_per_household"] == pytest.approx(6.98 / (2.55 + 1e-6))
    assert a["geo_dist"] == pytest.approx(math.hypot(37.88 - 35, -122.23 + 119))
    assert a["min_city_dist"] == pytest.approx(a["dist_sf"]) and a["medinc3"] == pytest.approx(8.3252**3)
    assert (b["dist_la"], b["sqrt_medinc"], b["occ_ratio"]) == (0.0, 0.0, 0.0)


def test_geo_clusters_fit_on_training_only(spark):
    pts = [(float(i % 4) * 10, float(i % 4), i) for i in range(80)]
    df = spark.createDataFrame(pts, "Latitude double, Longitude double, id int")
    model = tabular.fit_geo_clusters(df.where("id < 60"), k=4)
    out = tabular.with_geo_cluster(df, model)
    assert out.agg(F.max("dist_to_cluster_center")).first()[0] == pytest.approx(0.0, abs=1e-9)
    assert out.select("geo_cluster").distinct().count() == 4


def test_geo_clusters_weigh_equal_points(spark):
    pts = [(0.0, 0.0)] * 90 + [(0.0, 1.0)] * 10 + [(50.0, 0.0)] * 5 + [(50.0, 2.0)] * 15
    df = spark.createDataFrame(pts, "Latitude double, Longitude double")
    model = tabular.fit_geo_clusters(df, k=2, starts=2)
    assert sum(model.summary.clusterSizes) == 4  # points compared
    assert sorted(tuple(c) for c in model.clusterCenters()) == [pytest.approx((0.0, 0.1)), pytest.approx((50.0, 1.5))]
    cost = tabular.with_geo_cluster(df, model).agg(F.sum(F.col("dist_to_cluster_center") ** 2)).first()[0]
    assert model.summary.trainingCost == pytest.approx(cost)


def test_importance(spark):
    rng = random.Random(9)
    rows = [(i, rng.random(), rng.random()) for i in range(300)]
    df = spark.createDataFrame([(i, a, b, int(a > 0.5)) for i, a, b in rows], "id int, a double, b double, target int")
    model = models.random_forest(["a", "b"], {"n_estimators": 5}).fit(df)
    assert models.impurity_importance(model, ["a", "b"])[0][0] == "a"
    moved = models.permuted(df, ["id"], ["a", "b"], 2, 1)
    assert moved.count() == 4 * 300
    for r in range(2):
        one = moved.where(f"_feature = 'a' AND _repeat = {r}")
        assert sorted(x["a"] for x in one.collect()) == sorted(x["a"] for x in df.collect())
        old = one.join(df.select("id", F.col("a").alias("_a"), F.col("b").alias("_b")), "id")
        assert old.where("a <> _a").count() > 250 and old.where("b <> _b").count() == 0
    got = {r["feature"]: r["mean_auc_loss"] for r in models.permutation_importance(model, df, ["id"], ["a", "b"], repeats=2).collect()}
    assert got["a"] > 0.3 > abs(got["b"]) + 0.2

import numpy as np
from pyspark.sql import functions as F

from loomline.operators import profile
from loomline.sources import sinks


def frame(spark, x, nulls=0):
    rows = [(float(v), None if i < nulls else float("nan") if i == nulls else 1.0) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "x double, y double").repartition(3)


def exact_psi(base, current, bins=10):
    edges = np.quantile(base, [i / bins for i in range(1, bins)])
    p, q = (np.bincount(np.searchsorted(edges, v), minlength=bins) / len(v) for v in (base, current))
    p, q = np.maximum(p, 1e-6), np.maximum(q, 1e-6)
    return ((q - p) * np.log(q / p)).sum()


def test_psi_of_known_shifts(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(0, 1, 20_000)
    told = profile.quantile_sketches(frame(spark, base), ["x"])
    for shift, spread in ((0.0, 1.0), (0.5, 1.0), (0.0, 1.5)):
        now = rng.normal(shift, spread, 15_000)
        row = profile.drift_numeric(told, frame(spark, now), 10).first()
        assert abs(row.psi - exact_psi(base, now)) < 0.02 and row.n_bins == 11
        assert (row.psi < 0.01) == (shift == 0 and spread == 1) and row.kl >= 0


def test_sketches_merge_and_bound_the_error(spark):
    rng = np.random.default_rng(2)
    parts = [rng.exponential(1, 4000), rng.normal(5, 1, 8000), np.full(2000, 3.0)]
    told = [profile.quantile_sketches(frame(spark, p, 5), ["x", "y"]) for p in parts]
    merged = profile.merged_sketches(told[0].unionByName(told[1]).unionByName(told[2]))
    rows = {r["column"]: r for r in merged.collect()}
    assert (rows["x"].n_rows, rows["x"].n_null, rows["y"].n_null) == (14_000, 0, 18)
    x = np.sort(np.concatenate(parts))
    bins = {column: (edges, shares) for column, edges, shares in profile.sketch_bins(merged)}
    edges, shares = bins["x"]
    assert len(shares) == len(edges) + 2 and abs(sum(shares) - 1) < 1e-9
    for e, share in zip(edges, np.cumsum(shares)):
        assert abs(np.searchsorted(x, e, "right") / len(x) - share) < 0.005


def test_nulls_constants_and_empty_tables(spark):
    base = frame(spark, np.zeros(500), 100)
    told = profile.quantile_sketches(base, ["x", "y"])
    same = {r["column"]: r.psi for r in profile.drift_numeric(told, base).collect()}
    assert all(v < 1e-9 for v in same.values())
    more = {r["column"]: r.psi for r in profile.drift_numeric(told, frame(spark, np.zeros(500), 400)).collect()}
    assert more["x"] < 1e-9 and more["y"] > 0.5
    none = profile.quantile_sketches(base.where("x > 5"), ["x"])
    assert none.first().n_rows == 0
    assert profile.drift_numeric(told, base.where("x > 5")).count() == 2


def digest(state):
    return sinks.state_digest(state, "s").first()["dataset_sha256"]


def test_states_add_up_in_any_order_and_take_out(spark):
    df = spark.createDataFrame([(i % 40, f"t{i % 7}", None if i % 9 == 0 else i / 3) for i in range(300)], "a int, b string, c double")
    whole = sinks.multiset_state(df)
    parts = sinks.multiset_state(df.repartition(7), ["b"])
    assert parts.count() == 7 and digest(sinks.merged_states(parts)) == digest(whole)
    assert digest(sinks.multiset_state(df.orderBy(F.desc("c")))) == digest(whole)
    less = sinks.merged_states(whole.unionByName(sinks.negated_state(sinks.multiset_state(df.where("b = 't3'")))))
    assert digest(less) == digest(sinks.multiset_state(df.where("b <> 't3'")))
    assert less.first().n_rows == df.where("b <> 't3'").count()


def test_any_change_changes_the_digest(spark):
    rows = [(i, f"t{i}") for i in range(20)]
    base = digest(sinks.multiset_state(spark.createDataFrame(rows, "a int, b string")))
    seen = {base}
    for other in ([*rows, rows[0]], rows[1:], [*rows[1:], (0, None)], [(1, "t0"), (0, "t1"), *rows[2:]], [*rows[2:], rows[0], rows[0]]):
        seen.add(digest(sinks.multiset_state(spark.createDataFrame(other, "a int, b string"))))
    assert len(seen) == 6
    empty = sinks.multiset_state(spark.createDataFrame([], "a int, b string")).first()
    assert empty.n_rows == 0 and [int(v) for v in empty.lanes] == [0] * 4

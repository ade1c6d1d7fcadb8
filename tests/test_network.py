import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.operators import network

NAMES = ["a", "b"]


def rings(n, seed):
    """Three classes by distance from the origin: no line parts them."""
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 2))
    return x, np.digitize(np.hypot(*x.T), [0.8, 1.5])


def frame(spark, x, y, parts=4):
    rows = [(i, float(r[0]), float(r[1]), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, a double, b double, target int").repartition(parts)


def test_gradient_by_differences():
    rng = np.random.default_rng(1)
    sizes = [3, 5, 2, 4]
    weights = network.initial(sizes, 7)
    x, y = rng.normal(0, 1, (6, 3)), rng.integers(0, 4, 6)
    values = network.flat(weights)
    _, slope = network.gradient(weights, x, y)
    slope = network.flat(slope)
    for j in range(len(values)):
        step = np.zeros_like(values)
        step[j] = 1e-6
        up, down = (network.gradient(network.shaped(values + s, sizes), x, y)[0] for s in (step, -step))
        assert abs((up - down) / 2e-6 - slope[j]) < 1e-4


def test_learns_and_does_not_depend_on_partitions(spark, tmp_path):
    x, y = rings(1200, 2)
    params = {"epochs": 25, "lr": 0.03, "hidden_dim": 16, "batch_size": 600}
    models = [network.fit_network(frame(spark, x, y, parts), NAMES, ["id"], 3, params=params) for parts in (1, 7)]
    assert models[0].values == models[1].values and models[0].losses[-1] < models[0].losses[0] / 2
    tx, ty = rings(500, 3)
    test = frame(spark, tx, ty)
    scored = models[0].transform(test).collect()
    assert np.mean([r.prediction == r.target for r in scored]) >= 0.85
    assert all(abs(sum(r.probabilities) - 1) < 1e-9 for r in scored)
    models[0].save(spark, str(tmp_path))
    again = network.Network.load(spark, str(tmp_path)).transform(test).collect()
    assert sorted((r.id, r.prediction) for r in again) == sorted((r.id, r.prediction) for r in scored)


def test_steps_equal_a_plain_version(spark):
    """One minibatch per epoch: the same as Adam on all rows at once."""
    x, y = rings(300, 4)
    model = network.fit_network(frame(spark, x, y), NAMES, ["id"], 3, params={"epochs": 3, "hidden_dim": 8, "batch_size": 1000})
    z = (x - np.array(model.mean)) / np.array(model.deviation)
    values = network.flat(network.initial(model.sizes, 42))
    m, v = np.zeros_like(values), np.zeros_like(values)
    for t in range(1, 4):
        g = network.flat(network.gradient(network.shaped(values, model.sizes), z, y)[1]) / 300
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
        values -= 1e-3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    assert np.allclose(values, model.values, atol=1e-10)


def test_odd_rows(spark):
    rows = [(i, None if i % 5 == 0 else float("nan") if i % 7 == 0 else float(i), 3.0, None if i % 11 == 0 else i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, a double, b double, target int")
    model = network.fit_network(df, NAMES, ["id"], 2, params={"epochs": 1, "hidden_dim": 1})
    assert model.transform(df).where(F.col("prediction").isNull()).count() == 0
    with pytest.raises(ValueError, match="no labelled rows"):
        network.fit_network(df.where("target is null"), NAMES, ["id"], 2)
    with pytest.raises(ValueError, match="unknown parameters"):
        network.fit_network(df, NAMES, ["id"], 2, params={"layers": 3})


def test_gradients_of_many_blocks_are_added_on_the_executors(spark):
    """The driver gets a bounded number of sums, which are those of all blocks."""
    rng, sizes = np.random.default_rng(3), [2, 4, 2, 3]
    values = network.flat(network.initial(sizes, 1))
    rows, want = [], np.zeros_like(values)
    for block in range(150):
        x, y = rng.normal(0, 1, (5, 2)), rng.integers(0, 3, 5)
        rows.append((block, x.tobytes(), y.tobytes()))
        want += network.flat(network.gradient(network.shaped(values, sizes), x, y)[1])
    for parts in (1, 9):
        blocks = spark.createDataFrame([(b, bytearray(x), bytearray(y)) for b, x, y in rows], "block int, x binary, y binary").repartition(parts)
        assert network._batch_slopes(blocks, sizes, values, 150).count() == network.DRIVER_ROWS
        loss, n, slope = network._batch_gradient(blocks, sizes, values, 150)
        assert n == 750 and np.allclose(slope, want)

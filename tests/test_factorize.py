import numpy as np
import pytest

from loomline.operators import factorize

PARAMS = {"factors": 4, "iterations": 3, "regularization": 0.1, "alpha": 3.0, "cg_steps": 30}


@pytest.fixture(scope="module")
def data(spark):
    """Users of two tastes over twenty items; item 0 is bought by everyone."""
    rng = np.random.default_rng(1)
    rows = [(u, 0, 1.0) for u in range(40)]
    rows += [(u, int(i), float(rng.integers(1, 5))) for u in range(40) for i in rng.choice(np.arange(1 + u % 2, 20, 2), 5, replace=False)]
    rows += [(3, 19, 0.0), (4, 18, None)]
    return rows, spark.createDataFrame(rows, "user_idx int, item_idx int, weight double").repartition(5)


def dense(rows, p, start):
    c, s = np.ones((40, 20)), np.zeros((40, 20))
    for u, i, w in rows:
        if w and w > 0:
            c[u, i], s[u, i] = 1 + p["alpha"] * w, 1.0
    y = start.copy()
    eye = p["regularization"] * np.eye(p["factors"])
    for _ in range(p["iterations"]):
        x = np.array([np.linalg.solve(y.T @ (c[u][:, None] * y) + eye, y.T @ (c[u] * s[u])) for u in range(40)])
        y = np.array([np.linalg.solve(x.T @ (c[:, i][:, None] * x) + eye, x.T @ (c[:, i] * s[:, i])) for i in range(20)])
    loss = (c * (s - x @ y.T) ** 2).sum() + p["regularization"] * ((x**2).sum() + (y**2).sum())
    return x, y, loss


def table(factors):
    return np.array([r.f for r in factors.orderBy("id").collect()])


def test_equals_a_dense_solution(spark, data, grouping):
    rows, train = data
    ids = spark.createDataFrame([(i,) for i in range(20)], "id int")
    start = table(factorize._first(ids, 4, 42))
    x, y, loss = dense(rows, PARAMS, start)
    users, items = factorize.fit_implicit(train, PARAMS)
    assert np.allclose(table(users), x, atol=1e-6) and np.allclose(table(items), y, atol=1e-6)
    assert abs(factorize.implicit_loss(train, users, items, PARAMS) - loss) < 1e-5


def test_loss_falls_and_new_users_are_folded_in(spark, data):
    rows, train = data
    losses = []
    for n in (1, 2, 4):
        p = PARAMS | {"iterations": n}
        users, items = factorize.fit_implicit(train, p)
        losses.append(factorize.implicit_loss(train, users, items, p))
    assert losses[0] > losses[1] > losses[2]
    new = spark.createDataFrame([(100, 1, 2.0), (100, 3, 1.0), (101, 2, 1.0), (102, 999, 1.0), (103, 5, 0.0)], "id int, other int, w double")
    got = {r.id: np.array(r.f) for r in factorize.fold_in(new, items, PARAMS).collect()}
    y = table(items)
    assert set(got) == {100, 101}
    for user, seen in ((100, {1: 2.0, 3: 1.0}), (101, {2: 1.0})):
        c, s = np.ones(20), np.zeros(20)
        for i, w in seen.items():
            c[i], s[i] = 1 + PARAMS["alpha"] * w, 1.0
        want = np.linalg.solve(y.T @ (c[:, None] * y) + 0.1 * np.eye(4), y.T @ (c * s))
        assert np.allclose(got[user], want, atol=1e-6)
    assert (y[1::2] @ got[100]).mean() > (y[2::2] @ got[100]).mean()


def test_conjugate_gradients_solve():
    rng = np.random.default_rng(5)
    a = rng.normal(0, 1, (7, 6, 6))
    a = a @ a.transpose(0, 2, 1)
    gram, b = np.eye(6), rng.normal(0, 1, (7, 6))
    got = factorize.solved(gram, a, b, 0.5, 60)
    want = np.stack([np.linalg.solve(gram + m + 0.5 * np.eye(6), v) for m, v in zip(a, b)])
    assert np.allclose(got, want, atol=1e-8)
    assert np.allclose(factorize.solved(gram, a, 0 * b, 0.5, 5), 0)


def test_empty_table(spark):
    users, items = factorize.fit_implicit(spark.createDataFrame([], "user_idx int, item_idx int, weight double"), PARAMS)
    assert users.count() == items.count() == 0

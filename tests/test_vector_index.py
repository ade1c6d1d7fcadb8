import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.operators import retrieval, vector_index

SCHEMA = "item_id bigint, embedding array<float>, label string"


def clustered(n, dim, seed, spread=0.25, groups=12):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 1, (groups, dim))
    return [(i, (middles[i % groups] + rng.normal(0, spread, dim)).tolist(), "x") for i in range(n)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    items = spark.createDataFrame(clustered(3000, 20, 1), SCHEMA)
    folder = str(tmp_path_factory.mktemp("index"))
    vector_index.write_index(items, vector_index.fit_index(items, 24, n_parts=6), folder)
    return items, *vector_index.load_index(spark, folder)


def queries_of(items, every=30):
    return items.where(f"item_id % {every} = 0").select(F.col("item_id").alias("query_id"), "embedding")


def test_every_vector_is_indexed_once(stored):
    items, index, model = stored
    assert index.count() == 3000 and index.select("item_id").distinct().count() == 3000
    for r in index.where("item_id < 50").collect():
        cell, offset = model.offsets(np.array([r.embedding], dtype=float))
        assert (cell[0], model.codes(offset)[0].tobytes()) == (r.cell, bytes(r.code))


def test_recall_with_few_items_compared(stored):
    items, index, model = stored
    asked = queries_of(items)
    near = vector_index.candidates(index, model, asked, 6, 60)
    assert near.groupBy("query_id").count().agg(F.max("count")).first()[0] <= 60
    hits = vector_index.search_index(index, model, asked, 10, 6, 60)
    recall = retrieval.recall_against(retrieval.nearest(items, asked, 10), hits).first()
    assert recall.n_exact == 1000 and recall.recall >= 0.9
    x = {r.item_id: np.array(r.embedding) for r in items.collect()}
    for r in hits.collect():
        assert abs(((x[r.item_id] - x[r.query_id]) ** 2).sum() - r._distance) < 1e-5


def test_all_cells_and_items_are_exact(stored):
    """With nothing pruned the search is the exact one; queries by cogroup give the same as by broadcast."""
    items, index, model = stored
    asked = queries_of(items, 300)
    want = [tuple(r) for r in retrieval.nearest(items, asked, 7).select("query_id", "rank", "item_id").sort("query_id", "rank").collect()]
    for limit in (32 << 20, 1):
        hits = vector_index.search_index(index, model, asked, 7, 24, 3000, max_broadcast=limit)
        assert [tuple(r) for r in hits.select("query_id", "rank", "item_id").sort("query_id", "rank").collect()] == want
    narrow = [vector_index.candidates(index, model, asked, 3, 40, limit) for limit in (32 << 20, 1)]
    a, b = ({(r.query_id, r.item_id): round(r.rough, 6) for r in n.collect()} for n in narrow)
    assert a == b


def test_search_reads_only_probed_cells(stored):
    items, index, model = stored
    one = queries_of(items).where("query_id = 0")
    near = vector_index.candidates(index, model, one, 2, 50)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "code" in line)
    assert "embedding" not in scan
    assert near.select("cell").distinct().count() <= 2


def test_odd_vectors_and_queries(spark, tmp_path):
    good = clustered(40, 5, 3)
    rows = good + [(100, None, "x"), (101, [], "x"), (102, [None, 1.0, 1.0, 1.0, 1.0], "x"), (103, [float("nan")] * 5, "x"),
                   (104, [float("inf")] * 5, "x"), (7, good[7][1], "twice")]
    items = spark.createDataFrame(rows, SCHEMA)
    vector_index.write_index(items, vector_index.fit_index(items, 100, n_parts=3), str(tmp_path))
    index, model = vector_index.load_index(spark, str(tmp_path))
    assert index.count() == 41
    asked = spark.createDataFrame([(1, good[1][1]), (2, None), (3, [float("nan")] * 5), (7, good[7][1])], "query_id int, embedding array<double>")
    hits = vector_index.search_index(index, model, asked, 2, 100, 41).collect()
    assert sorted((r.query_id, r.rank) for r in hits) == [(1, 1), (1, 2), (7, 1), (7, 2)]
    assert [r.item_id for r in hits if r.query_id == 7] == [7, 7]
    none = vector_index.search_index(index, model, asked.where("query_id = 2"), 2, 100, 41)
    assert none.collect() == []
    with pytest.raises(ValueError, match="no vectors"):
        vector_index.fit_index(items.where("item_id = 100"), 4)


def test_many_queries_of_a_cell_meet_it_in_bounded_memory():
    """Tables of distances are made for a few queries at a time, whatever their number."""
    import tracemalloc

    rng = np.random.default_rng(0)
    model = vector_index.IndexModel(rng.normal(size=(2, 64)), rng.normal(size=(16, 256, 4)))
    q, ids, codes = rng.normal(size=(1000, 64)), np.arange(500), rng.integers(0, 256, (500, 16)).astype(np.uint8)
    tracemalloc.start()
    found, rows = 0, {}
    for frame in vector_index._best_codes(model, 1, list(range(1000)), q, ids, codes, 20):
        found += len(frame)
        rows |= {k: v.set_index("item_id")["rough"].to_dict() for k, v in frame.groupby("query_id")}
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 20_000 and most < 60_000_000
    for i in (0, 31, 32, 999):
        rough = model.tables(q[i : i + 1], 1)[0][np.arange(16), codes].sum(1)
        assert rows[i] == pytest.approx({int(j): rough[j] for j in np.argsort(rough)[:20]})

import hashlib
import math

import numpy as np
import pytest

from loomline.llm import centroids

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, cells int, band int, cluster int, row int"


def rows_of(vectors):
    return [(i, None if v is None else [None if c is None else float(c) for c in v], 1, "x", 2, 3, 4, 5) for i, v in vectors]


def brute(vectors, k=8, rounds=10, dimensions=64, seed=3):
    kept = []
    for i, v in vectors:
        if v is None or len(v) != dimensions or any(c is None or not math.isfinite(c) for c in v):
            continue
        whole = [max(-centroids.LIMIT, min(centroids.LIMIT, math.floor(1024 * float(np.float32(c))))) for c in v]
        kept.append((i, whole))
    name = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest() for i, _ in kept]
    first = sorted(range(len(kept)), key=lambda r: (name[r], np.array(kept[r][1], "<i4").tobytes()))[:k]
    centres = [list(kept[r][1]) for r in first]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
            out.append((min(d), d.index(min(d))))
        return out

    for _ in range(rounds):
        own = assign()
        for j in range(len(centres)):
            mine = [v for (_, v), (_, c) in zip(kept, own) if c == j]
            if mine:
                centres[j] = [sum(col) // len(mine) for col in zip(*mine)]
    own = assign()
    inertia = {j: sum(d for d, c in own if c == j) for j in range(len(centres))}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    out = [(i, c, d, inertia[c], sum(inertia.values()), digests[c]) for (i, _), (d, c) in zip(kept, own)]
    return sorted(out, key=repr)


def result(found):
    return sorted((tuple(r) for r in found.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def cloud(n, dimensions, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 1, (10, dimensions))
    return [(i, (middles[i % 10] + rng.normal(0, spread, dimensions)).tolist()) for i in range(n)]


@pytest.mark.parametrize("bits", [1, 4, 6, 8])
def test_clusters_match_brute_force(spark, bits):
    vectors = cloud(500, 64, 1, 1.0)
    got = centroids.clustered(spark.createDataFrame(rows_of(vectors), SCHEMA), bits=bits)
    assert result(got) == brute(vectors)


def test_odd_vectors(spark):
    """Null, short, long, non-finite, huge and repeated vectors; null and repeated ids."""
    vectors = cloud(60, 64, 2)
    good = vectors[0][1]
    vectors += [(100, None), (101, []), (102, good[:63]), (103, [*good, 0.0]), (104, [None, *good[1:]]), (105, [math.nan, *good[1:]]),
                (106, [math.inf, *good[1:]]), (107, [1e30, -1e30, *good[2:]]), (None, good), (3, good), (3, good), (3, vectors[9][1])]
    vectors += [(200 + i, good) for i in range(300)]
    assert result(centroids.clustered(spark.createDataFrame(rows_of(vectors), SCHEMA))) == brute(vectors)


def test_ties_go_to_the_smaller_number(spark):
    vectors = [(i, [float(i % 4), float(i // 4 % 4)]) for i in range(64)]
    got = centroids.clustered(spark.createDataFrame(rows_of(vectors), SCHEMA), dimensions=2, scale=1, k=5)
    want = []
    for i, c, d, own, total, digest in brute([(i, [x / 1024 for x in v]) for i, v in vectors], 5, 10, 2):
        want.append((i, c, d, own, total, digest))
    assert result(got) == want


def test_few_vectors_and_none(spark):
    vectors = cloud(3, 64, 5)
    assert result(centroids.clustered(spark.createDataFrame(rows_of(vectors), SCHEMA))) == brute(vectors)
    one = spark.createDataFrame(rows_of(vectors[:1]), SCHEMA)
    assert result(centroids.clustered(one)) == brute(vectors[:1])
    assert centroids.clustered(spark.createDataFrame([], SCHEMA)).collect() == []
    assert centroids.clustered(spark.createDataFrame(rows_of([(1, None)]), SCHEMA)).collect() == []


def test_intervals_hold_the_distances():
    rng = np.random.default_rng(4)
    x = rng.integers(-500, 500, (400, 7))
    edges = np.sort(rng.integers(-500, 500, (7, 9)), axis=1)
    edges[:, 0], edges[:, -1] = x.min(0), x.max(0) + 1
    centres = rng.integers(-700, 700, (5, 7))
    middle = rng.integers(-50, 50, 7)
    bounds = centroids.intervals(centroids.cells_of(x, edges), centroids.interval_tables(edges, middle, centres))
    true = centroids.distances(x, centres) - ((x - middle) ** 2).sum(1)[:, None]
    assert (bounds[:, :5] <= true).all() and (true <= bounds[:, 5:]).all()
    one = centroids.decided(bounds)
    assert (one >= 0).any() and (true.argmin(1)[one >= 0] == one[one >= 0]).all()


def test_few_full_vectors_are_fetched(spark):
    """Clear clusters: after the first round hardly any vector is fetched."""
    found = centroids.cluster(spark.createDataFrame(rows_of(cloud(2000, 64, 6, 0.1)), SCHEMA))
    assert found.fetched[0] < 2000 and found.fetched[-1] <= 200  # two centroids share one cluster

"""Centroid clustering over a VA-file: vectors compressed to cells, intervals, few fetches.

The vectors are stored once, each with a byte per dimension that names the cell its component
falls in. A round reads the cells only: per dimension a table gives, for every cell and
centroid, the least and greatest share in their distance, and their sums bound the distance to
every centroid. A vector needs a look only if these intervals leave more than one centroid
open, or if it moves; only these full vectors are fetched, and only from the bands (partitions
by how clearly the first round decided) that hold any. Cluster sums are kept on the driver
(``k`` x dimensions integers) and change by the vectors that moved. Nothing is written back:
both the last and the present centroids are at hand, so both assignments follow from the row.

All distances, sums and means are exact integers; rounding in the bounds can't occur. Vectors
with another number of components, or a null or non-finite one, are left out (null vectors
too). Integers are held in +-2**27 (a component beyond is set to that bound), so that a
squared distance fits a long. A null id counts as an empty text in the hash; rows with equal
ids are separate vectors, and ties for the first centroids go to the smaller vector. With
fewer vectors than centroids, there are as many centroids as vectors; with none, no rows.
Repeated vectors lie in one cell and cost no more than others. Extra columns take no part.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.text import checkpointed, sized_broadcast, small_partitions
from loomline.operators.groups import ensure_checkpoint_dir

K, ROUNDS, DIMENSIONS, SEED = 8, 10, 64, 3
# Integers per unit of a component, and the bound of an integer.
SCALE, LIMIT = 1024, 1 << 27
# Bits of a cell: at most eight.
BITS = 8
# Bands by the share of the distance that decides between the two nearest first centroids.
BANDS, BAND_WIDTH = 8, 0.02
# Vectors that a task works on at once.
ROWS = 4096


@dataclass
class Clustering:
    """Centroids, in order, and what it took: fetched vectors per round."""

    centroids: np.ndarray  # (k, dimensions) int64
    vectors: DataFrame  # (row, vec_id, x, cells, band), stored
    fetched: list[int] = field(default_factory=list)


def _integers(dimensions: int, scale: int):
    def convert(batches):
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            column = column.cast(pa.list_(pa.float64()))
            lengths = np.asarray(column.value_lengths().fill_null(-1))
            right = np.flatnonzero(lengths == dimensions)
            taken = column.take(pa.array(right))
            flat = taken.flatten()
            x = np.asarray(flat.fill_null(float("nan"))).reshape(-1, dimensions)
            good = np.isfinite(x).all(axis=1)
            with np.errstate(over="ignore"):
                whole = np.clip(np.floor(x[good] * float(scale)), -LIMIT, LIMIT).astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(right[good])), pa.array([v.tobytes() for v in whole], pa.binary())], names=["vec_id", "x"]
            )

    return convert


def integers(embeddings: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``(vec_id, x)`` of the vectors kept; ``x`` holds ``floor(scale * component)`` as 32-bit integers."""
    kept = small_partitions(embeddings).select("vec_id", F.col("embedding").cast("array<double>"))
    return kept.mapInArrow(_integers(dimensions, scale), "vec_id bigint, x binary")


def _vectors(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype="<i4").reshape(len(rows), -1).astype(np.int64)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances ``(n, k)``, exact."""
    out = np.empty((len(x), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        d = x - c
        out[:, j] = np.einsum("ij,ij->i", d, d)
    return out


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hash, in its order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.orderBy(key, "x").limit(k).collect()
    return np.array([np.frombuffer(r.x, dtype="<i4") for r in rows], dtype=np.int64)


def cell_edges(vectors: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges ``(dimensions, cells + 1)``, the range of every dimension cut evenly over three deviations, and the middle.

    Cell ``j`` holds integers from ``edges[j]`` up to, not including, ``edges[j + 1]``.
    """

    def moments(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _vectors(batch.column(0))
            n, d = x.shape
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(d)), pa.array([n] * d), pa.array(x.min(0)), pa.array(x.max(0)),
                 pa.array(x.sum(0).astype(float)), pa.array((x.astype(float) ** 2).sum(0))],
                names=["d", "n", "least", "most", "s", "ss"],
            )

    parts = vectors.select("x").mapInArrow(moments, "d bigint, n bigint, least bigint, most bigint, s double, ss double")
    rows = parts.groupBy("d").agg(F.sum("n"), F.min("least"), F.max("most"), F.sum("s"), F.sum("ss")).orderBy("d").collect()
    cells = 1 << bits
    edges, middle = np.empty((len(rows), cells + 1), np.int64), np.empty(len(rows), np.int64)
    for d, n, least, most, s, ss in rows:
        mean, deviation = s / n, max(ss / n - (s / n) ** 2, 0.0) ** 0.5
        inner = np.floor(mean + deviation * np.linspace(-3, 3, cells - 1)).astype(np.int64)
        edges[d, 0], edges[d, -1], middle[d] = least, most + 1, round(mean)
        edges[d, 1:-1] = np.clip(inner, least, most + 1)
    return edges, middle


def cells_of(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    out = np.empty(x.shape, np.uint8)
    for d in range(x.shape[1]):
        out[:, d] = np.searchsorted(edges[d, 1:-1], x[:, d], "right")
    return out


def interval_tables(edges: np.ndarray, middle: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """``(dimensions, cells, 2k)``: a cell's least, then its greatest share in the distance to each centroid.

    Shares leave out the vector's own squared length from the middle, which all its distances
    have in common: what is left, ``c * c - 2 * x * c``, varies far less inside a cell.
    """
    low, high = (edges[:, :-1] - middle[:, None])[:, :, None], (edges[:, 1:] - 1 - middle[:, None])[:, :, None]
    c = (centroids - middle).T[:, None, :]
    ends = c * c - 2 * low * c, c * c - 2 * high * c
    return np.concatenate([np.minimum(*ends), np.maximum(*ends)], axis=2)


def intervals(cells: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """``(n, 2k)``: bounds of the distances less what they have in common, least ones first."""
    out = np.zeros((len(cells), tables.shape[2]), np.int64)
    for d in range(cells.shape[1]):
        out += tables[d].take(cells[:, d], axis=0)
    return out


def decided(bounds: np.ndarray) -> np.ndarray:
    """The only centroid that the intervals leave, or -1 where several overlap (ties too)."""
    k = bounds.shape[1] // 2
    low, high = bounds[:, :k], bounds[:, k:]
    best = high.argmin(axis=1)
    rows = np.arange(len(bounds))
    others = low.copy()
    others[rows, best] = np.iinfo(np.int64).max
    return np.where(others.min(axis=1) > high[rows, best], best, -1)


def _placed(edges: np.ndarray, centroids: np.ndarray):
    """Full vectors with their cells, their first cluster and its band."""

    def place(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = _vectors(part.column(1))
                d = distances(x, centroids)
                cluster = d.argmin(axis=1)
                two = np.partition(d, 1, axis=1)[:, :2].astype(float) if d.shape[1] > 1 else np.ones((len(d), 2)) * [0, 1]
                clear = (two[:, 1] - two[:, 0]) / np.maximum(two.sum(axis=1), 1)
                band = np.minimum(clear / BAND_WIDTH, BANDS - 1).astype(np.int32)
                cells = cells_of(x, edges)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([c.tobytes() for c in cells], pa.binary()), pa.array(cluster.astype(np.int32)), pa.array(band)],
                    names=["vec_id", "x", "cells", "first", "band"],
                )

    return place


def _sums(k: int, dimensions: int, labels):
    """Counts and sums per cluster of a partition; ``labels(batch, x)`` gives ``(cluster, sign)`` arrays."""

    def add(batches):
        counts, totals = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = _vectors(part.column(0))
                for cluster, sign in labels(part, x):
                    for j in range(k):
                        mine = (cluster == j) * sign
                        counts[j] += mine.sum()
                        totals[j] += mine @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(k), pa.int32()), pa.array(counts), pa.array(list(totals), pa.list_(pa.int64()))], names=["cluster", "n", "totals"]
        )

    return add


def _gathered(parts: DataFrame, k: int, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts and sums over all partial sums: ``k`` x dimensions numbers."""
    counts, totals = np.zeros(k, dtype=object), np.zeros((k, dimensions), dtype=object)
    each = parts.select("cluster", "n", F.posexplode("totals").alias("d", "t"))
    rows = each.groupBy("cluster", "d").agg(F.sum("n").alias("n"), F.sum(F.col("t").cast("decimal(38,0)")).alias("t"))
    for r in rows.collect():
        counts[r.cluster] = int(r.n)
        totals[r.cluster, r.d] = int(r.t)
    return counts, totals


_PARTIAL = "cluster int, n bigint, totals array<bigint>"


def _means(counts: np.ndarray, totals: np.ndarray, old: np.ndarray) -> np.ndarray:
    return np.array([[int(t) // int(n) for t in row] if n else c for n, row, c in zip(counts, totals, old.tolist())], dtype=np.int64)


def cluster(
    embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED, bits: int = BITS,
) -> Clustering | None:
    """Centroids after ``rounds`` rounds of assignment and means; ``None`` without vectors.

    The stored vectors come in ``BANDS`` partitions; ``fetched`` counts the full vectors that
    each round after the first read.
    """
    source = integers(embeddings, dimensions, scale)
    centroids = first_centroids(source, k, seed)
    if not len(centroids):
        return None
    k = len(centroids)
    edges, middle = cell_edges(source, bits)
    spark = embeddings.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/loomline/{uuid.uuid4().hex}"
    placed = source.mapInArrow(_placed(edges, centroids), "vec_id bigint, x binary, cells binary, first int, band int")
    placed.select(F.monotonically_increasing_id().alias("row"), "*").write.partitionBy("band").parquet(path)
    stored = spark.read.schema("row bigint, vec_id bigint, x binary, cells binary, first int, band int").parquet(path)
    out = Clustering(centroids, stored)
    if not rounds:
        return out

    def first_cluster(part, x):
        yield np.asarray(part.column(1)), np.ones(len(x), np.int64)

    counts, totals = _gathered(stored.select("x", "first").mapInArrow(_sums(k, dimensions, first_cluster), _PARTIAL), k, dimensions)
    last, centroids = centroids, _means(counts, totals, centroids)
    for _ in range(rounds - 1):
        if (last == centroids).all():
            break  # every further round gives the same
        need = checkpointed(stored.select("row", "band", "cells").mapInArrow(_open(edges, middle, last, centroids), "row bigint, band int"))
        bands = [(r.band, r.n) for r in need.groupBy("band").agg(F.count(F.lit(1)).alias("n")).collect()]
        out.fetched.append(sum(n for _, n in bands))
        full = stored.where(F.col("band").isin([b for b, _ in bands])).select("row", "x")
        fetched = full.join(sized_broadcast(need.select("row")), "row").select("x")
        dn, dt = _gathered(fetched.mapInArrow(_moves(k, dimensions, last, centroids), _PARTIAL), k, dimensions)
        counts, totals = counts + dn, totals + dt
        last, centroids = centroids, _means(counts, totals, centroids)
    out.centroids = centroids
    return out


def _open(edges: np.ndarray, middle: np.ndarray, last: np.ndarray, present: np.ndarray):
    """Rows whose intervals overlap under either centroids, or that move from one cluster to another."""
    tables = np.concatenate([interval_tables(edges, middle, c) for c in (last, present)], axis=2)
    width = 2 * len(last)

    def look(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows = part.column(2).to_pylist()
                cells = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
                bounds = intervals(cells, tables)
                before, after = decided(bounds[:, :width]), decided(bounds[:, width:])
                want = pa.array(np.flatnonzero((before < 0) | (before != after)))
                yield pa.RecordBatch.from_arrays([part.column(0).take(want), part.column(1).take(want)], names=["row", "band"])

    return look


def _moves(k: int, dimensions: int, last: np.ndarray, present: np.ndarray):
    def labels(part, x):
        before, after = distances(x, last).argmin(axis=1), distances(x, present).argmin(axis=1)
        moved = (before != after).astype(np.int64)
        yield before, -moved
        yield after, moved

    return _sums(k, dimensions, labels)


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(c)) for c in centroid).encode()).hexdigest()


def assigned(found: Clustering) -> DataFrame:
    """``(vec_id, cluster, distance)`` of every stored vector under the last centroids.

    The exact distance is part of the result, so this reads every full vector once.
    """
    centroids = found.centroids

    def assign(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                d = distances(_vectors(part.column(1)), centroids)
                best = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(best.astype(np.int32)), pa.array(d[np.arange(len(d)), best])], names=["vec_id", "cluster", "distance"]
                )

    return found.vectors.select("vec_id", "x").mapInArrow(assign, "vec_id bigint, cluster int, distance bigint")


def clustered(embeddings: DataFrame, **options) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every vector kept.

    Options are those of ``cluster``. Inertias beyond a long are null.
    """
    found = cluster(embeddings, **options)
    spark = embeddings.sparkSession
    if found is None:
        return spark.createDataFrame(
            [], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        )
    rows = checkpointed(assigned(found))
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r.cluster: int(r.s) for r in rows.groupBy("cluster").agg(exact.alias("s")).collect()}

    def fits(value: int) -> int | None:
        return value if value < 1 << 63 else None

    facts = spark.createDataFrame(
        [(j, fits(s), fits(sum(sums.values())), digest(found.centroids[j])) for j, s in sorted(sums.items())],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

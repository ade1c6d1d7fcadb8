"""A saved vector index: cells as partitions, product-quantized codes, exact re-ranking.

Vectors are dealt to cells by their nearest centre and stored as Parquet partitioned by cell;
each also has a short code: its offset from the centre is cut into parts, each named by the
nearest of at most 256 code words. A search reads only item ids and codes, and only of the
cells that some query probes (dynamic partition pruning): a table of the distances from the
query to every code word gives each item's approximate distance by a few look-ups. The best
``rerank`` items of a query are then compared with their full vectors, read from the same
cells. Centres and code words are fitted on a sample bounded by ``sample_rows``; every vector
is indexed. Null vectors and vectors with a null or non-finite value are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions import scalar as S
from loomline.operators.groups import BROADCAST_BYTES, CELL_BYTES, checkpointed, top_k
from loomline.sources.sinks import read_json_row, write_json_row

SAMPLE_ROWS = 65_536
CODE_WORDS = 256
# Rows of a cell per file and task; larger cells are cut by a hash of the item.
PART_ROWS = 200_000
# Items of a cell that a query is compared with at once, and queries that meet a part of a cell.
TILE_ROWS = 4096
# Queries whose tables of distances a task holds at once: a table has (words x dimensions) values while it is made.
TABLE_ROWS = 32


@dataclass
class IndexModel:
    """Cell centres ``(cells, dim)`` and code words ``(parts, words, dim / parts)``."""

    centres: np.ndarray
    words: np.ndarray

    def offsets(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's cell and its offset from the centre, padded to whole parts."""
        cell = nearest_rows(x, self.centres)
        return cell, _padded(x - self.centres[cell], self.words)

    def codes(self, offsets: np.ndarray) -> np.ndarray:
        width = self.words.shape[2]
        parts = [nearest_rows(offsets[:, j * width : (j + 1) * width], w) for j, w in enumerate(self.words)]
        return np.stack(parts, axis=1).astype(np.uint8)

    def probes(self, q: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` cells nearest to each query."""
        return np.argsort(_distances(q, self.centres), axis=1, kind="stable")[:, :n]

    def tables(self, q: np.ndarray, cell: int) -> np.ndarray:
        """``(queries, parts, words)``: squared distances from each query's offset to the code words."""
        width = self.words.shape[2]
        offset = _padded(q - self.centres[cell], self.words).reshape(len(q), len(self.words), 1, width)
        return ((offset - self.words[None]) ** 2).sum(axis=3)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * x @ y.T


def _padded(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, words.shape[0] * words.shape[2] - x.shape[1])))


def nearest_rows(x: np.ndarray, centres: np.ndarray, step: int = 8192) -> np.ndarray:
    """For each row of ``x`` the nearest row of ``centres``."""
    return np.concatenate([np.zeros(0, np.int64)] + [_distances(x[i : i + step], centres).argmin(1) for i in range(0, len(x), step)])


def fitted_centres(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Means after a few rounds of assignment; a centre that loses all its rows moves to the farthest row."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = nearest_rows(x, centres)
        count = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
        empty = np.flatnonzero(count == 0)
        if len(empty):
            far = ((x - centres[own]) ** 2).sum(1)
            centres[empty] = x[np.argsort(-far, kind="stable")[: len(empty)]]
    return centres


def usable(df: DataFrame, key: str) -> DataFrame:
    """``key`` and ``embedding`` (doubles) of rows whose vector is whole and finite."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < float("inf")))  # nan is greater than any number
    return df.select(key, x.alias("embedding")).where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite)


def fit_index(
    corpus: DataFrame, n_cells: int, n_parts: int = 16, sample_rows: int = SAMPLE_ROWS, rounds: int = 10, seed: int = 42,
) -> IndexModel:
    """Centres and code words from at most ``sample_rows`` rows, chosen by a hash of the item."""
    rows = usable(corpus, "item_id")
    total = rows.count()
    if not total:
        raise ValueError("no vectors to index")
    share = math.ceil(1_000_000 * min(1.0, 0.9 * sample_rows / total))
    sample = rows.where(S.md5_long(F.lit(str(seed)), "item_id") % 1_000_000 < share).limit(sample_rows).select("embedding").collect()
    if not sample:
        sample = rows.limit(sample_rows).select("embedding").collect()
    x = np.array([r[0] for r in sample])
    centres = fitted_centres(x, n_cells, rounds, seed)
    width = math.ceil(x.shape[1] / n_parts)
    words = np.zeros((math.ceil(x.shape[1] / width), min(CODE_WORDS, len(x)), width))
    left = _padded(x - centres[nearest_rows(x, centres)], words)
    for j in range(len(words)):
        words[j] = fitted_centres(left[:, j * width : (j + 1) * width], words.shape[1], rounds, seed + j)
    return IndexModel(centres, words)


def write_index(corpus: DataFrame, model: IndexModel, folder: str) -> None:
    """Store every vector with its cell and code, partitioned by cell, and the model beside them."""
    rows = usable(corpus, "item_id")
    kind, vector = (corpus.schema[c].dataType.simpleString() for c in ("item_id", "embedding"))

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if pdf.empty:
                continue
            cell, offsets = model.offsets(np.stack(pdf["embedding"].to_list()))
            yield pdf.assign(cell=cell.astype(np.int32), code=[c.tobytes() for c in model.codes(offsets)])

    coded = rows.mapInPandas(encode, f"item_id {kind}, embedding array<double>, cell int, code binary")
    coded = coded.withColumn("embedding", F.col("embedding").cast(vector))  # as exact as it came
    parts = max(1, math.ceil(rows.count() / PART_ROWS / 4))  # at most so many files per cell
    salted = coded.repartition(F.col("cell"), F.pmod(F.xxhash64("item_id"), F.lit(parts)))
    salted.write.mode("overwrite").partitionBy("cell").parquet(f"{folder}/cells.parquet")
    write_json_row(rows.sparkSession, {
        "centres": model.centres.tolist(), "words": model.words.tolist(), "item_id": kind, "embedding": vector,
    }, f"{folder}/index.json")


def load_index(spark: SparkSession, folder: str) -> tuple[DataFrame, IndexModel]:
    """The stored vectors ``(item_id, embedding, code, cell)`` and the model."""
    config = read_json_row(spark, f"{folder}/index.json")
    schema = f"item_id {config['item_id']}, embedding {config['embedding']}, code binary, cell int"
    return spark.read.schema(schema).parquet(f"{folder}/cells.parquet"), IndexModel(np.array(config["centres"]), np.array(config["words"]))


def _best_codes(model: IndexModel, cell: int, qids, q: np.ndarray, ids: np.ndarray, codes: np.ndarray, rerank: int) -> Iterator[pd.DataFrame]:
    """Per query the ``rerank`` items of a cell with the least approximate distance; one frame per ``TABLE_ROWS`` queries."""
    parts = np.arange(codes.shape[1])
    for first in range(0, len(q), TABLE_ROWS):
        found = []
        for table in model.tables(q[first : first + TABLE_ROWS], cell):
            rough = np.concatenate([table[parts, codes[lo : lo + TILE_ROWS]].sum(1) for lo in range(0, len(codes), TILE_ROWS)])
            best = np.lexsort((ids, rough))[:rerank] if len(rough) <= rerank else np.argpartition(rough, rerank - 1)[:rerank]
            found.append((ids[best], rough[best]))
        yield pd.DataFrame({
            "query_id": np.repeat(np.asarray(qids[first : first + TABLE_ROWS]), [len(f[0]) for f in found]),
            "item_id": np.concatenate([f[0] for f in found]), "cell": cell, "rough": np.concatenate([f[1] for f in found]),
        })


def _matrix(codes: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)


def candidates(
    index: DataFrame, model: IndexModel, queries: DataFrame, n_probe: int, rerank: int, max_broadcast: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(query_id, item_id, cell, rough)``: per query the ``rerank`` best items of the probed cells by code.

    Queries whose counted size is within ``max_broadcast`` travel to the cells. Larger sets
    meet them in a cogroup on (cell, part), in tiles; both give the same kind of rows.
    """
    asked = usable(queries, "query_id")
    spark = index.sparkSession
    q_kind, i_kind = asked.schema["query_id"].dataType, index.schema["item_id"].dataType
    schema = T.StructType([
        T.StructField("query_id", q_kind), T.StructField("item_id", i_kind), T.StructField("cell", T.IntegerType()), T.StructField("rough", T.DoubleType()),
    ])

    def probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if not pdf.empty:
                yield pdf.assign(cell=list(model.probes(np.stack(pdf["embedding"].to_list()), n_probe).astype(np.int32)))

    probed = asked.mapInPandas(probe, T.StructType([*asked.schema.fields, T.StructField("cell", T.ArrayType(T.IntegerType()))]))
    probed = checkpointed(probed.select("query_id", "embedding", F.explode("cell").alias("cell")))
    wanted = probed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))  # at most one row per cell
    codes = index.select("item_id", "code", "cell").join(F.broadcast(wanted.where("n > 0").select("cell")), "cell")
    n, dim = probed.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    if not n:
        return spark.createDataFrame([], schema)
    if n * dim * 8 <= max_broadcast:
        by_cell = {}
        for r in probed.orderBy("cell", "query_id").collect():  # size checked
            by_cell.setdefault(r.cell, ([], []))
            by_cell[r.cell][0].append(r.query_id)
            by_cell[r.cell][1].append(r.embedding)
        shared = spark.sparkContext.broadcast({c: (ids, np.array(x)) for c, (ids, x) in by_cell.items()})

        def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                for cell, rows in pdf.groupby("cell"):
                    qids, q = shared.value[cell]
                    yield from _best_codes(model, int(cell), qids, q, rows["item_id"].to_numpy(), _matrix(rows["code"]), rerank)

        found = codes.mapInPandas(look, schema)
    else:
        sizes = codes.groupBy("cell").agg(F.count(F.lit(1)).alias("_rows"))
        parts = checkpointed(wanted.join(sizes, "cell").select(
            "cell", F.ceil(F.col("_rows") / PART_ROWS).alias("_parts"), F.ceil(F.col("n") / TILE_ROWS).alias("_tiles")
        ))  # one row per cell
        left = codes.join(F.broadcast(parts), "cell").select(
            "cell", "item_id", "code", (S.md5_long("item_id") % F.col("_parts")).alias("_part"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_tiles") - 1)).alias("_tile"),
        )
        right = probed.join(F.broadcast(parts), "cell").select(
            F.col("cell").alias("_cell"), "query_id", "embedding", (S.md5_long("query_id") % F.col("_tiles")).alias("_of"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)).alias("_with"),
        )

        def meet(items: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            if items.empty or asked.empty:
                return pd.DataFrame({c: [] for c in schema.names})
            cell = int(items["cell"].iloc[0])
            q = np.stack(asked["embedding"].to_list())
            return pd.concat(_best_codes(model, cell, asked["query_id"].to_list(), q, items["item_id"].to_numpy(), _matrix(items["code"]), rerank))

        found = left.groupBy("cell", "_part", "_tile").cogroup(right.groupBy("_cell", "_with", "_of")).applyInPandas(meet, schema)
    best = top_k(found, ["query_id"], [F.col("rough"), F.col("item_id")], rerank, "_place")
    return best.drop("_place")


def search_index(
    index: DataFrame, model: IndexModel, queries: DataFrame, k: int, n_probe: int, rerank: int,
    max_broadcast: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(query_id, item_id, _distance, rank)``: the ``k`` nearest by exact squared distance among the best by code."""
    near = checkpointed(candidates(index, model, queries, n_probe, rerank, max_broadcast))
    cells = near.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    pairs = near.select("query_id", "item_id", "cell").distinct()
    small = near.count() * 3 * CELL_BYTES <= max_broadcast
    vectors = index.select("item_id", "cell", F.col("embedding").alias("_x")).join(F.broadcast(cells.where("n > 0").select("cell")), "cell")
    met = vectors.join(F.broadcast(pairs) if small else pairs, ["cell", "item_id"])
    asked = usable(queries, "query_id").withColumnRenamed("embedding", "_q")
    met = met.join(asked, "query_id").select("query_id", "item_id", "_x", "_q")

    def exact(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if not pdf.empty:
                d = np.stack(pdf["_x"].to_list()).astype(np.float64) - np.stack(pdf["_q"].to_list())
                yield pdf[["query_id", "item_id"]].assign(_distance=(d * d).sum(1))

    schema = T.StructType([met.schema["query_id"], met.schema["item_id"], T.StructField("_distance", T.DoubleType())])
    return top_k(met.mapInPandas(exact, schema), ["query_id"], [F.col("_distance"), F.col("item_id")], k)

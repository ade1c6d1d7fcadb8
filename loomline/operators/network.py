"""A ReLU network trained by minibatch Adam over blocks of rows.

Rows are dealt to minibatches and, inside these, to blocks by a hash of their key, and stored
once, partitioned by minibatch; a block's rows are in key order. A step reads one partition:
each block gives its gradient in one Arrow row, the few of a minibatch are added on the
driver in block order, and the next step's weights travel with its tasks. So the result does
not depend on how rows or tasks are distributed, and a lost executor only repeats a block.
What reaches the driver per step is bounded by the minibatch and the network, not by the data.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions import scalar as S
from loomline.operators.groups import ensure_checkpoint_dir, remove_stored
from loomline.sources.sinks import read_json_row, write_json_row

# Fixed values.
DEFAULTS = {"hidden_dim": 64, "epochs": 50, "lr": 1e-3, "batch_size": 4096, "seed": 42}
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8
# Rows of a block, which gives one gradient; the driver adds up this many gradients of a step at most.
BLOCK_ROWS = 1024
DRIVER_ROWS = 64

Weights = list[tuple[np.ndarray, np.ndarray]]


def initial(sizes: Sequence[int], seed: int) -> Weights:
    """Weights and biases per layer, uniform within one over the root of the layer's inputs."""
    rng = np.random.default_rng(seed)
    out = []
    for n_in, n_out in zip(sizes, sizes[1:]):
        bound = 1.0 / math.sqrt(n_in)
        out.append((rng.uniform(-bound, bound, (n_in, n_out)), rng.uniform(-bound, bound, n_out)))
    return out


def forward(weights: Weights, x: np.ndarray) -> list[np.ndarray]:
    """The input and the output of every layer; the last one are log probabilities."""
    layers = [x]
    for i, (w, b) in enumerate(weights):
        z = layers[-1] @ w + b
        layers.append(np.maximum(z, 0.0) if i < len(weights) - 1 else z)
    z = layers[-1] - layers[-1].max(axis=1, keepdims=True)
    layers[-1] = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
    return layers


def gradient(weights: Weights, x: np.ndarray, y: np.ndarray) -> tuple[float, Weights]:
    """Summed cross entropy of the rows and its gradient."""
    layers = forward(weights, x)
    rows = np.arange(len(y))
    loss = -float(layers[-1][rows, y].sum())
    delta = np.exp(layers[-1])
    delta[rows, y] -= 1.0
    out: Weights = []
    for i in range(len(weights) - 1, -1, -1):
        out.append((layers[i].T @ delta, delta.sum(axis=0)))
        if i:
            delta = (delta @ weights[i][0].T) * (layers[i] > 0)
    return loss, out[::-1]


def flat(weights: Weights) -> np.ndarray:
    return np.concatenate([part.ravel() for pair in weights for part in pair])


def shaped(values: np.ndarray, sizes: Sequence[int]) -> Weights:
    out, at = [], 0
    for n_in, n_out in zip(sizes, sizes[1:]):
        w = values[at : at + n_in * n_out].reshape(n_in, n_out)
        at += n_in * n_out
        out.append((w, values[at : at + n_out]))
        at += n_out
    return out


@dataclass
class Network:
    """A fitted network: feature order, scaling, layer sizes and all weights in one row."""

    features: list[str]
    mean: list[float]
    deviation: list[float]
    sizes: list[int]
    values: list[float]
    params: dict
    losses: list[float] = field(default_factory=list)  # mean training loss per epoch

    def scaled(self, rows) -> np.ndarray:
        """Features as scaled numbers; null and NaN become the mean."""
        x = (np.array(list(rows), dtype=np.float64).reshape(len(rows), -1) - np.array(self.mean)) / np.array(self.deviation)
        return np.nan_to_num(x, nan=0.0, posinf=0.0, neginf=0.0)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probabilities`` and ``prediction`` (the first most probable class)."""
        @F.pandas_udf("array<double>")
        def score(rows: pd.Series) -> pd.Series:
            return pd.Series(list(np.exp(forward(shaped(np.array(self.values), self.sizes), self.scaled(rows))[-1])))

        x = F.array(*[F.col(c).cast("double") for c in self.features])
        scored = df.withColumn("_x", x).withColumn("probabilities", score("_x")).drop("_x")
        return scored.withColumn("prediction", (F.array_position("probabilities", F.array_max("probabilities")) - 1).cast("double"))

    def save(self, spark: SparkSession, folder: str) -> None:
        write_json_row(spark, vars(self), f"{folder}/network.json")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Network:
        return Network(**read_json_row(spark, f"{folder}/network.json"))


def _scaling(df: DataFrame, features: Sequence[str]) -> tuple[list[float], list[float]]:
    finite = [F.when(F.abs(F.col(c)) < float("inf"), F.col(c).cast("double")) for c in features]
    row = df.agg(*[F.avg(c) for c in finite], *[F.stddev_pop(c) for c in finite]).first()
    n = len(features)
    # a rounded scale is the same however the sums were ordered
    mean = [float(f"{v or 0.0:.9g}") for v in row[:n]]
    return mean, [float(f"{v:.9g}") if v else 1.0 for v in row[n:]]


def fit_network(
    df: DataFrame, features: Sequence[str], key: Sequence[str], n_classes: int, label: str = "target", params: dict | None = None,
) -> Network:
    """Fit a classifier with two hidden layers, the second half as wide as the first.

    ``key`` identifies rows: it decides their minibatch and their place in it. Rows with a
    null label are left out; labels are 0 .. ``n_classes`` - 1.
    """
    p = DEFAULTS | (params or {})
    unknown = set(p) - set(DEFAULTS)
    if unknown:
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    features, hidden = list(features), int(p["hidden_dim"])
    df = df.where(F.col(label).isNotNull())
    n = df.count()
    if not n:
        raise ValueError("no labelled rows to learn from")
    sizes = [len(features), hidden, max(1, hidden // 2), n_classes]
    weights = initial(sizes, int(p["seed"]))
    model = Network(features, *_scaling(df, features), sizes, flat(weights).tolist(), p)
    batches = math.ceil(n / int(p["batch_size"]))
    per_batch = math.ceil(n / batches / BLOCK_ROWS)
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/loomline/{uuid.uuid4().hex}"
    _stored_blocks(df, model, key, label, batches, per_batch).write.partitionBy("batch").parquet(path)
    blocks = spark.read.schema("block int, x binary, y binary, batch int").parquet(path)
    values = flat(weights)
    first, second = np.zeros_like(values), np.zeros_like(values)
    rng, step = np.random.default_rng(int(p["seed"])), 0
    for _ in range(int(p["epochs"])):
        total = 0.0
        for batch in rng.permutation(batches).tolist():
            loss, rows, slope = _batch_gradient(blocks.where(F.col("batch") == batch), sizes, values, per_batch)
            if not rows:
                continue
            step, total, slope = step + 1, total + loss, slope / rows
            first = BETA1 * first + (1 - BETA1) * slope
            second = BETA2 * second + (1 - BETA2) * slope**2
            values = values - float(p["lr"]) * (first / (1 - BETA1**step)) / (np.sqrt(second / (1 - BETA2**step)) + EPSILON)
        model.losses.append(total / n)
    remove_stored(spark, path)
    model.values = values.tolist()
    return model


def _stored_blocks(df: DataFrame, model: Network, key: Sequence[str], label: str, batches: int, per_batch: int) -> DataFrame:
    seed = F.lit(str(model.params["seed"]))
    rows = df.select(
        F.array(*[F.col(c).cast("double") for c in model.features]).alias("x"), F.col(label).cast("int").alias("y"),
        (S.md5_long(F.lit("batch"), seed, *key) % batches).cast("int").alias("batch"),
        (S.md5_long(F.lit("block"), seed, *key) % per_batch).cast("int").alias("block"), S.md5_long(F.lit("order"), seed, *key).alias("place"),
    )

    def pack(at, pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = model.scaled(pdf["x"]), pdf["y"].to_numpy(np.int64)
        order = np.lexsort((*x.T, y, pdf["place"].to_numpy()))  # rows of one key in the order of their values
        return pd.DataFrame({"batch": [at[0]], "block": [at[1]], "x": [x[order].tobytes()], "y": [y[order].tobytes()]})

    return rows.groupBy("batch", "block").applyInPandas(pack, "batch int, block int, x binary, y binary")


def _batch_slopes(blocks: DataFrame, sizes: Sequence[int], values: np.ndarray, per_batch: int) -> DataFrame:
    """Loss, rows and summed gradient of a minibatch in at most ``DRIVER_ROWS`` rows.

    More blocks are added up on the executors, by number, so that the sums do not depend on partitions.
    """
    weights = shaped(values, sizes)

    def slopes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for block, x, y in zip(pdf["block"], pdf["x"], pdf["y"]):
                labels = np.frombuffer(y, np.int64)
                loss, slope = gradient(weights, np.frombuffer(x, np.float64).reshape(len(labels), -1), labels)
                yield pd.DataFrame({"block": [block], "rows": [len(labels)], "loss": [loss], "slope": [flat(slope).tobytes()]})

    schema = "block int, rows bigint, loss double, slope binary"
    found = blocks.select("block", "x", "y").mapInPandas(slopes, schema)
    if per_batch <= DRIVER_ROWS:
        return found

    def add(at, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        slope = np.zeros_like(values)
        for part in pdf["slope"]:
            slope = slope + np.frombuffer(part, np.float64)
        return pd.DataFrame({"block": [at[0]], "rows": [pdf["rows"].sum()], "loss": [math.fsum(pdf["loss"])], "slope": [slope.tobytes()]})

    return found.groupBy((F.col("block") % DRIVER_ROWS).alias("part")).applyInPandas(add, schema)


def _batch_gradient(blocks: DataFrame, sizes: Sequence[int], values: np.ndarray, per_batch: int) -> tuple[float, int, np.ndarray]:
    """Loss, rows and summed gradient of a minibatch of ``per_batch`` blocks."""
    found = _batch_slopes(blocks, sizes, values, per_batch).collect()
    loss, rows, total = 0.0, 0, np.zeros_like(values)
    for r in sorted(found, key=lambda r: r.block):
        loss, rows, total = loss + r.loss, rows + r.rows, total + np.frombuffer(r.slope, np.float64)
    return loss, rows, total

"""Exact classification, regression and ranking metrics as aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.operators.groups import lookup_join, with_running_sum


def _div(num: Column, den: Column) -> Column:
    """Ratio with 0/0 read as 0."""
    return F.when(den != 0, num / den).otherwise(F.lit(0.0))


# --- classification ------------------------------------------------------------------------

def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def class_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class seen as label or prediction."""
    cells = confusion_matrix(df, label, prediction)
    hit = F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(F.lit(0))
    # each cell counts once towards its label and once towards its prediction
    sides = F.array(
        F.struct(F.col(label).alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"), hit.alias("hits")),
        F.struct(F.col(prediction).alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("hits")),
    )
    per_class = (
        cells.select(F.explode(sides).alias("s")).select("s.*").groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
    )
    precision = _div(F.col("hits"), F.col("predicted"))
    recall = _div(F.col("hits"), F.col("support"))
    per_class = per_class.withColumns({"precision": precision, "recall": recall})
    f1 = _div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return per_class.withColumn("f1", f1).select("class", "precision", "recall", "f1", "support", "hits")


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: accuracy, precision, recall, F1, n and the classes.

    With exactly two labels the figures are those of the larger label; otherwise
    they are the unweighted mean over classes.
    """
    per_class = class_metrics(df, label, prediction)
    in_labels = F.col("support") > 0
    total = per_class.agg(
        (F.sum("hits") / F.sum("support")).alias("validation_accuracy"),
        F.count_if(in_labels).alias("_n_labels"),
        *[F.max_by(m, F.when(in_labels, F.col("class"))).alias(f"_top_{m}") for m in ("precision", "recall", "f1")],
        *[F.avg(m).alias(f"_mean_{m}") for m in ("precision", "recall", "f1")],
        F.sum("support").alias("n_test"),
        F.concat_ws(",", F.transform(
            F.array_sort(F.collect_list(F.when(in_labels, F.col("class")))), lambda c: c.cast("string")
        )).alias("classes"),
    )
    binary = F.col("_n_labels") == 2
    return total.select(
        "validation_accuracy",
        *[F.when(binary, F.col(f"_top_{m}")).otherwise(F.col(f"_mean_{m}")).alias(m) for m in ("precision", "recall", "f1")],
        F.when(binary, "binary").otherwise("macro").alias("averaging"),
        "n_test", "classes",
    )


def _score_steps(df: DataFrame, keys: Sequence[str], label: str, score: str, descending: bool) -> DataFrame:
    """Positives and negatives per distinct score with their running totals.

    The larger label is the positive one; of a single label, 1 is.
    """
    rows = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    ends = rows.agg(F.min(label).alias("_low"), F.max(label).alias("_top"))  # one row
    positive = (F.col(label) == F.col("_top")) & ((F.col("_top") != F.col("_low")) | (F.col(label) == 1))
    counts = rows.crossJoin(F.broadcast(ends)).groupBy(*keys, score).agg(
        F.count_if(positive).alias("_pos"), F.count_if(~positive).alias("_neg")
    )
    order = F.desc(score) if descending else F.asc(score)
    return with_running_sum(counts, keys, [order], {"_cum_pos": "_pos", "_cum_neg": "_neg"})


def roc_auc(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, tied scores counting half; null with one class.

    Rows are first counted per distinct score, then every positive is credited
    with the negatives ranked below it. With ``keys`` one value per group.
    """
    keys = list(keys)
    steps = _score_steps(df, keys, label, score, descending=False)
    credit = F.col("_pos") * (F.col("_cum_neg") - F.col("_neg") / F.lit(2.0))
    sums = steps.groupBy(*keys) if keys else steps
    sums = sums.agg(F.sum(credit).alias("_credit"), F.sum("_pos").alias("n_pos"), F.sum("_neg").alias("n_neg"))
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return sums.select(*keys, F.when(pairs > 0, F.col("_credit") / pairs).alias("auc"), "n_pos", "n_neg")


def auc_or_accuracy(df: DataFrame, label: str, score: str, prediction: str) -> DataFrame:
    """``validation_auc`` when both classes occur, else ``validation_accuracy``, as (metric, value)."""
    auc = roc_auc(df, label, score).select("auc")
    acc = accuracy(df, label, prediction)
    rows = auc.select(F.lit("validation_auc").alias("metric"), F.col("auc").alias("value")).unionByName(
        acc.select(F.lit("validation_accuracy").alias("metric"), F.col("accuracy").alias("value"))
    )
    return rows.where(F.col("value").isNotNull()).agg(
        F.max_by("metric", F.col("metric")).alias("metric"), F.max_by("value", F.col("metric")).alias("value")
    )


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row per distinct score used as threshold: counts and rates at or above it."""
    steps = _score_steps(df, [], label, score, descending=True)
    totals = steps.agg(F.sum("_pos"), F.sum("_neg")).first()
    pos, neg = F.lit(totals[0] or 0), F.lit(totals[1] or 0)
    return steps.select(
        F.col(score).alias("threshold"), F.col("_cum_pos").alias("tp"), F.col("_cum_neg").alias("fp"),
        _div(F.col("_cum_pos"), pos).alias("tpr"), _div(F.col("_cum_neg"), neg).alias("fpr"),
    )


def threshold_sweep(df: DataFrame, label: str, score: str) -> DataFrame:
    """Precision, recall and F1 of ``score >= threshold`` at every distinct score."""
    steps = _score_steps(df, [], label, score, descending=True)
    pos = F.lit(steps.agg(F.sum("_pos")).first()[0] or 0)
    precision = F.col("_cum_pos") / (F.col("_cum_pos") + F.col("_cum_neg"))
    out = steps.select(
        F.col(score).alias("threshold"), precision.alias("precision"),
        _div(F.col("_cum_pos"), pos).alias("recall"),
    )
    f1 = _div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return out.withColumn("f1", f1)


def apply_threshold(probability: str | Column, threshold: float) -> Column:
    """Binary decision; a score equal to the threshold is positive."""
    p = F.col(probability) if isinstance(probability, str) else probability
    return (p >= F.lit(threshold)).cast("int")


def feature_auc(df: DataFrame, label: str, features: Sequence[str], limit: float = 0.95) -> DataFrame:
    """AUC of every feature on its own; ``leaks`` marks those above ``limit`` either way round."""
    long = df.select(
        label, F.explode(F.array(*[
            F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features
        ])).alias("_f"),
    ).select(label, "_f.feature", "_f.value")
    per_feature = roc_auc(long, label, "value", ["feature"])
    return per_feature.select(
        "feature", "auc", (F.greatest(F.col("auc"), 1 - F.col("auc")) > F.lit(limit)).alias("leaks")
    )


# --- regression ----------------------------------------------------------------------------

def regression_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """R2, RMSE, MAE, target mean and sample deviation, and n, in one aggregation."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    sums = df.agg(
        F.avg((y - p) * (y - p)).alias("_mse"), F.avg(F.abs(y - p)).alias("mae"),
        F.avg(y).alias("target_mean"), F.stddev_samp(y).alias("target_std"),
        F.var_pop(y).alias("_var"), F.count(y).alias("n_test"),
    )
    r2 = F.when(F.col("_var") > 0, 1 - F.col("_mse") / F.col("_var"))
    r2 = r2.otherwise(F.when(F.col("_mse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return sums.select(
        r2.alias("validation_r2"), F.sqrt("_mse").alias("rmse"), "mae", "target_mean", "target_std", "n_test"
    )


def residuals(df: DataFrame, label: str, prediction: str) -> DataFrame:
    diff = F.col(label) - F.col(prediction)
    return df.withColumns({"residual": diff, "abs_residual": F.abs(diff)})


def residual_summary(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Mean absolute residual and the number of exact matches."""
    diff = F.col(label) - F.col(prediction)
    return df.agg(
        F.avg(F.abs(diff)).alias("mean_abs_residual"), F.count_if(diff == 0).alias("n_match"),
        F.count(F.lit(1)).alias("n"),
    )


# --- ranking -------------------------------------------------------------------------------

def ranking_metrics(recs: DataFrame, truth: DataFrame, k: int, user: str = "user_idx", item: str = "item_idx") -> DataFrame:
    """Recall, precision, hit rate, NDCG and MAP at ``k``, averaged over users with held-out items.

    ``recs`` is (user, item, rank), ranks from 1; users without recommendations count as 0.
    """
    held_out = truth.select(user, item).distinct()
    sizes = held_out.groupBy(user).agg(F.count(F.lit(1)).alias("_n_truth"))
    hits = recs.where(F.col("rank") <= k).select(user, item, "rank").join(held_out, [user, item], "inner")
    # at most k rows per user
    so_far = Window.partitionBy(user).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    hits = hits.withColumn("_hits", F.count(F.lit(1)).over(so_far))
    per_user = hits.groupBy(user).agg(
        F.count(F.lit(1)).alias("_n_hits"),
        F.sum(F.lit(1.0) / F.log2(F.col("rank") + 1)).alias("_dcg"),
        F.sum(F.col("_hits") / F.col("rank")).alias("_ap"),
    )
    table = sizes.join(per_user, user, "left").fillna(0, ["_n_hits"]).fillna(0.0, ["_dcg", "_ap"])
    best = F.least(F.col("_n_truth"), F.lit(k))
    ideal = F.aggregate(
        F.sequence(F.lit(1).cast("bigint"), best), F.lit(0.0), lambda acc, i: acc + F.lit(1.0) / F.log2(i + 1)
    )
    return table.agg(
        F.avg(F.col("_n_hits") / F.col("_n_truth")).alias(f"recall_at_{k}"),
        F.avg(F.col("_n_hits") / F.lit(float(k))).alias(f"precision_at_{k}"),
        F.avg((F.col("_n_hits") > 0).cast("double")).alias(f"hit_rate_at_{k}"),
        F.avg(F.col("_dcg") / ideal).alias(f"ndcg_at_{k}"),
        F.avg(F.col("_ap") / best).alias(f"map_at_{k}"),
        F.count(F.lit(1)).alias("n_entities_evaluated"),
    )


# --- dispatch, gate, parity ----------------------------------------------------------------

def evaluate(task: str, df: DataFrame, label: str = "target", prediction: str = "prediction", **ranking) -> DataFrame:
    """The report for a task: classification, regression or ranking."""
    if task == "classification":
        return classification_report(df, label, prediction)
    if task == "regression":
        return regression_report(df, label, prediction)
    if task == "ranking":
        return ranking_metrics(df, **ranking)
    raise ValueError(f"unknown task: {task}")


def with_gate(metrics: DataFrame, metric: str, threshold: float) -> DataFrame:
    """Add ``passed``: whether the metric reaches the threshold."""
    return metrics.withColumn("passed", F.col(metric) >= F.lit(threshold))


def prediction_parity(a: DataFrame, b: DataFrame, key: str, prediction: str, rtol: float = 1e-5) -> DataFrame:
    """Compare two prediction tables by key: rows matched, largest difference, all within ``rtol``."""
    joined = lookup_join(a.select(key, prediction), b.select(key, F.col(prediction).alias("_other")), [key], "left")
    diff = F.abs(F.col(prediction) - F.col("_other"))
    close = F.coalesce(diff <= F.lit(rtol) * F.abs(F.col("_other")), F.lit(False))
    return joined.agg(
        F.count("_other").alias("n_matched"), F.max(diff).alias("max_abs_diff"), F.min(close).alias("all_close")
    )

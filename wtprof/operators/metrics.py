"""Classification metrics (D6-D8, D10) from one small count table.

Everything starts from ``groupBy(true, pred).count()`` (≤ classes² rows);
per-class figures explode the class list over that small table only.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_counts(df: DataFrame, true_col: str = "label", pred_col: str = "pred") -> DataFrame:
    return df.groupBy(F.col(true_col).alias("actual"), F.col(pred_col).alias("predicted")).agg(
        F.count(F.lit(1)).alias("cnt"))


def _classes(pc: DataFrame) -> DataFrame:
    """Class list (array) of the union of true and predicted labels."""
    return pc.select(F.array_union(F.collect_set("actual"), F.collect_set("predicted")).alias("classes"))


def confusion_matrix(df: DataFrame, true_col: str = "label", pred_col: str = "pred") -> DataFrame:
    """Counts for every (true, pred) pair of known classes, zeros kept.

    The dense grid is generated from the (bounded) class array by two
    explodes of one row, then left-joined to the counts."""
    pc = pair_counts(df, true_col, pred_col)
    grid = (_classes(pc).select(F.explode("classes").alias("actual"), "classes")
            .select("actual", F.explode("classes").alias("predicted")))
    return grid.join(pc, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("cnt", F.lit(0)).alias("cnt"))


def _safe_div(a, b):
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def binary_metrics(df: DataFrame, true_col: str = "label", pred_col: str = "pred") -> DataFrame:
    """One-vs-rest accuracy, precision, recall, F1 per class (0 when
    undefined), with predicted and actual positives."""
    pc = pair_counts(df, true_col, pred_col)
    withc = pc.withColumn("classes", _classes(pc).select("classes").scalar())
    e = withc.select("*", F.explode("classes").alias("class"))
    t, p, k, n = F.col("actual"), F.col("predicted"), F.col("class"), F.col("cnt")
    agg = e.groupBy("class").agg(
        F.sum(F.when((t == k) & (p == k), n).otherwise(0)).alias("tp"),
        F.sum(F.when((t != k) & (p == k), n).otherwise(0)).alias("fp"),
        F.sum(F.when((t == k) & (p != k), n).otherwise(0)).alias("fn"),
        F.sum(n).alias("total"))
    tp, fp, fn, tot = F.col("tp"), F.col("fp"), F.col("fn"), F.col("total")
    prec, rec = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    return agg.select(
        "class", _safe_div(tot - fp - fn, tot).alias("accuracy"), prec.alias("precision"), rec.alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        (tp + fp).alias("pred_pos"), (tp + fn).alias("actual_pos"))


def weighted_metrics(df: DataFrame, true_col: str = "label", pred_col: str = "pred") -> DataFrame:
    """Overall accuracy; precision, recall, F1 averaged with weights =
    support (actual positives)."""
    bm = binary_metrics(df, true_col, pred_col)
    pc = pair_counts(df, true_col, pred_col)
    acc = pc.agg(_safe_div(F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("cnt")).otherwise(0)),
                           F.sum("cnt")).alias("accuracy")).scalar()
    s = F.col("actual_pos")
    return bm.agg(*[_safe_div(F.sum(F.col(m) * s), F.sum(s)).alias(m) for m in ("precision", "recall", "f1_score")]
                  ).select(acc.alias("accuracy"), "precision", "recall", "f1_score")


def run_history(epochs: DataFrame, metrics: DataFrame, class_col: str = "attack_name",
                epoch_col: str = "epochs") -> DataFrame:
    """Per class the last epoch's row joined to its metrics. An epoch
    column that the metrics have too (accuracy) gets the prefix ``epoch_``."""
    epochs = epochs.withColumnsRenamed({c: f"epoch_{c}" for c in epochs.columns
                                        if c != class_col and c in metrics.columns})
    last = epochs.groupBy(class_col).agg(F.max_by(F.struct(*[c for c in epochs.columns if c != class_col]),
                                                  F.col(epoch_col)).alias("_last"))
    last = last.select(class_col, "_last.*")
    return last.join(metrics.withColumnRenamed("class", class_col), class_col, "left")

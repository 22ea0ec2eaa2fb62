"""Explanations (M1-M3), re-aimed from gradient saliency to a native,
linear attribution: contribution = feature value × class weight, where the
class weight is the mean value in the class minus the mean in normal.

Rows are ranked over the *whole* vocabulary: the median is taken with the
implicit zeros counted, and features are ordered by score descending, ties
by feature position — all inside the row, of which only the non-zero
entries are sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wtprof.operators.vectorize import small_side

NORMAL = "normal"


def class_weights(long: DataFrame, labels: DataFrame, key: Sequence[str], label_col: str = "label",
                  feature_col: str = "fidx", value_col: str = "value", normal: str = NORMAL) -> DataFrame:
    """M1 fit: ``(class, fidx, weight)`` for every class × feature, weight =
    mean in the class − mean in normal; means count the class's rows that
    lack the feature as 0. The grid is the (bounded) class array exploded
    over the distinct features — no join without keys."""
    n = labels.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"))
    sums = long.join(labels.select(*key, label_col), list(key)).groupBy(label_col, feature_col).agg(
        F.sum(value_col).alias("_s"))
    mean = sums.join(n, label_col).select(F.col(label_col).alias("class"), feature_col,
                                          (F.col("_s") / F.col("_n")).alias("_m"))
    base = mean.where(F.col("class") == normal).select(feature_col, F.col("_m").alias("_mn"))
    classes = labels.agg(F.collect_set(label_col)).scalar()
    grid = long.select(feature_col).distinct().select(feature_col, F.explode(classes).alias("class"))
    w = grid.join(mean, ["class", feature_col], "left").join(base, feature_col, "left")
    return w.select("class", feature_col,
                    (F.coalesce("_m", F.lit(0.0)) - F.coalesce("_mn", F.lit(0.0))).alias("weight"))


def feature_contribution(long: DataFrame, preds: DataFrame, weights: DataFrame, key: Sequence[str],
                         pred_col: str = "prediction", feature_col: str = "fidx",
                         value_col: str = "value") -> DataFrame:
    """M1: value × weight of the row's predicted class (zero if unseen). The
    weights (classes × vocabulary) are broadcast after a check of their
    size, so a common term of a common class is no hot key."""
    j = long.join(preds.select(*key, pred_col), list(key))
    j = j.join(small_side(weights.withColumnRenamed("class", pred_col)), [pred_col, feature_col], "left")
    return j.select(*key, pred_col, feature_col,
                    (F.col(value_col) * F.coalesce("weight", F.lit(0.0))).alias("contribution"))


def explain_rows(contrib: DataFrame, names: DataFrame, key: Sequence[str], n_features: int,
                 pred_col: str = "prediction", feature_col: str = "fidx", version: str | None = None,
                 top_k: int | None = None, rows: DataFrame | None = None) -> DataFrame:
    """M2: per row ``feature`` / ``score`` arrays over all ``n_features``
    features, score = contribution − median(all contributions, zeros
    included), sorted by score descending then feature position; all of them
    unless ``top_k`` cuts the list (E5).

    Rows stay sparse: only the non-zero contributions are sorted. The median
    follows from how many lie below and above zero, and the zero block, in
    feature order, goes between the positive and the negative ones. With
    ``rows`` (key and prediction) rows without any entry are kept: all their
    scores are zero. ``names``: (fidx, feature_term), bounded by the
    vocabulary; one array through a scalar subquery (no join per row).
    """
    entry = F.struct((-F.col("contribution")).alias("neg"), F.col(feature_col).cast("int").alias("i"))
    g = contrib.where(F.col("contribution") != 0).groupBy(*key, pred_col).agg(F.sort_array(F.collect_list(entry)).alias("_e"))
    every = (rows if rows is not None else contrib).select(*key, pred_col)
    g = (every if rows is not None else every.distinct()).join(g, [*key, pred_col], "left")
    g = g.withColumn("_e", F.coalesce("_e", F.array().cast("array<struct<neg:double,i:int>>")))
    name_arr = names.agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(feature_col).cast("int"),
                                                                           "feature_term"))),
                                     lambda s: s["feature_term"])).scalar()
    n, e = F.lit(n_features), F.col("_e")
    g = g.select(*key, pred_col, "_e", F.filter(e, lambda x: x["neg"] < 0).alias("_up"), F.filter(e, lambda x: x["neg"] > 0).alias("_down"))
    p, q = F.size("_up"), F.size("_down")

    def at(place: int):
        # the place-th smallest contribution: the ranking read from its end
        r = n_features - 1 - place
        return -(F.when(F.lit(r) < p, F.get(F.col("_up"), F.lit(r))["neg"])
                 .when(F.lit(r) < n - q, F.lit(0.0)).otherwise(F.get(F.col("_down"), F.lit(r) - n + q)["neg"]))

    mid = n_features // 2
    med = at(mid) if n_features % 2 else (at(mid - 1) + at(mid)) / 2
    idle = F.array_except(F.sequence(F.lit(0), n - 1), F.transform(e, lambda x: x["i"]))
    g = g.select(*key, pred_col, "_up", "_down", idle.alias("_idle"), med.alias("_med"), name_arr.alias("_names"))
    order = F.concat(F.transform("_up", lambda x: x["i"]), F.col("_idle"), F.transform("_down", lambda x: x["i"]))
    scores = F.concat(F.transform("_up", lambda x: -x["neg"] - F.col("_med")),
                      F.array_repeat(F.lit(0.0) - F.col("_med"), F.size("_idle")),
                      F.transform("_down", lambda x: -x["neg"] - F.col("_med")))
    if top_k:
        order, scores = F.slice(order, 1, top_k), F.slice(scores, 1, top_k)
    out = g.select(*key, pred_col, F.transform(order, lambda i: F.get(F.col("_names"), i)).alias("feature"), scores.alias("score"))
    if version is not None:
        out = out.withColumn("version", F.lit(version))
    return out


def explain_confirmed(expl: DataFrame, labels: Sequence[str], pred_col: str = "prediction") -> DataFrame:
    """M3: keep explanations whose prediction is a trained class."""
    return expl.where(F.col(pred_col).isin(list(labels)))

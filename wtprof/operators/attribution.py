"""Explanations that follow the fitted model (M1 by the model itself).

A row's score for a class is the tree's probability of it plus, where the class
has a specialist, the specialist's log-odds. Both are sums over features:

* tree: walking from the root to the row's leaf, each split changes the
  probability of the class, and the change belongs to the split's feature. The
  root's probability is the base;
* specialist: coefficient × value, with the intercept as base.

So a row's contributions sum to its score minus the base, exactly. The changes
along a path depend on the leaf only: they are one small table (leaf, class,
feature), made from the saved nodes, and rows join it by their leaf.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wtprof.operators.vectorize import small_side


def tree_paths(spark: SparkSession, model_path: str, labels: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(leaf, class, fidx, contribution)`` for every leaf and class, and
    ``(class, base)``, from a saved decision tree. Leaves are numbered as the
    model numbers them (from left to right). Bounded by the tree: leaves ×
    classes × depth rows."""
    raw = spark.read.parquet(os.path.join(model_path, "data"))
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, v: a + v)
    nodes = raw.select("id", "leftChild", "rightChild", F.col("split.featureIndex").alias("fidx"),
                       F.transform("impurityStats", lambda v: v / total).alias("p"))
    edges = nodes.where("leftChild >= 0").select(F.col("id").alias("up"), F.explode(F.array("leftChild", "rightChild")).alias("id"))
    walked = spark.sql("""
        WITH RECURSIVE walk(id, fidx, p, path) AS (
          SELECT id, fidx, p, CAST(array() AS ARRAY<STRUCT<fidx: INT, change: ARRAY<DOUBLE>>>) FROM {nodes} WHERE id = 0
          UNION ALL
          SELECT n.id, n.fidx, n.p, concat(w.path, array(named_struct('fidx', w.fidx, 'change', zip_with(n.p, w.p, (a, b) -> a - b))))
          FROM walk w JOIN {edges} e ON e.up = w.id JOIN {nodes} n ON n.id = e.id)
        SELECT id, path FROM walk""", nodes=nodes, edges=edges)
    leaf = (F.row_number().over(Window.orderBy("id")) - 1).cast("int")  # nodes of one tree
    leaves = nodes.where("leftChild < 0").select("id", leaf.alias("leaf")).join(walked, "id")
    names = F.array(*[F.lit(x) for x in labels])
    steps = leaves.select("leaf", F.explode("path").alias("s")).select("leaf", "s.fidx", F.posexplode("s.change").alias("c", "change"))
    paths = (steps.groupBy("leaf", F.get(names, F.col("c")).alias("class"), "fidx").agg(F.sum("change").alias("contribution"))
             .where("class IS NOT NULL"))
    base = nodes.where("id = 0").select(F.posexplode("p").alias("c", "base")).select(F.get(names, F.col("c")).alias("class"), "base")
    return paths, base.where("class IS NOT NULL")


def coefficients(spark: SparkSession, specialists: dict) -> DataFrame:
    """``(class, fidx, coefficient)`` of the specialists; only non-zero ones
    (classes × features rows at most)."""
    rows = [(a, i, float(c)) for a, m in specialists.items() for i, c in enumerate(m.coefficients.toArray().tolist()) if c]
    return spark.createDataFrame(rows, "class string, fidx int, coefficient double")


def model_score(scored: DataFrame, tree, labels: Sequence[str], base: DataFrame, specialists: dict,
                pred_col: str = "prediction", features_col: str = "features") -> DataFrame:
    """``scored`` with ``leaf``, ``score`` (the tree's probability of the
    row's class plus the log-odds of its specialist) and ``base`` (the root's
    probability plus the intercept). A class the tree doesn't know has
    probability and base 0; a row without a class keeps null scores."""
    names = F.array(*[F.lit(x) for x in labels])
    probe = tree.copy({tree.featuresCol: features_col, tree.leafCol: "leaf", tree.probabilityCol: "_p", tree.rawPredictionCol: "_r",
                       tree.predictionCol: "_y"})
    out = probe.transform(scored).withColumn("leaf", F.col("leaf").cast("int"))
    place = (F.array_position(names, F.col(pred_col)) - 1).cast("int")
    out = out.withColumn("score", F.when(F.col(pred_col).isNotNull(), F.coalesce(F.get(vector_to_array("_p"), place), F.lit(0.0))))
    out = out.drop("_p", "_r", "_y")
    out = out.join(F.broadcast(base.withColumnRenamed("class", pred_col)), pred_col, "left")  # a row for each class
    out = out.withColumn("base", F.when(F.col(pred_col).isNotNull(), F.coalesce("base", F.lit(0.0))))
    for a, m in specialists.items():
        m = m.copy({m.featuresCol: features_col, m.probabilityCol: "_p", m.rawPredictionCol: "_r", m.predictionCol: "_y"})
        odds = F.get(vector_to_array("_r"), 1)
        out = m.transform(out).withColumn("score", F.when(F.col(pred_col) == a, F.col("score") + odds).otherwise(F.col("score")))
        out = out.withColumn("base", F.when(F.col(pred_col) == a, F.col("base") + m.intercept).otherwise(F.col("base"))).drop("_p", "_r", "_y")
    return out


def model_contribution(entries: DataFrame, scored: DataFrame, paths: DataFrame, coefs: DataFrame, key: Sequence[str],
                       pred_col: str = "prediction", feature_col: str = "fidx", value_col: str = "value") -> DataFrame:
    """M1: ``(key…, class, fidx, contribution)``: what each feature adds to the
    row's score. ``entries`` are the non-zero features of the rows (key, fidx,
    value), ``scored`` a :func:`model_score` result. The contributions of a
    row sum to its ``score`` − ``base``.

    Paths and coefficients are fitted tables, broadcast after a check of
    their size; a feature of both parts is added up within the key's own
    partition."""
    key = list(key)
    tree = scored.select(*key, pred_col, "leaf").join(small_side(paths.withColumnRenamed("class", pred_col)), [pred_col, "leaf"])
    linear = entries.join(scored.select(*key, pred_col), key).join(
        small_side(coefs.withColumnRenamed("class", pred_col).withColumnRenamed("fidx", feature_col)), [pred_col, feature_col])
    both = tree.select(*key, pred_col, F.col("fidx").alias(feature_col), "contribution").unionByName(
        linear.select(*key, pred_col, F.col(feature_col).cast("int").alias(feature_col),
                      (F.col(value_col) * F.col("coefficient")).alias("contribution")))
    return both.repartition(*key).groupBy(*key, pred_col, feature_col).agg(F.sum("contribution").alias("contribution"))

"""Models (L1-L5, L11) on Spark ML, plus the Python scoring hook (O1).

The neural parts of the reference are re-aimed: specialists are logistic
regressions per attack (L4) and the normal outlier score is the PCA
reconstruction error (L5). Trees use binned splits, so they are not
bit-equal to an exact CART; they are checked by invariants. Spark ML draws the
values it takes its bins from: beyond about 10 000 rows a sample. The train
job's tree (:func:`fit_tree_on_all_rows`) has its bins from all rows.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier, LogisticRegression
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wtprof.operators.joins import tree_parent
from wtprof.operators.vectorize import as_vectors, small_side
from wtprof.session import materialize, scratch_path

SPLIT_SAMPLE = 10_000  # Spark ML takes a tree's bins from so many rows, or max_bins² if that is more
MOST_BINS = 46_340     # whose square is an int


def class_index(df: DataFrame, label_col: str = "label") -> tuple[DataFrame, list[str]]:
    """Sorted class list (bounded by the number of classes) and a numeric
    label column ``label_idx`` (position in that list)."""
    labels = sorted(r[0] for r in df.select(label_col).distinct().collect() if r[0] is not None)
    arr = F.array(*[F.lit(x) for x in labels])
    return df.withColumn("label_idx", (F.array_position(arr, F.col(label_col)) - 1).cast("double")), labels


def fit_tree(train: DataFrame, max_depth: int = 10, features_col: str = "features", label_col: str = "label",
             seed: int = 42, max_bins: int = 32):
    """L1 fit: multiclass tree. Returns (model, labels)."""
    d, labels = class_index(train, label_col)
    dt = DecisionTreeClassifier(featuresCol=features_col, labelCol="label_idx", maxDepth=max_depth,
                                seed=seed, maxBins=max_bins)
    return dt.fit(d), labels


def _cells(df: DataFrame, features_col: str) -> DataFrame:
    """The stored entries (i, v) of vectors, dense or sparse, in order."""
    u = df.select("*", F.unwrap_udt(features_col).alias("_u"))
    every = F.when(F.size("_u.values") > 0, F.sequence(F.lit(0), F.size("_u.values") - 1)).otherwise(F.array().cast("array<int>"))
    return u.withColumns({"_i": F.when(F.col("_u.type") == 1, every).otherwise(F.col("_u.indices")), "_v": F.col("_u.values")}).drop("_u")


def split_points(rows: DataFrame, max_bins: int = 32, features_col: str = "features") -> DataFrame:
    """``(fidx, points)``: the sorted thresholds, ``max_bins`` − 1 at most, that
    divide the values of each feature over all ``rows``; no row for a feature
    that is zero throughout.

    A threshold lies midway between two neighbouring values. Up to
    ``max_bins`` distinct values, zero among them, have one between any two.
    Of more, zero is parted from its neighbours and the other values are
    divided into parts of about equal numbers of rows. Distinct values are
    counted, range-sorted and written with their partition number; sums run
    within a partition, and those of earlier partitions are added, so no
    feature is a single task's work."""
    n_rows = rows.count()
    cells = _cells(rows, features_col).select(F.explode(F.arrays_zip("_i", "_v")).alias("e")).select(F.col("e._i").alias("fidx"), F.col("e._v").alias("v"))
    counts = materialize(cells.where("v <> 0 AND NOT isnan(v)").groupBy("fidx", "v").agg(F.count(F.lit(1)).alias("n")))
    zero = counts.groupBy("fidx").agg(F.sum("n").alias("n")).where(F.col("n") < n_rows).select("fidx", F.lit(0.0).alias("v"), F.lit(0).cast("long").alias("n"))
    cut = materialize(counts.unionByName(zero).orderBy("fidx", "v").withColumn("pid", F.spark_partition_id()))
    parts = cut.groupBy("fidx", "pid").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("values"), F.min("v").alias("first"), F.min_by("n", "v").alias("m"))
    w, whole = Window.partitionBy("fidx").orderBy("pid"), Window.partitionBy("fidx")
    parts = parts.select("fidx", "pid", (F.sum("n").over(w) - F.col("n")).alias("before"), F.sum("n").over(whole).alias("total"),
                         F.sum("values").over(whole).alias("values"), F.lead("first").over(w).alias("after"), F.lead("m").over(w).alias("after_n"))
    local = Window.partitionBy("fidx", "pid").orderBy("v")
    run = local.rowsBetween(Window.unboundedPreceding, 0)
    at = cut.select("fidx", "pid", "v", F.sum("n").over(run).alias("upto"), F.lead("v").over(local).alias("next"), F.lead("n").over(local).alias("next_n"))
    at = at.join(small_side(parts), ["fidx", "pid"])
    upto, following = F.col("before") + F.col("upto"), F.coalesce("next", "after")
    # zero has two of the thresholds, the rest are spent on the other values
    part = lambda c: F.floor(c * max(max_bins - 3, 1) / F.col("total"))
    kept = (F.col("values") <= max_bins) | (F.col("v") == 0) | (following == 0)
    if max_bins > 3:
        kept = kept | (part(upto) < part(upto + F.coalesce("next_n", "after_n")))
    points = at.where(following.isNotNull() & kept).select("fidx", (F.col("v") / 2 + following / 2).alias("p"))
    return points.groupBy("fidx").agg(F.sort_array(F.collect_list("p")).alias("points"))  # max_bins − 1 at most


def _binned(points: dict, size: int):
    """Entries replaced by the number of their bin, counted from that of zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            index = batch.column("i").flatten().to_numpy(zero_copy_only=False)
            value = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            bins = np.zeros(len(value))
            order = np.argsort(index, kind="stable")
            found, starts = np.unique(index[order], return_index=True)
            for f, own in zip(found.tolist(), np.split(order, starts[1:])):
                p = points.get(f)
                if p is not None:
                    bins[own] = np.searchsorted(p, value[own]) - np.searchsorted(p, 0.0)
            ends = np.cumsum(np.append(0, batch.column("v").value_lengths().to_numpy(zero_copy_only=False)))
            offsets = pa.array(ends, pa.int32())
            n = batch.num_rows
            vector = pa.StructArray.from_arrays(
                [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)),
                 pa.ListArray.from_arrays(offsets, pa.array(index.astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(bins))],
                ["type", "size", "indices", "values"])
            yield pa.RecordBatch.from_arrays([batch.column("label_idx"), vector], ["label_idx", "features"])
    return run


def fit_tree_on_all_rows(train: DataFrame, max_depth: int = 10, features_col: str = "features", label_col: str = "label",
                         seed: int = 42, max_bins: int = 32):
    """L1 fit: :func:`fit_tree` with the bins of every feature taken from all
    rows. Returns (model, labels).

    Spark ML takes them from a sample unless max_bins² reaches the number of
    rows. Up to that number this is :func:`fit_tree`. Beyond, the values are
    replaced by the numbers of their bins (:func:`split_points`), which are
    few, so that the square root of the rows as ``max_bins`` makes Spark read
    all rows at no more bins; the model's thresholds are then put back.
    ``train`` is read several times: write or cache a costly one."""
    n = train.count()
    if n <= max(SPLIT_SAMPLE, max_bins * max_bins):
        return fit_tree(train, max_depth, features_col, label_col, seed, max_bins)
    spark = train.sparkSession
    d, labels = class_index(train, label_col)
    points = {r["fidx"]: np.array(r["points"]) for r in split_points(train, max_bins, features_col).collect()}  # features × max_bins
    size = d.select(F.unwrap_udt(features_col).alias("u")).select(F.coalesce("u.size", F.size("u.values"))).first()[0]
    cells = _cells(d, features_col).select("label_idx", F.col("_i").alias("i"), F.col("_v").alias("v"))
    schema = "label_idx double, features struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
    rows = as_vectors(cells.mapInArrow(_binned(points, size), schema), "features").withColumnRenamed("features", features_col)
    dt = DecisionTreeClassifier(featuresCol=features_col, labelCol="label_idx", maxDepth=max_depth, seed=seed,
                                maxBins=min(MOST_BINS, max(max_bins, math.isqrt(n) + 1)))
    return _with_thresholds(spark, dt.fit(rows), points), labels


def _with_thresholds(spark, model, points: dict):
    """The tree fitted on bin numbers, with the thresholds between the bins."""
    path = scratch_path(spark, f"tree-{uuid.uuid4().hex}")
    model.write().overwrite().save(os.path.join(path, "binned"))
    nodes = spark.read.parquet(os.path.join(path, "binned", "data"))
    pairs = [(f, k - int(np.searchsorted(p, 0.0)), float(x)) for f, p in points.items() for k, x in enumerate(p)]
    known = spark.createDataFrame(pairs, "_f int, _bin int, _p double")
    split = F.col("split")
    j = nodes.join(small_side(known), (split["featureIndex"] == F.col("_f")) & (
        F.floor(F.get(split["leftCategoriesOrThreshold"], 0)).cast("int") == F.col("_bin")), "left")
    own = split.withField("leftCategoriesOrThreshold", F.when(F.col("leftChild") >= 0, F.array("_p")).otherwise(split["leftCategoriesOrThreshold"]))
    j.withColumn("split", own).select(nodes.columns).write.parquet(os.path.join(path, "tree", "data"))
    spark.read.text(os.path.join(path, "binned", "metadata")).coalesce(1).write.text(os.path.join(path, "tree", "metadata"))
    return DecisionTreeClassificationModel.load(os.path.join(path, "tree"))


def predict_tree(model, labels: Sequence[str], df: DataFrame, out: str = "pred",
                 multioutput_fallback: bool = False) -> DataFrame:
    """L1 predict: class name of the tree's prediction (majority class).

    ``multioutput_fallback`` emulates a tree fitted on one-hot labels: when
    no class has probability above 0.5 the decision falls back to the first
    class."""
    arr = F.array(*[F.lit(x) for x in labels])
    p = model.transform(df)
    idx = F.col("prediction").cast("int")
    if multioutput_fallback:
        prob = vector_to_array(F.col("probability"))
        idx = F.when(F.array_max(prob) > 0.5, idx).otherwise(F.lit(0))
    return p.withColumn(out, F.get(arr, idx)).drop("rawPrediction", "probability", "prediction")


def tree_nodes(model, labels: Sequence[str], names: DataFrame, path: str, model_id: int, version: str,
               logtime) -> DataFrame:
    """L2: node table (value, features, node_num, node_from, node_to_left,
    node_to_right, level, attack_nm, …) from the saved model's node data.

    ``path`` must be on shared storage. Levels come from the parent links by
    a recursive CTE (depth ≤ maxDepth)."""
    model.write().overwrite().save(path)
    spark = names.sparkSession
    raw = spark.read.parquet(os.path.join(path, "data"))
    arr = F.array(*[F.lit(x) for x in labels])
    nodes = raw.select(
        F.col("id").alias("node_num"), F.col("leftChild").alias("node_to_left"),
        F.col("rightChild").alias("node_to_right"),
        F.when(F.col("leftChild") >= 0, F.get(F.col("split.leftCategoriesOrThreshold"), 0)).alias("value"),
        F.when(F.col("leftChild") >= 0, F.col("split.featureIndex")).alias("fidx"),
        F.get(arr, F.col("prediction").cast("int")).alias("attack_nm"))
    nodes = nodes.join(F.broadcast(names.select("fidx", F.col("feature_term").alias("features"))), "fidx", "left")
    nodes = tree_parent(nodes)
    nodes.createOrReplaceTempView("_wtprof_nodes")
    levels = spark.sql("""
        WITH RECURSIVE lv(node_num, level) AS (
          SELECT node_num, 0 FROM _wtprof_nodes WHERE node_from IS NULL
          UNION ALL
          SELECT n.node_num, lv.level + 1 FROM _wtprof_nodes n JOIN lv ON n.node_from = lv.node_num)
        SELECT node_num, level FROM lv""")
    out = nodes.join(levels, "node_num")
    return out.select(F.lit(model_id).alias("model_id"), F.lit(logtime).alias("logtime"), "attack_nm",
                      "value", "features", "node_num", "node_from", "node_to_left", "node_to_right", "level",
                      F.lit(version).alias("model_ver"))


def tree_importance(model, names: DataFrame, model_id: int, logtime, weekday: int, dayhour: str) -> DataFrame:
    """L3: importance per feature (vector of vocabulary size → rows)."""
    imp = model.featureImportances.toArray().tolist()
    spark = names.sparkSession
    vals = spark.createDataFrame(list(enumerate(imp)), "fidx int, value double")
    return (names.join(vals, "fidx").select(
        F.lit(model_id).alias("model_id"), F.lit(logtime).alias("logtime"), F.lit("total").alias("attack_nm"),
        F.lit(str(weekday)).alias("weekday"), F.lit(dayhour).alias("dayhour"),
        F.col("feature_term").alias("feature"), "value"))


def fit_specialists(pairs: DataFrame, attacks: Sequence[str], features_col: str = "features",
                    max_iter: int = 50, reg: float = 0.0):
    """L4 fit: one binary logistic model per attack on its (attack vs
    normal) subset (K6 output: columns attack, target). Returns
    {attack: model}. One fit job per class (classes are few)."""
    models = {}
    for a in attacks:
        sub = pairs.where(F.col("attack") == a).withColumn("target", F.col("target").cast("double"))
        if sub.limit(1).count() == 0:
            continue
        lr = LogisticRegression(featuresCol=features_col, labelCol="target", maxIter=max_iter, regParam=reg)
        models[a] = lr.fit(sub)
    return models


def predict_specialists(models: dict, df: DataFrame) -> DataFrame:
    """L4 predict: a probability column per attack (all models in one plan)."""
    out = df
    for a, m in models.items():
        m = m.copy({m.probabilityCol: f"_p_{a}", m.rawPredictionCol: f"_r_{a}", m.predictionCol: f"_y_{a}"})
        out = m.transform(out)
        out = out.withColumn(a, F.get(vector_to_array(F.col(f"_p_{a}")), 1)).drop(f"_p_{a}", f"_r_{a}", f"_y_{a}")
    return out


def epoch_metrics(models: dict, model_id: int, logtime) -> DataFrame:
    """Loss per iteration and class from the training summaries; the
    final model's accuracy on the last row, null where it is not known."""
    rows = []
    for a, m in models.items():
        s = m.summary
        hist = list(s.objectiveHistory)
        for i, loss in enumerate(hist, start=1):
            rows.append((model_id, a, i, float(loss), float(s.accuracy) if i == len(hist) else None))
    from pyspark.sql import SparkSession
    ss = SparkSession.getActiveSession()
    df = ss.createDataFrame(rows, "model_id int, attack_name string, epochs int, loss double, accuracy double")
    return df.withColumn("logtime", F.lit(logtime)).select("model_id", "attack_name", "logtime", "epochs",
                                                          "loss", "accuracy")


def fit_outlier(normal_rows: DataFrame, k: int = 8, features_col: str = "features"):
    """L5 fit: principal components of the rows routed to normal."""
    return PCA(k=k, inputCol=features_col, outputCol="_pca").fit(normal_rows)


def outlier_score(model, df: DataFrame, features_col: str = "features", out: str = "normal") -> DataFrame:
    """Squared reconstruction error ‖x‖² − ‖Pᵀx‖² (orthonormal P)."""
    d = model.transform(df)
    x = vector_to_array(F.col(features_col))
    z = vector_to_array(F.col("_pca"))
    sq = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v * v)
    return d.withColumn(out, F.greatest(sq(x) - sq(z), F.lit(0.0))).drop("_pca")


def score_with_python(df: DataFrame, fn: Callable, features_col: str = "features", out: str = "score",
                      keep: Sequence[str] = ()) -> DataFrame:
    """O1: a user's batch scorer over Arrow batches (``mapInPandas``).

    ``fn`` receives a 2-D numpy array (rows × features) and returns one
    score per row; per-row Python is never used.
    """
    import numpy as np
    import pandas as pd

    keep = list(keep)
    arr = df.select(*keep, vector_to_array(F.col(features_col)).alias("_x"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in arr.schema.fields if f.name in keep]
                       + [f"{out} double"])

    def run(batches):
        for b in batches:
            x = np.stack(b["_x"].to_numpy()) if len(b) else np.zeros((0, 0))
            s = np.asarray(fn(x), dtype="float64") if len(b) else np.zeros(0)
            yield pd.concat([b[keep].reset_index(drop=True), pd.DataFrame({out: s})], axis=1)

    return arr.mapInPandas(run, schema)

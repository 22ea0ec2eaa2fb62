"""The train job fits its models on all training rows."""

import random
import uuid

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F


def test_large_classes_are_fitted_whole(spark):
    """More than 100 000 training sessions of a class: all of them reach the tree and the specialists."""
    from wtprof.operators.sampling import split_fraction
    from wtprof.plans.jobs import KEY, TrainConfig, train_job
    from wtprof.session import scratch_path
    attack = F.col("id") % 1000 == 0
    log = spark.range(150_000, numPartitions=8).select(
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id % 480 as int))").alias("logtime"),
        F.concat(F.lit("10.0."), F.floor(F.col("id") / 480)).alias("src_ip"), F.lit("192.168.0.1").alias("dst_ip"),
        F.lit("curl").alias("http_agent"), F.when(attack, "q script alert").otherwise("q page").alias("http_query"),
        F.when(attack, "XSS").otherwise("normal").alias("hash"))
    keys = log.select(F.col("logtime").alias("lgtime"), "src_ip", "dst_ip", F.col("hash").alias("label"))
    largest = split_fraction(keys, KEY, 0.7).where("split = 'train' AND label = 'normal'").count()
    assert largest > 100_000
    base = scratch_path(spark, f"whole_{uuid.uuid4().hex[:8]}")
    cfg = TrainConfig(start="2024-01-01 00:00:00", end="2024-01-22 00:00:00", interval="1 hour", max_features=8, max_depth=2,
                      spec_iter=2, pca_k=1)
    train_job(spark, log, cfg, base, "2024_01_21")
    root = spark.read.parquet(f"{base}/models/2024_01_21/tree/data").where("id = 0").first()
    assert root["rawCount"] == 2 * largest  # both classes, oversampled to the largest


def rare_values(spark):
    """Five rows of 40 000 are of class b, each by one value that occurs once: 2 among zeros and ones."""
    rnd = random.Random(3)
    rows = []
    for k in range(40_000):
        x = [float(rnd.randint(0, 1)) for _ in range(5)]
        if k < 5:
            x[k] = 2.0
        rows.append(("b" if k < 5 else "a", Vectors.dense(x) if k % 2 else Vectors.sparse(5, [(i, v) for i, v in enumerate(x) if v])))
    return spark.createDataFrame(rows, ["label", "features"]).repartition(4).cache()


def wrong(model, labels, rows):
    from wtprof.operators.models import predict_tree
    return predict_tree(model, labels, rows).where("pred <> label").count()


def test_thresholds_come_from_all_rows(spark):
    from wtprof.operators.models import fit_tree, fit_tree_on_all_rows
    rows = rare_values(spark)
    assert wrong(*fit_tree(rows), rows) > 0  # Spark ML's sample of 10 000 rows misses some of the five
    model, labels = fit_tree_on_all_rows(rows)
    assert wrong(model, labels, rows) == 0 and model.numFeatures == 5
    assert sum(model.featureImportances.toArray()) == pytest.approx(1)
    few = rows.limit(9_000).cache()  # no sample: the same tree
    assert fit_tree_on_all_rows(few)[0].toDebugString.split("\n", 1)[1] == fit_tree(few)[0].toDebugString.split("\n", 1)[1]


def test_split_points(spark):
    from wtprof.operators.models import fit_tree_on_all_rows, split_points
    rnd = random.Random(5)
    data = []
    for k in range(12_000):
        x = [0.0, float(rnd.randint(-2, 2)), rnd.gauss(0, 1) if rnd.random() < 0.5 else 0.0, rnd.random() + 1]
        data.append(("high" if x[2] > 0.7 else "low" if x[3] > 1.8 else "mid", Vectors.dense(x), x))
    rows = spark.createDataFrame([r[:2] for r in data], ["label", "features"]).repartition(4).cache()
    got = {r["fidx"]: r["points"] for r in split_points(rows, 16).collect()}
    assert set(got) == {1, 2, 3} and got[1] == [-1.5, -0.5, 0.5, 1.5]
    for f in (2, 3):
        values = sorted({x[f] for _, _, x in data})
        middle = {a / 2 + b / 2 for a, b in zip(values, values[1:])}
        assert 10 <= len(got[f]) <= 15 and got[f] == sorted(set(got[f])) and set(got[f]) <= middle
        own = sorted(x[f] for _, _, x in data if x[f])
        sizes = [sum(a < v <= b for v in own) for a, b in zip([float("-inf"), *got[f]], [*got[f], float("inf")])]
        assert max(sizes) <= 1.2 * len(own) / 13
    below, above = [max(x[2] for _, _, x in data if x[2] < 0) / 2, min(x[2] for _, _, x in data if x[2] > 0) / 2]
    assert {below, above} <= set(got[2])
    model, labels = fit_tree_on_all_rows(rows)
    assert wrong(model, labels, rows) < 0.08 * len(data)
    known = {f: set(p) for f, p in ((r["fidx"], r["points"]) for r in split_points(rows).collect())}
    from wtprof.session import scratch_path
    model.write().overwrite().save(path := scratch_path(spark, f"points_{uuid.uuid4().hex[:8]}"))
    splits = spark.read.parquet(f"{path}/data").where("leftChild >= 0").select("split.featureIndex", "split.leftCategoriesOrThreshold").collect()
    assert splits and all(t[0] in known[f] for f, t in splits)

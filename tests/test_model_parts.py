"""Model-faithful explanations, one-pass specialists, stop rule, sparse vectors, versions of a stream."""

import uuid

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import functions as F

from wtprof.operators import attribution, specialists, vectorize
from wtprof.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    """Rows of three attacks and normal traffic over seven sparse features, one of them constant."""
    rng = np.random.default_rng(7)
    data = []
    for k in range(900):
        label = ["normal", "normal", "a", "b", "c"][k % 5]
        x = rng.exponential(1, 7) * (rng.random(7) < 0.5)
        x[{"normal": 0, "a": 1, "b": 2, "c": 3}[label]] += rng.exponential(0.8)
        x[6] = 2.0
        data.append((k, label, Vectors.sparse(7, [(i, float(v)) for i, v in enumerate(x) if v])))
    return spark.createDataFrame(data, ["k", "label", "features"]).cache()


def test_specialists_in_one_pass_equal_single_fits(spark, rows):
    attacks = ["a", "b", "c", "missing"]
    models, epochs = specialists.fit_specialists_together(rows, attacks, reg=0.05)
    assert set(models) == {"a", "b", "c"}
    for a, m in models.items():
        pair = rows.where(F.col("label").isin(a, "normal")).withColumn("y", (F.col("label") == a).cast("double"))
        want = LogisticRegression(labelCol="y", regParam=0.05, maxIter=500, tol=1e-14).fit(pair)
        assert np.abs(m.coefficients.toArray() - want.coefficients.toArray()).max() < 1e-6
        assert abs(m.intercept - want.intercept) < 1e-6 and m.coefficients[6] == 0.0
        accuracy = want.evaluate(pair).accuracy
        last = epochs.where(F.col("attack_name") == a).orderBy(F.desc("epochs")).first()
        assert last["accuracy"] == pytest.approx(accuracy)
    assert epochs.where("accuracy IS NULL OR loss IS NULL").count() == 0
    # a saved model is an ordinary one
    path = scratch_path(spark, f"spec_{uuid.uuid4().hex[:8]}")
    models["a"].write().save(path)
    again = type(models["a"]).load(path).transform(rows).select("k", "probability")
    assert again.exceptAll(models["a"].transform(rows).select("k", "probability")).count() == 0


def test_jobs_of_a_fit_do_not_grow_with_classes(spark, rows):
    def jobs(attacks):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, group)
        specialists.fit_specialists_together(rows, attacks, max_iter=3)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    assert jobs(["a", "b", "c"]) <= jobs(["a"])


def test_separable_classes_stop_early(spark):
    data = [(k, "x" if k % 2 else "normal", Vectors.dense([float(k % 2), 1.0])) for k in range(40)]
    models, epochs = specialists.fit_specialists_together(spark.createDataFrame(data, ["k", "label", "features"]), ["x"], max_iter=200)
    history = epochs.orderBy("epochs").collect()
    assert len(history) < 60 and history[-1]["accuracy"] == 1.0 and history[-1]["loss"] < 0.01
    assert np.isfinite(models["x"].coefficients.toArray()).all()
    none, empty = specialists.fit_specialists_together(spark.createDataFrame(data, ["k", "label", "features"]).where("false"), ["x"])
    assert none == {} and empty.count() == 0


def test_stop_rule(spark):
    """Patience counts epochs since the loss last fell by more than min_delta."""
    losses = {"falls": [5.0, 4.0, 3.0, 2.0], "rests": [5.0, 4.0, 3.9995, 3.9991, 3.9, 1.0], "null": [None, None, None, 1.0], "one": [2.0]}
    df = spark.createDataFrame([(g, i, x) for g, xs in losses.items() for i, x in enumerate(xs, start=1)], "g string, epochs int, loss double")
    got = {r["g"]: tuple(r)[1:] for r in specialists.early_stop(df, ["g"], patience=2, min_delta=0.001).collect()}
    assert got == {"falls": (4, 4, 4, 2.0), "rests": (6, 4, 2, 4.0), "null": (4, 2, None, None), "one": (1, 1, 1, 2.0)}


def test_contributions_sum_to_the_score(spark, rows):
    labels = ["a", "b", "c", "normal"]
    d = rows.withColumn("y", (F.array_position(F.array(*map(F.lit, labels)), F.col("label")) - 1).cast("double"))
    tree = DecisionTreeClassifier(labelCol="y", maxDepth=5, seed=1).fit(d)
    models, _ = specialists.fit_specialists_together(rows, ["a", "b"], reg=0.01)
    path = scratch_path(spark, f"tree_{uuid.uuid4().hex[:8]}")
    tree.write().save(path)
    paths, base = attribution.tree_paths(spark, path, labels)
    assert paths.select("leaf").distinct().count() == (tree.numNodes + 1) // 2
    names = F.element_at(F.array(*map(F.lit, [*labels, "unknown"])), (F.col("k") % 5 + 1).cast("int"))
    asked = rows.withColumn("prediction", F.when(F.col("k") % 7 > 0, names))  # any class, an unknown one and none
    scored = attribution.model_score(asked, tree, labels, base, models).cache()
    entries = spark.createDataFrame([(r["k"], int(i), float(v)) for r in rows.collect() for i, v in zip(r["features"].indices, r["features"].values)],
                                    "k long, fidx int, value double")
    parts = attribution.model_contribution(entries, scored, paths, attribution.coefficients(spark, models), ["k"])
    assert parts.groupBy("k", "fidx").count().where("count > 1").count() == 0
    total = {r[0]: r[1] for r in parts.groupBy("k").agg(F.sum("contribution")).collect()}
    for r in scored.collect():
        if r["prediction"] is None:
            assert r["score"] is None and r["base"] is None and r["k"] not in total
        else:
            assert r["score"] - r["base"] == pytest.approx(total.get(r["k"], 0.0), abs=1e-9)
    # the score is the models' own
    for p, a in ((0, "a"), (3, "normal")):
        r = scored.where(F.col("prediction") == a).first()
        x = r["features"]
        want = tree.predictProbability(x)[p] + (models[a].predictRaw(x)[1] if a in models else 0.0)
        assert r["score"] == pytest.approx(want)


def test_vectors_are_sparse(spark):
    long = spark.createDataFrame([(1, 9, 2.0), (1, 3, 1.0), (1, 5, 0.0), (2, 0, 4.0)], "k int, idx int, value double")
    every = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, note string")
    size = 1 << 30  # nothing of this size is ever built
    got = {r["k"]: (r["note"], r["features"]) for r in vectorize.assemble(long, ["k"], size, rows=every).collect()}
    assert got == {1: ("x", SparseVector(size, {3: 1.0, 9: 2.0})), 2: ("y", SparseVector(size, {0: 4.0})), 3: (None, SparseVector(size, {}))}
    only = vectorize.assemble(long, ["k"], 10)
    assert {r["k"]: r["features"] for r in only.collect()} == {1: SparseVector(10, {3: 1.0, 9: 2.0}), 2: SparseVector(10, {0: 4.0})}
    assert vectorize.assemble(long.where("false"), ["k"], 10).count() == 0


def test_stream_uses_the_version_of_its_batch(spark, monkeypatch):
    """A version published while the stream runs scores the later batches; a replayed batch keeps its own."""
    from wtprof.plans import jobs
    from wtprof.streaming import sessions as S
    run = scratch_path(spark, f"versions_{uuid.uuid4().hex[:8]}")
    publish = lambda v: jobs.A.save_fit(spark.createDataFrame([(1.0,)], "threshold double"), f"{run}/base", "threshold", v)
    publish("2024_01_01")
    for k in range(3):
        spark.createDataFrame([(k,)], "k long").coalesce(1).write.parquet(f"{run}/in/f{k}")
    loads, ids = [], []

    class Loaded:
        def __init__(self, version):
            self.fused = version

    monkeypatch.setattr(jobs, "load_artifacts", lambda spark, base, as_of=None, version=None: loads.append(version) or version)
    monkeypatch.setattr(jobs, "score_sessions", lambda art, batch, interval: Loaded(batch.withColumn("scored_by", F.lit(art))))
    monkeypatch.setattr(jobs.L, "result_record", lambda d, model_id, version: d.withColumn("version", F.lit(version)))
    write = S.write_batch

    def write_and_publish(df, sink, batch_id):
        write(df, sink, batch_id)
        ids.append(batch_id)
        if batch_id == 1:
            publish("2024_02_02")

    monkeypatch.setattr(S, "write_batch", write_and_publish)
    source = lambda: (spark.readStream.schema("k long").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
                      .parquet(f"{run}/in"))
    jobs.stream_predict_job(spark, source(), f"{run}/base", None, "1 hour", f"{run}/out", f"{run}/ckpt")
    got = {r["batch_id"]: (r["version"], r["scored_by"]) for r in spark.read.parquet(f"{run}/out").collect()}
    assert got == {0: ("2024_01_01",) * 2, 1: ("2024_01_01",) * 2, 2: ("2024_02_02",) * 2}
    assert loads == ["2024_01_01", "2024_02_02"]  # once a version
    # the same batches again, from an empty log of offsets: the versions written down hold
    publish("2024_03_03")
    handled = {}
    monkeypatch.setattr(jobs, "stream_predict", lambda sessions, score, sink, checkpoint: [
        handled.update({b: score(spark.range(1), b).first()["version"]}) for b in (0, 1, 2, 3)])
    jobs.stream_predict_job(spark, source(), f"{run}/base", None, "1 hour", f"{run}/out", f"{run}/ckpt")
    assert handled == {0: "2024_01_01", 1: "2024_01_01", 2: "2024_02_02", 3: "2024_03_03"}
    jobs.stream_predict_job(spark, source(), f"{run}/base", "2024_02_28", "1 hour", f"{run}/out", f"{run}/ckpt9")
    assert set(handled.values()) == {"2024_02_02"}


def test_scans_of_a_fit_read_blocks(spark, rows, monkeypatch):
    """The rows are packed once; an epoch reads far fewer rows than there are, dense and sparse vectors alike."""
    seen = []
    added = specialists._partial
    monkeypatch.setattr(specialists, "_partial", lambda attacks, size, shared: seen.append(attacks) or added(attacks, size, shared))
    sizes = []
    kept = specialists.materialize
    monkeypatch.setattr(specialists, "materialize", lambda df: sizes.append(kept(df)) or sizes[-1])
    dense = F.when(F.col("k") % 2 == 0, F.col("features"))
    to_dense = F.udf(lambda v: Vectors.dense(v.toArray()), rows.schema["features"].dataType)
    mixed = rows.withColumn("features", F.coalesce(dense, to_dense("features")))
    models, _ = specialists.fit_specialists_together(mixed, ["a", "b"], reg=0.05)
    want, _ = specialists.fit_specialists_together(rows, ["a", "b"], reg=0.05)
    for a in ("a", "b"):
        assert np.abs(models[a].coefficients.toArray() - want[a].coefficients.toArray()).max() < 1e-9
    assert len(sizes) == 2 and sizes[0].count() <= 40 and len(seen) > 2

"""Model-layer invariants on the sf0.001 fixture."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def trained(spark):
    from wtprof.plans.q_models import trained as T
    return T(spark, SF_SMALL)


def test_tree_accuracy_floor(spark, trained):
    from wtprof.operators.metrics import weighted_metrics
    from wtprof.operators.models import predict_tree
    test = trained["data"].where(F.col("split") == "test")
    pred = predict_tree(trained["tree"], trained["labels"], test)
    assert weighted_metrics(pred, "label", "pred").first()["accuracy"] >= 0.9


def test_node_table_is_a_tree(spark, trained):
    import __spark_entry__ as E
    nodes = E.queries()["tree_nodes"](spark, SF_SMALL).collect()
    roots = [n for n in nodes if n["node_from"] is None]
    assert len(roots) == 1 and roots[0]["level"] == 0
    by_id = {n["node_num"]: n for n in nodes}
    for n in nodes:
        if n["node_from"] is not None:
            assert by_id[n["node_from"]]["level"] == n["level"] - 1
        if n["node_to_left"] >= 0:
            assert by_id[n["node_to_left"]]["node_from"] == n["node_num"]


def test_specialist_probabilities_in_unit_interval(spark, trained):
    from wtprof.operators.models import predict_specialists
    out = predict_specialists(trained["spec"], trained["data"])
    for a in trained["spec"]:
        lo, hi = out.agg(F.min(a), F.max(a)).first()
        assert 0.0 <= lo <= hi <= 1.0


def test_outlier_score_non_negative(spark, trained):
    from wtprof.operators.models import outlier_score
    assert outlier_score(trained["pca"], trained["data"]).agg(F.min("normal")).first()[0] >= 0.0


def test_python_hook_batches(spark, trained):
    from wtprof.operators.models import score_with_python
    out = score_with_python(trained["data"], lambda x: x.sum(axis=1), keep=["label"])
    assert out.count() == trained["data"].count()


def test_jobs_with_numeric_features(spark):
    """Train + predict with status counts appended to the text vector."""
    import uuid

    from wtprof.plans.jobs import TrainConfig, predict_job, train_job
    from wtprof.session import scratch_path
    from wtprof.sources.tables import http_log
    log = http_log(spark, SF_SMALL)
    base = scratch_path(spark, f"jobs_num_{uuid.uuid4().hex[:6]}")
    cfg = TrainConfig(start="2024-01-01 00:00:00", end="2024-01-22 00:00:00", interval="1 hour", max_features=32,
                      max_depth=4, spec_iter=5, pca_k=2, numeric=True)
    tr = train_job(spark, log, cfg, base, "2024_01_21")
    assert tr["weighted"].first()["accuracy"] >= 0.9
    sinks = {k: scratch_path(spark, f"{k}_{uuid.uuid4().hex[:6]}") for k in ("result", "explain", "features")}
    pr = predict_job(spark, log, base, "2024_01_31", "2024-01-22 00:00:00", "2024-01-31 00:00:00", interval="1 hour", sinks=sinks)
    res = spark.read.parquet(sinks["result"])
    assert res.count() == pr["result"].count() > 0 and len(res.columns) == 25
    assert res.where("att_name IS NULL").count() == 0
    assert spark.read.parquet(sinks["features"]).where("att_name = 'NORMAL'").count() == 0

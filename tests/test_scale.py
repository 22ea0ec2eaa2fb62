"""Rules for scale: numbering, quantiles, hot classes, jobs by URI, streams."""

import uuid

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from wtprof.operators import quantiles, roles, sampling, scaling, topk, vectorize, windows


def test_global_index_with_payload(spark):
    n = 1_000_000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.concat(F.lit("p"), "id").alias("payload"),
                               (F.col("id") % 17).alias("other"))
    got = vectorize.global_index(df, "k")
    row = got.agg(F.count("*").alias("n"), F.count_distinct("idx").alias("d"), F.min("idx").alias("lo"), F.max("idx").alias("hi"),
                  F.sum((F.col("idx") != F.col("k")).cast("int")).alias("moved"), F.count_distinct("payload").alias("p")).first()
    assert tuple(row) == (n, n, 0, n - 1, 0, n)


def test_uncapped_vocabulary(spark, duck):
    docs = spark.range(3000).select("id", F.expr("concat_ws(' ', transform(sequence(1, 40), i -> concat('w', (id * 31 + i * i) % 5003)))").alias("text"))
    vocab = vectorize.tfidf_fit(docs, ["id"], ["text"], None)
    row = vocab.agg(F.count("*"), F.count_distinct("idx"), F.max("idx"), F.count_distinct("term")).first()
    assert row[0] == row[1] == row[2] + 1 == row[3]
    terms = [r["term"] for r in vocab.orderBy("idx").select("term").collect()]
    assert terms == sorted(terms)


def hot(spark):
    """One class holds 90 % of the rows."""
    return spark.range(20_000).select("id", F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("c"))


def test_row_numbering_of_a_hot_class(spark):
    got = windows.row_numbering(hot(spark).unionByName(spark.createDataFrame([(-1, None), (-2, None)], "id long, c string")), ["c"], ["id"])
    for c, n in (("hot", 18_000), ("rare", 2000), (None, 2)):
        rows = [r["row_id"] for r in got.where(F.col("c").eqNullSafe(F.lit(c))).orderBy("id").collect()]
        assert rows == list(range(1, n + 1))


def test_limit_per_class_in_two_levels(spark):
    got = topk.limit_per_class(hot(spark), 50, "c", ["id"])
    assert [r["id"] for r in got.where("c = 'hot'").orderBy("id").collect()] == [i for i in range(60) if i % 10][:50]
    assert got._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 3


def test_random_draws_with_replacement(spark):
    got = sampling.oversample_to_max(hot(spark), "c", ["id"], draw="random")
    counts = {r["c"]: (r["n"], r["d"]) for r in got.groupBy("c").agg(F.count("*").alias("n"), F.count_distinct("id").alias("d")).collect()}
    assert counts["hot"][0] == counts["rare"][0] == 18_000
    assert 0.6 < counts["hot"][1] / 18_000 < 0.67  # 1 - 1/e of the rows are drawn
    again = sampling.oversample_to_max(hot(spark), "c", ["id"], draw="random")
    assert got.exceptAll(again).count() == 0
    even = sampling.sample_fixed_per_class(hot(spark), "c", ["id"], {"hot": 100}, 4100)
    assert {r["c"]: r["count"] for r in even.groupBy("c").count().collect()} == {"hot": 100, "rare": 4100}


def test_exact_quantiles_are_spread(spark):
    df = spark.range(10_001).select(F.when(F.col("id") % 7 == 0, F.lit(3.0)).otherwise(F.sqrt("id")).alias("x"))
    ps = [0.0, 0.1, 0.25, 0.333, 0.5, 0.75, 0.99, 1.0]
    want = df.agg(F.percentile("x", ps)).first()[0]
    assert quantiles.exact_quantiles(df, F.col("x"), ps) == pytest.approx(want, rel=1e-12)
    assert quantiles.exact_quantiles(df.limit(0), F.col("x"), ps) is None
    fitted = scaling.scale_fit(df, ["x"], "robust", lazy=True)
    assert "percentile" not in fitted._jdf.queryExecution().optimizedPlan().toString()


def test_power_fit_leaves_the_first_bracket(spark):
    df = spark.range(1, 4000).select((5 + F.log("id") / 8).alias("x"))
    assert abs(scaling.power_fit(df, ["x"]).first()["x__lambda"]) > 4


def test_role_screen_agrees(spark):
    df = spark.range(500).select("id", (F.col("id") % 10).alias("ten"), (F.col("id") % 11).alias("eleven"), F.lit("v").alias("one"),
                                 F.concat(F.lit("s"), "id").alias("text"), (F.col("id") % 3).cast("string").alias("label"))
    want = {tuple(r) for r in roles.infer_roles(df).select("column_name", "dtype", "role").collect()}
    assert {tuple(r) for r in roles.screen_roles(df).collect()} == want


def test_scratch_folder_must_be_shared_off_local():
    from wtprof.session import checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn"})()

    with pytest.raises(ValueError):
        checkpoint_dir(Cluster())


@pytest.fixture(scope="module")
def log(spark):
    from wtprof.sources.tables import http_log
    return http_log(spark, SF_SMALL)


@pytest.fixture(scope="module")
def base(spark, log):
    """Artifacts of one train run, its outputs appended to sinks."""
    from wtprof.plans.jobs import TrainConfig, train_job
    from wtprof.session import scratch_path
    path = scratch_path(spark, f"jobs_{uuid.uuid4().hex[:8]}")
    sinks = {k: f"{path}/out/{k}" for k in ("nodes", "importance", "epochs", "history")}
    cfg = TrainConfig(start="2024-01-01 00:00:00", end="2024-01-22 00:00:00", interval="1 hour", fit_rows=500,
                      class_ranges={"XSS": ("2024-01-01 00:00:00", "2024-01-15 00:00:00")})
    train_job(spark, log, cfg, path, "2024_01_21", sinks)
    return path


def test_train_outputs_are_written(spark, base):
    history = spark.read.parquet(f"{base}/out/history")
    assert len(set(history.columns)) == len(history.columns) and {"accuracy", "epoch_accuracy"} <= set(history.columns)
    assert history.count() == 4
    assert all(spark.read.parquet(f"{base}/out/{k}").count() for k in ("nodes", "importance", "epochs"))


def predicted(spark, log, base):
    from wtprof.plans.jobs import predict_job
    return predict_job(spark, log, base, "2024_01_31", "2024-01-22 00:00:00", "2024-01-31 00:00:00", interval="1 hour")


def test_predict_by_uri_and_confirmed_explanations(spark, log, base):
    plain = predicted(spark, log, base)
    by_uri = predicted(spark, log, f"file://{base}" if base.startswith("/") else base)
    key = ["lgtime", "src_ip", "dst_ip", "att_name"]
    assert plain["result"].where("att_name NOT IN ('NORMAL', 'ANOMALY')").count() > 0
    assert plain["result"].select(key).exceptAll(by_uri["result"].select(key)).count() == 0
    expl, fused = plain["explanations"], plain["fused"]
    rows = ["lgtime", "src_ip", "dst_ip", "label"]
    assert expl.count() == fused.where("ai_label_pred <> 'NORMAL'").count()
    assert expl.join(fused.where("ai_label_pred = 'NORMAL'"), rows, "left_semi").count() == 0
    assert expl.select(F.size("feature")).distinct().count() == 1  # full rankings
    assert plain["result"].where("`end` <> lgtime + INTERVAL 1 HOUR").count() == 0
    assert plain["features"].where("size(agent_feature) <> size(agent_value)").count() == 0


def test_stream_scoring_equals_batch(spark, log, base):
    from wtprof.operators.filters import predict_filter, time_range
    from wtprof.operators.sessions import session_text_labeled
    from wtprof.plans.jobs import load_artifacts, score_sessions, stream_predict_job
    sessions = session_text_labeled(predict_filter(time_range(log, "2024-01-22 00:00:00", "2024-01-31 00:00:00")), "1 hour")
    sessions.write.parquet(f"{base}/closed")
    stream = spark.readStream.schema(sessions.schema).parquet(f"{base}/closed")
    stream_predict_job(spark, stream, base, "2024_01_31", "1 hour", f"{base}/scored", f"{base}/scored_ckpt")
    cols = ["lgtime", "end", "src_ip", "dst_ip", "att_name", "result", "probs"]
    got = spark.read.parquet(f"{base}/scored").select(cols)
    want = score_sessions(load_artifacts(spark, base, "2024_01_31"), spark.read.parquet(f"{base}/closed"), "1 hour")[0].select(cols)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0

"""Operators on tiny frames: edge cases and invariants."""

import math

import pytest
from pyspark.sql import functions as F

from wtprof.operators import aggregates as AG
from wtprof.operators import encode as EN
from wtprof.operators import filters as C
from wtprof.operators import joins as G
from wtprof.operators import metrics as D
from wtprof.operators import sampling as K
from wtprof.operators import scaling as SC
from wtprof.operators import setops as S
from wtprof.operators import vectorize as V
from wtprof.operators.topk import limit_per_class


@pytest.mark.parametrize("method", ["standard", "minmax", "maxabs", "robust"])
def test_constant_column_scales_to_zero(spark, method):
    df = spark.createDataFrame([(i, 5.0) for i in range(4)], "id int, x double")
    out = SC.scale_transform(df, SC.scale_fit(df, ["x"], method), ["x"], method)
    vals = [r["x"] for r in out.collect()]
    expected = 1.0 if method == "maxabs" else 0.0
    assert all(v == expected for v in vals)


def test_minmax_and_standard_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    mm = sorted(r["x"] for r in SC.scale_transform(df, SC.scale_fit(df, ["x"], "minmax"), ["x"]).collect())
    assert mm == [0.0, 0.5, 1.0]
    st = sorted(r["x"] for r in SC.scale_transform(df, SC.scale_fit(df, ["x"], "standard"), ["x"],
                                                   "standard").collect())
    assert st[2] == pytest.approx(1 / math.sqrt(2 / 3))  # population std


def test_quantile_ties_get_mid_rank(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 2, 2, 3]], "x double")
    fit = SC.scale_fit(df, ["x"], "quantile")
    out = sorted(r["x"] for r in SC.scale_transform(df, fit, ["x"], "quantile").collect())
    assert out[0] == 0.0 and out[-1] == 1.0
    assert out[1] == pytest.approx(0.5)  # the tied middle value sits at its mid rank


def test_power_transform_is_standardised(spark):
    df = spark.createDataFrame([(float(v),) for v in [0.5, 1, 2, 4, 8, 16, 32]], "x double")
    out = [r["x"] for r in SC.scale_transform(df, SC.scale_fit(df, ["x"], "power"), ["x"], "power").collect()]
    mean = sum(out) / len(out)
    var = sum((v - mean) ** 2 for v in out) / len(out)
    assert mean == pytest.approx(0, abs=1e-9) and var == pytest.approx(1, abs=1e-6)


def test_onehot_unknown_is_all_zero_and_inverse_null(spark):
    fit_df = spark.createDataFrame([("a",), ("b",)], "c string")
    df = spark.createDataFrame([(1, "b"), (2, "zz"), (3, None)], "k int, c string")
    fitted = EN.onehot_fit(fit_df, ["c"])
    wide = EN.onehot_transform(df, fitted, ["c"], keep=["k"])
    rows = {r["k"]: (r["a"], r["b"]) for r in wide.collect()}
    assert rows == {1: (0.0, 1.0), 2: (0.0, 0.0), 3: (0.0, 0.0)}
    inv = {r["k"]: r["category"] for r in EN.onehot_inverse(wide, fitted, "c", ["a", "b"]).collect()}
    assert inv == {1: "b", 2: None, 3: None}


def test_tfidf_matches_formula(spark):
    docs = spark.createDataFrame([(1, "apple banana apple"), (2, "banana cherry"), (3, None)], "id int, t string")
    vocab = V.tfidf_fit(docs, ["id"], ["t"], None)
    idf = {r["term"]: r["idf"] for r in vocab.collect()}
    n = 3
    assert idf["apple"] == pytest.approx(math.log((1 + n) / (1 + 1)) + 1)
    assert idf["banana"] == pytest.approx(math.log((1 + n) / (1 + 2)) + 1)
    out = {(r["id"], r["term"]): r["value"] for r in V.tfidf_transform(docs, vocab, ["id"], ["t"]).collect()}
    a, b = 2 * idf["apple"], idf["banana"]
    assert out[(1, "apple")] == pytest.approx(a / math.hypot(a, b))
    _, both, tc = V.tfidf_fit_transform(docs, ["id"], ["t"], None)
    assert sorted(both.select("id", "term").collect()) == sorted(
        V.tfidf_transform(docs, vocab, ["id"], ["t"]).select("id", "term").collect())
    tc.unpersist()


def test_global_index_is_dense(spark):
    df = spark.range(0, 500).select(F.format_string("t%04d", "id").alias("term")).repartition(7)
    idx = sorted((r["term"], r["idx"]) for r in V.global_index(df, "term").collect())
    assert [i for _, i in idx] == list(range(500))


def test_oversample_equal_class_sizes(spark):
    rows = [(i, "a") for i in range(10)] + [(100 + i, "b") for i in range(3)] + [(200, "c")]
    df = spark.createDataFrame(rows, "k int, label string")
    out = K.oversample_to_max(df, "label", ["k"], buckets=4)
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts == {"a": 10, "b": 10, "c": 10}
    assert out.select("k").distinct().count() == 14  # every original row kept


def test_sample_fixed_shrinks_and_grows(spark):
    df = spark.createDataFrame([(i, "a") for i in range(10)] + [(100 + i, "b") for i in range(3)], "k int, label string")
    out = K.sample_fixed_per_class(df, "label", ["k"], {"a": 4}, 7, buckets=4)
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts == {"a": 4, "b": 7}


def test_split_disjoint_and_complete(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    out = K.split_fraction(df, ["k"], 0.7)
    n = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert n["train"] + n["test"] == 1000 and 600 < n["train"] < 800
    again = K.split_fraction(df, ["k"], 0.7)
    assert out.exceptAll(again).count() == 0  # reproducible


def test_class_vs_normal(spark):
    df = spark.createDataFrame([(1, "normal"), (2, "x"), (3, "y"), (4, "z")], "k int, label string")
    out = {(r["k"], r["attack"], r["target"]) for r in K.class_vs_normal(df, "label", ["x", "y"]).collect()}
    assert out == {(1, "x", 0), (1, "y", 0), (2, "x", 1), (3, "y", 1)}


def test_metrics_dense_and_undefined_zero(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "t string, p string")
    cm = {(r["actual"], r["predicted"]): r["cnt"] for r in D.confusion_matrix(df, "t", "p").collect()}
    assert len(cm) == 9 and cm[("c", "c")] == 0 and cm[("a", "b")] == 1
    bm = {r["class"]: r for r in D.binary_metrics(df, "t", "p").collect()}
    assert bm["c"]["precision"] == 0.0 and bm["c"]["recall"] == 0.0 and bm["c"]["f1_score"] == 0.0
    assert bm["b"]["precision"] == pytest.approx(1 / 3)


def test_exclude_keywords_empty_means_no_filter(spark):
    df = spark.createDataFrame([("curl/7", "q1"), ("moz", None)], "http_agent string, http_query string")
    exc = spark.createDataFrame([("http_agent", "curl")], "selectcolumn string, keyword string")
    out = C.exclude_keywords(df, exc, ["http_agent", "http_query"]).collect()
    assert [r["http_agent"] for r in out] == ["moz"]


def test_map_to_class_ignores_unknown_and_empty(spark):
    df = spark.createDataFrame([("n1",), ("n2",), ("n3",)], "note string")
    m = spark.createDataFrame([("n1", "xss"), ("n2", "other")], "note string, mapping string")
    out = [(r["note"], r["mapped_class"]) for r in C.map_to_class(df, m, "note").collect()]
    assert out == [("n1", "xss")]


def test_union_classes_fills_missing(spark):
    a = spark.createDataFrame([(1, 2)], "k int, x int")
    b = spark.createDataFrame([(2, 3)], "k int, y int")
    rows = sorted(S.union_classes([a, b]).collect())
    assert [tuple(r) for r in rows] == [(1, 2, 0), (2, 0, 3)]


def test_tree_parent(spark):
    nodes = spark.createDataFrame([(0, 1, 2), (1, -1, -1), (2, 3, -1), (3, -1, -1)],
                                  "node_num int, node_to_left int, node_to_right int")
    par = {r["node_num"]: r["node_from"] for r in G.tree_parent(nodes).collect()}
    assert par == {0: None, 1: 0, 2: 0, 3: 2}


def test_limit_per_class_with_ranges(spark):
    import datetime as dt
    rows = [(i, "normal" if i % 2 else "x", dt.datetime(2024, 1, 1 + i)) for i in range(10)]
    df = spark.createDataFrame(rows, "k int, label string, logtime timestamp_ntz")
    out = limit_per_class(df, 2, "label", ["logtime"], class_ranges={"normal": ("2024-01-03", "2024-01-31")},
                          default_range=("2024-01-06", "2024-01-31"))
    got = sorted((r["label"], r["k"]) for r in out.collect())
    assert got == [("normal", 3), ("normal", 5), ("x", 6), ("x", 8)]


def test_distinct_counts_ignores_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (2, "b")], "a int, b string")
    got = {r["column_name"]: r["nunique"] for r in AG.distinct_counts(df, ["a", "b"]).collect()}
    assert got == {"a": 2, "b": 2}


def test_boxplot_threshold(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 9)], "score double")
    thr = AG.boxplot_threshold(df, "score").first()["threshold"]
    assert thr == pytest.approx(6.25 + 1.5 * (6.25 - 2.75))


def test_heavy_copies_are_chunked(spark):
    df = spark.createDataFrame([(1, 250_001), (2, 3)], "k int, _copies int")
    out = K._explode_copies(df, chunk=100_000)
    got = {r["k"]: (r["n"], r["lo"], r["hi"], r["d"]) for r in out.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.min("copy").alias("lo"), F.max("copy").alias("hi"),
        F.count_distinct("copy").alias("d")).collect()}
    assert got == {1: (250_001, 1, 250_001, 250_001), 2: (3, 1, 3, 3)}


def test_unbounded_vocabulary_index(spark):
    docs = spark.createDataFrame([(1, "bb aa cc", "zz"), (2, "aa dd", "yy zz")], "id int, t string, u string")
    v = {(r["feature"], r["term"]): r["idx"] for r in V.tfidf_fit(docs, ["id"], ["t", "u"], None).collect()}
    assert v == {("t", "aa"): 0, ("t", "bb"): 1, ("t", "cc"): 2, ("t", "dd"): 3, ("u", "yy"): 0, ("u", "zz"): 1}


def test_fusion_anomaly_wins_option(spark):
    from wtprof.operators import fusion as L
    labels = ["beaconing", "normal", "xss"]
    # raw normal 0.9 above threshold 0.6: the flag is raised, normal also > 0.5
    df = spark.createDataFrame([(1, 0.0, 0.9, 0.0), (2, 0.7, 0.0, 0.0), (3, 0.0, 0.1, 0.2)],
                               "k int, beaconing double, normal double, xss double")
    win = {r["k"]: r["att_name"] for r in L.fuse_scores(df, labels, 0.6, train=True).collect()}
    keep = {r["k"]: r["att_name"] for r in L.fuse_scores(df, labels, 0.6, train=True, anomaly_wins=False).collect()}
    assert win == {1: "ANOMALY", 2: "BEACONING", 3: "NORMAL"}
    assert keep == {1: "NORMAL", 2: "BEACONING", 3: "NORMAL"}


def test_apply_anomaly_recomputes_code(spark):
    from wtprof.operators import fusion as L
    df = spark.createDataFrame([(1, 0.0, 0.9, 0.0)], "k int, beaconing double, normal double, xss double")
    out = L.apply_anomaly(L.fuse_scores(df, ["beaconing", "normal", "xss"]), 0.6).first()
    assert out["att_name"] == "ANOMALY" and out["result"] == 250009


def test_map_to_class_handles_quotes(spark):
    df = spark.createDataFrame([("O'Brien scan",), ("plain",)], "attack_name string")
    m = spark.createDataFrame([("O'Brien scan", "scanning")], "attack_name string, mapping string")
    out = C.map_to_class(df, m, "attack_name", map_key="attack_name").collect()
    assert [(r["attack_name"], r["mapped_class"]) for r in out] == [("O'Brien scan", "scanning")]


def test_distinct_counts_approx_close(spark):
    df = spark.range(0, 20000).select((F.col("id") % 1000).alias("a"))
    exact = AG.distinct_counts(df, ["a"]).first()["nunique"]
    approx = AG.distinct_counts(df, ["a"], approx=True, rsd=0.02).first()["nunique"]
    assert exact == 1000 and abs(approx - 1000) <= 60


def test_column_roles_record(spark):
    from wtprof.operators.roles import ColumnRoles, infer_roles
    df = spark.createDataFrame([(i, f"s{i}", i % 3, "x", f"c{i % 2}") for i in range(20)],
                               "id int, txt string, cat int, label string, c2 string")
    r = ColumnRoles.from_frame(infer_roles(df, index_cols=["id"], label_col="label"))
    assert r.index == ["id"] and r.label == ["label"]
    assert sorted(r.category) == ["c2", "cat"] and r.string == ["txt"] and r.number == []


def _exchanged(df):
    """The columns that the plan shuffles by."""
    import re
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return re.findall(r"Aggregate \[([^\]]*)\]", plan)


def test_tfidf_counts_within_rows(spark):
    """Documents of one row are not grouped by (key, term); repeated and null keys still make one document."""
    docs = spark.createDataFrame([(1, "apple banana apple id"), (2, "banana cherry"), (3, None), (4, "")], "id int, t string")
    assert not any("id#" in keys for keys in _exchanged(V.tfidf_fit(docs, ["id"], ["t"], 10)))
    vocab, out, _ = V.tfidf_fit_transform(docs, ["id"], ["t"], 10)
    assert not any("id#" in keys for keys in _exchanged(out))
    split = spark.createDataFrame([(1, "apple banana"), (1, "apple id"), (2, "banana cherry"), (None, "apple"), (None, "apple plum"), (5, "plum")],
                                  "id int, t string")
    whole = spark.createDataFrame([(1, "apple banana apple id"), (2, "banana cherry"), (None, "apple apple plum"), (5, "plum")], "id int, t string")
    counts = lambda d: {(r["term"], r["idx"], r["df"]) for r in V.tfidf_fit(d, ["id"], ["t"], 10).collect()}
    assert counts(split) == counts(whole)
    some = V.tfidf_fit(whole, ["id"], ["t"], 3)
    got = [{(r["id"], r["term"], r["idx"], round(r["value"], 9)) for r in V.tfidf_transform(d, some, ["id"], ["t"]).collect()} for d in (split, whole)]
    assert got[0] == got[1] and {r[0] for r in got[0]} == {1, 2, None, 5}
    _, both, _ = V.tfidf_fit_transform(split, ["id"], ["t"], 3)
    n = 6  # documents are counted as rows
    assert both.where("id = 1").count() == 2 and V.tfidf_fit(split, ["id"], ["t"], 3).where("term = 'plum'").first()["idf"] == pytest.approx(
        math.log((1 + n) / 3) + 1)


def test_tfidf_ngrams_and_gaps_within_rows(spark):
    docs = spark.createDataFrame([(1, "red id red blue"), (2, "blue red"), (3, "id")], "id int, t string")
    vocab, out, _ = V.tfidf_fit_transform(docs, ["id"], ["t"], 10, n_grams=(1, 2))
    assert [r["term"] for r in vocab.orderBy("idx").collect()] == ["blue", "blue red", "red", "red blue", "red red"]
    part = vocab.where("idx <> 1")  # positions with a gap keep their numbers
    got = {(r["id"], r["term"]): r["idx"] for r in V.tfidf_transform(docs, part, ["id"], ["t"], n_grams=(1, 2)).collect()}
    assert got == {(1, "blue"): 0, (1, "red"): 2, (1, "red blue"): 3, (1, "red red"): 4, (2, "blue"): 0, (2, "red"): 2}
    norm = {r["id"]: r["n"] for r in out.groupBy("id").agg(F.sum(F.col("value") * F.col("value")).alias("n")).collect()}
    assert norm == {1: pytest.approx(1.0), 2: pytest.approx(1.0)}


def test_assemble_from_cells(spark):
    cells = spark.createDataFrame([(1, "x", [(0, 2.0), (3, 0.0), (4, 1.0)]), (2, "y", []), (None, "z", [(1, 1.0)])],
                                  "k int, note string, cells array<struct<idx:int,value:double>>")
    got = {r["note"]: (r["features"].size, dict(zip(r["features"].indices.tolist(), r["features"].values.tolist())))
           for r in V.assemble(cells, ["k"], 5, cells="cells").collect()}
    assert got == {"x": (5, {0: 2.0, 4: 1.0}), "y": (5, {}), "z": (5, {})}


def test_top_terms_in_two_levels(spark):
    """A large k is limited per salt first: the group's last task gets no more than TERM_SALTS x k terms."""
    from wtprof.operators import topk
    t = spark.range(70_000).select(F.lit("f").alias("feature"), F.concat(F.lit("w"), F.lpad("id", 6, "0")).alias("term"), (F.col("id") % 40).alias("cnt"))
    got = topk.top_terms(t, 1500, group=["feature"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2 and "_salt" in plan
    want = sorted(((-(i % 40), f"w{i:06d}") for i in range(70_000)))[:1500]
    assert {r["term"] for r in got.collect()} == {w for _, w in want}

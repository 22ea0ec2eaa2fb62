"""The exact tree against a plain CART, threshold limits and fitted roles."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wtprof.operators import roles, topk
from wtprof.operators.exact_tree import fit_exact_tree, predict_exact_tree


def cart(x, y, depth, labels):
    """{node: (fidx, threshold, counts)} by trying every threshold."""
    out, todo = {}, [(0, list(range(len(y))), 0)]
    def purity(rows):
        return sum(c * c for c in Counter(y[r] for r in rows).values()) / len(rows) if rows else 0.0
    while todo:
        node, rows, level = todo.pop()
        best = None
        if level < depth:
            for f in range(len(x[0])):
                values = sorted({x[r][f] for r in rows})
                for a, b in zip(values, values[1:]):
                    t = a / 2 + b / 2
                    score = round(purity([r for r in rows if x[r][f] <= t]) + purity([r for r in rows if x[r][f] > t]), 9)
                    if best is None or (-score, f, t) < best:
                        best = (-score, f, t)
        counts = Counter(y[r] for r in rows)
        split = best is not None and -best[0] > purity(rows) + 1e-9 * len(rows)
        out[node] = (best[1] if split else None, best[2] if split else None, [counts.get(c, 0) for c in labels])
        if split:
            todo.append((2 * node + 1, [r for r in rows if x[r][best[1]] <= best[2]], level + 1))
            todo.append((2 * node + 2, [r for r in rows if x[r][best[1]] > best[2]], level + 1))
    return out


@pytest.mark.parametrize("seed,depth", [(1, 3), (2, 5)])
def test_nodes_equal_cart(spark, seed, depth):
    rnd = random.Random(seed)
    labels = ["a", "b", "c"]
    x = [[rnd.choice([0.0, 0.0, -1.5, rnd.randint(1, 5), rnd.random()]) for _ in range(4)] for _ in range(160)]
    y = [labels[(v[0] > 0.5) + (v[1] + v[2] > 1)] if rnd.random() < 0.9 else rnd.choice(labels) for v in x]
    rows = spark.createDataFrame([(k, c) for k, c in enumerate(y)] + [(999, None)], "id int, label string").repartition(3)
    entries = spark.createDataFrame([(k, f, float(v)) for k, r in enumerate(x) for f, v in enumerate(r) if v] + [(0, 9, None), (1, 9, float("nan"))],
                                    "id int, fidx int, value double")
    nodes = fit_exact_tree(entries, rows, ["id"], 4, max_depth=depth)
    want = cart(x, y, depth, labels)
    got = {r["node"]: (r["fidx"], r["threshold"], r["counts"]) for r in nodes.collect()}
    assert got == want
    pred = {r["id"]: r["pred"] for r in predict_exact_tree(nodes, entries, rows.where("label is not null"), ["id"]).collect()}
    for k, r in enumerate(x):
        at = 0
        while want[at][0] is not None:
            at = 2 * at + (1 if r[want[at][0]] <= want[at][1] else 2)
        assert pred[k] == labels[want[at][2].index(max(want[at][2]))]


def test_small_trees(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a")], "id int, label string")
    none = spark.createDataFrame([], "id int, fidx int, value double")
    assert [tuple(r) for r in fit_exact_tree(none, rows, ["id"], 2).collect()] == [(0, 0, None, None, 2, [2], "a")]
    assert fit_exact_tree(none, rows.where("false"), ["id"], 2).count() == 0
    split = fit_exact_tree(none, rows.unionAll(spark.createDataFrame([(3, "b")], rows.schema)), ["id"], 2).collect()
    assert len(split) == 1 and split[0]["prediction"] == "a"  # nothing tells them apart


def test_threshold_limit_equals_windows(spark):
    rnd = random.Random(4)
    odd = [None, float("nan"), float("inf"), float("-inf"), 1e308, -1e308, 0.0, 5.0]
    data = [(k, rnd.choice(["hot", "hot", "hot", "rare", None]), rnd.choice([rnd.random(), 5.0, rnd.choice(odd), rnd.gauss(0, 1e6)])) for k in range(3000)]
    data += [(5000, "single", 1.0), (5001, "nulls", None), (5002, "nulls", None)]
    df = spark.createDataFrame(data, "id int, c string, x double").withColumn("_extra", F.lit(1))
    for n in (1, 7, 400, 5000):
        for bins in (4, 4096):
            got = topk.limit_by_threshold(df, n, "c", ["x", "id"], bins)
            assert got.columns == df.columns
            assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in topk.limit_per_class(df, n, "c", ["x", "id"]).collect())
    assert topk.limit_by_threshold(df.where("false"), 3, "c", ["x", "id"]).count() == 0
    with pytest.raises(ValueError):
        topk.limit_by_threshold(df, 3, "c", ["c"])


def test_threshold_limit_ranks_one_bin_only(spark):
    """A class of 90 % of the rows: the rows ranked are those of a bin, not of the class."""
    df = spark.range(50_000).select("id", F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("c"))
    got = topk.limit_by_threshold(df, 20_000, "c", ["id"])
    assert got.groupBy("c").count().collect() and got.where("c = 'hot'").count() == 20_000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    ranked = plan[plan.index("row_number"):]
    assert "_bin" in ranked and "Filter" in ranked  # the window reads rows of the cut bin


def test_fitted_roles(spark):
    kinds = "id int, name string, few int, kind string, amount double, one string, label string"
    fit = spark.createDataFrame([(k, f"n{k}", k % 3, "ab"[k % 2], k * 1.5, "x", "l") for k in range(50)], kinds)
    state = roles.fit_roles(fit, ["id"])
    assert {r["column_name"]: (r["role"], r["fill"]) for r in state.collect()} == {
        "id": ("index", None), "name": ("string", "-"), "few": ("category", "-1"), "kind": ("category", "empty"),
        "amount": ("number", "-1"), "one": ("string", "-"), "label": ("label", None)}
    new = spark.createDataFrame([(None, None, None, None, None, None, None, 3), (1, "n", 1, "a", 2.0, "x", "l", 4)], kinds + ", new int")
    got = roles.apply_roles(new, state).collect()
    assert tuple(got[0]) == (None, "-", -1, "empty", -1.0, "-", None, 3) and tuple(got[1]) == (1, "n", 1, "a", 2.0, "x", "l", 4)
    drift = {r["column_name"]: (r["found_role"], r["nulls"]) for r in roles.role_drift(new, state, ["id"]).collect()}
    assert drift["new"] == ("category", 0) and drift["amount"] == ("number", 1) and drift["name"][1] == 1
    same = roles.role_drift(fit, state, ["id"])
    assert same.count() == 0
    for changed in (new.withColumn("amount", F.col("amount").cast("string")), new.drop("amount")):
        with pytest.raises(ValueError, match="amount"):
            roles.apply_roles(changed, state)

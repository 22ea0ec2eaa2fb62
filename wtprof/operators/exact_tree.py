"""An exact classification tree (L1): every threshold between distinct values.

Spark ML's tree looks at binned thresholds. This one grows a level a pass with
the split that CART takes: for each open node and feature the distinct values
are sorted, class counts are added up along them, and the threshold midway
between two neighbours with the least weighted Gini impurity wins (ties: the
smallest feature, then the smallest threshold).

Rows stay sparse: a feature's missing entries are one more distinct value,
zero, whose class counts are the node's less those of the entries. Sorted
values are range-partitioned and written with their partition number; sums run
within a partition and the sums of earlier partitions are added, so a node or
feature with very many values is no single task's work. What joins by
broadcast is a row for each open node, or for each node, feature and partition
of the sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wtprof.operators.vectorize import small_side
from wtprof.session import materialize

NODES = "node long, level int, fidx int, threshold double, n long, counts array<bigint>, prediction string"


def _purity(counts: list[Column]) -> Column:
    """Σ count² / n: n less the Gini impurity's share of n."""
    n = sum(counts[1:], counts[0])
    return F.coalesce(sum((c * c for c in counts[1:]), counts[0] * counts[0]) / F.nullif(n.cast("double"), F.lit(0.0)), F.lit(0.0))


def best_splits(cells: DataFrame, total: DataFrame, classes: int) -> DataFrame:
    """``(node, fidx, threshold, purity)`` of each node's best split; no row
    for a node whose features have one value each. ``cells``: (node, fidx,
    value, c0…), ``total``: (node, t0…), a row for each open node."""
    c, t = [f"c{k}" for k in range(classes)], [f"t{k}" for k in range(classes)]
    by = ["node", "fidx"]
    cut = materialize(cells.orderBy(*by, "value").withColumn("pid", F.spark_partition_id()))
    parts = cut.groupBy(*by, "pid").agg(*[F.sum(x).alias(x) for x in c], F.min("value").alias("first"))
    w = Window.partitionBy(*by).orderBy("pid")
    parts = parts.select(*by, "pid", *[(F.sum(x).over(w) - F.col(x)).alias(f"b_{x}") for x in c], F.lead("first").over(w).alias("after"))
    local = Window.partitionBy(*by, "pid").orderBy("value")
    run = local.rowsBetween(Window.unboundedPreceding, 0)
    rows = cut.select(*by, "pid", "value", F.lead("value").over(local).alias("next"), *[F.sum(x).over(run).alias(x) for x in c])
    rows = rows.join(small_side(parts), [*by, "pid"]).join(F.broadcast(total), "node")
    left = [F.col(x) + F.col(f"b_{x}") for x in c]
    right = [F.col(b) - a for a, b in zip(left, t)]
    following = F.coalesce("next", "after")
    # rounded, so that equal purities of unequal sums tie
    score = F.round(_purity(left) + _purity(right), 9)
    rows = rows.where(following.isNotNull()).select("node", "fidx", (F.col("value") / 2 + following / 2).alias("threshold"), score.alias("purity"))
    best = F.min(F.struct((-F.col("purity")).alias("p"), "fidx", "threshold")).alias("b")
    return rows.groupBy("node").agg(best).select("node", "b.fidx", "b.threshold", (-F.col("b.p")).alias("purity"))


def fit_exact_tree(entries: DataFrame, rows: DataFrame, key: Sequence[str], features: Sequence[int] | int, max_depth: int = 10,
                   label_col: str = "label", feature_col: str = "fidx", value_col: str = "value") -> DataFrame:
    """L1: the nodes (node, level, fidx, threshold, n, counts, prediction) of
    an exact CART of at most ``max_depth`` levels of splits.

    ``rows``: key and label, ``entries``: the non-zero features (key, fidx,
    value); ``features``: how many there are. Node 0 is the root; the children
    of node i are 2i+1 (value <= threshold) and 2i+2. Leaves have null fidx and
    threshold. ``counts`` are by class in sorted order; the prediction is the
    most frequent class (ties: the first). A node is split while it is impure
    and some split lowers its impurity. Rows without a label are not read;
    null and NaN values count as zero, and a repeated (key, fidx) is an error
    of the caller. An empty table gives no nodes."""
    key = list(key)
    labels = sorted(r[0] for r in rows.select(label_col).distinct().collect() if r[0] is not None)
    spark = rows.sparkSession
    if not labels:
        return spark.createDataFrame([], NODES)
    classes = len(labels)
    c, t = [f"c{k}" for k in range(classes)], [f"t{k}" for k in range(classes)]
    index = F.array_position(F.array(*map(F.lit, labels)), F.col(label_col)) - 1
    at = materialize(rows.where(F.col(label_col).isNotNull()).select(*key, index.alias("_class"), F.lit(0).cast("long").alias("node")))
    value = F.col(value_col).cast("double")
    cells_in = entries.select(*key, F.col(feature_col).cast("int").alias("fidx"), value.alias("value")).where(
        value.isNotNull() & ~F.isnan(value) & (value != 0))
    if isinstance(features, int):
        features = range(features)
    every = F.array(*[F.lit(int(f)) for f in features]) if len(features) <= 1000 else F.sequence(F.lit(min(features)), F.lit(max(features)))
    counted = [F.count_if(F.col("_class") == k).alias(x) for k, x in enumerate(c)]
    made = []
    for level in range(max_depth + 1):
        total = materialize(at.groupBy("node").agg(*[x.alias(y) for x, y in zip(counted, t)]))  # a row for each open node
        purity = _purity([F.col(x) for x in t])
        n = sum((F.col(x) for x in t[1:]), F.col(t[0]))
        split = None
        if level < max_depth:
            filled = cells_in.join(at, key).groupBy("node", "fidx", "value").agg(*counted)
            grid = total.select("node", F.explode(every).alias("fidx"), *t)
            there = filled.groupBy("node", "fidx").agg(*[F.sum(x).alias(x) for x in c])
            zero = grid.join(there, ["node", "fidx"], "left").select(
                "node", "fidx", F.lit(0.0).alias("value"), *[(F.col(b) - F.coalesce(F.col(a), F.lit(0))).alias(a) for a, b in zip(c, t)])
            zero = zero.where(sum((F.col(x) for x in c[1:]), F.col(c[0])) > 0)
            split = best_splits(filled.unionByName(zero), total, classes)
            split = split.join(F.broadcast(total.select("node", purity.alias("_before"), n.alias("_n"))), "node")
            split = materialize(split.where(F.col("purity") > F.col("_before") + 1e-9 * F.col("_n")).select("node", "fidx", "threshold"))
        counts = F.array(*[F.col(x) for x in t])
        best = F.get(F.array(*map(F.lit, labels)), (F.array_position(counts, F.array_max(counts)) - 1).cast("int"))
        nodes = total.join(F.broadcast(split), "node", "left") if split is not None else total.select(
            "*", F.lit(None).cast("int").alias("fidx"), F.lit(None).cast("double").alias("threshold"))
        made.append(nodes.select("node", F.lit(level).alias("level"), "fidx", "threshold", n.alias("n"), counts.alias("counts"), best.alias("prediction")))
        if split is None or split.count() == 0:
            break
        moving = at.join(F.broadcast(split), "node")
        there = cells_in.join(moving.select(*key, "fidx"), [*key, "fidx"])
        at = materialize(moving.join(there, [*key, "fidx"], "left").select(
            *key, "_class", (F.col("node") * 2 + F.when(F.coalesce("value", F.lit(0.0)) <= F.col("threshold"), 1).otherwise(2)).alias("node")))
    out = made[0]
    for m in made[1:]:
        out = out.unionByName(m)
    return materialize(out)


def predict_exact_tree(nodes: DataFrame, entries: DataFrame, rows: DataFrame, key: Sequence[str], feature_col: str = "fidx",
                       value_col: str = "value", out: str = "pred") -> DataFrame:
    """``rows`` with the prediction of the leaf they fall into. A level is a
    join with its nodes (broadcast after a check of their size) and with the
    entries of the features they split on."""
    key = list(key)
    cells = entries.select(*key, F.col(feature_col).cast("int").alias("fidx"), F.col(value_col).cast("double").alias("_v"))
    at = rows.withColumn("_node", F.lit(0).cast("long"))
    depth = nodes.agg(F.max("level")).first()[0] or 0
    for level in range(depth):
        here = small_side(nodes.where((F.col("level") == level) & F.col("fidx").isNotNull()).select(F.col("node").alias("_node"), "fidx", "threshold"))
        at = at.join(here, "_node", "left").join(cells, [*key, "fidx"], "left")
        low = F.coalesce(F.nanvl("_v", F.lit(0.0)), F.lit(0.0)) <= F.col("threshold")
        at = at.withColumn("_node", F.when(F.col("fidx").isNull(), F.col("_node")).otherwise(F.col("_node") * 2 + F.when(low, 1).otherwise(2)))
        at = at.drop("fidx", "threshold", "_v")
    leaves = nodes.where("fidx IS NULL").select(F.col("node").alias("_node"), F.col("prediction").alias(out))
    return at.join(small_side(leaves), "_node", "left").select(*rows.columns, out)

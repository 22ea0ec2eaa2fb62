"""Embedding near-duplicates by a forest of random-projection trees.

Equal vectors are one class from the start. Each tree splits the classes by
their projection on a random direction at the median of a bounded sample, again
and again, and both sides keep the rows within a margin of the threshold
(spill). Vectors that share a leaf in some tree are compared exactly in double
precision. A pair is counted in the first of its common leaves only, which each
row knows for all trees, so link counts need no shuffle of pairs, and a leaf
returns no more than its rows: link counts and a spanning set of links, which
are then united into components.

Leaves that will hold more rows than a task should compare are cut into
blocks, and each pair of blocks is a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wtprof.llm.common import importable, written
from wtprof.llm.graph import LocalUnion, components

THRESHOLD = 0.95
TREES = 5
SAMPLE = 20_000        # classes the trees are fitted on (by hash); every class is indexed
LEAF_ROWS = 256        # a node expected to hold fewer rows is not split
LEAF_SAMPLE = 12       # nor one with fewer sampled rows
BLOCK_ROWS = 4096      # rows of a block of a large leaf
SPILL = 0.6            # margin, in standard deviations of a threshold pair's projected difference
MAX_SPILL = 0.5        # a node whose split would copy a larger share stays a leaf
MAX_DEPTH = 30
STEP = 512             # rows compared with their leaf at a time


class Tree:
    """One direction for each level; thresholds from the sample's medians."""

    def __init__(self, sample: np.ndarray, total: int, margin: float, seed: int):
        rng = np.random.default_rng(seed)
        dim = sample.shape[1]
        self.directions = rng.standard_normal((MAX_DEPTH, dim))
        self.directions /= np.linalg.norm(self.directions, axis=1, keepdims=True)
        self.margin = margin
        proj = sample @ self.directions.T
        share = total / max(1, len(sample))
        threshold, low, high, blocks = [], [], [], []
        todo = [(np.arange(len(sample)), 0, -1, False)]
        while todo:
            rows, depth, parent, is_high = todo.pop()
            me = len(threshold)
            if parent >= 0:
                (high if is_high else low)[parent] = me
            threshold.append(np.nan)
            low.append(-1)
            high.append(-1)
            blocks.append(max(1, int(np.ceil(len(rows) * share / BLOCK_ROWS))))
            if len(rows) * share <= LEAF_ROWS or len(rows) < 2 * LEAF_SAMPLE or depth >= MAX_DEPTH:
                continue
            p = proj[rows, depth]
            cut = float(np.median(p))
            below, above = rows[p <= cut + margin], rows[p > cut - margin]
            if len(below) + len(above) - len(rows) > MAX_SPILL * len(rows) or not len(above) or len(below) == len(rows):
                continue
            threshold[me] = cut
            todo += [(below, depth + 1, me, False), (above, depth + 1, me, True)]
        self.threshold, self.low, self.high = np.array(threshold), np.array(low), np.array(high)
        self.blocks = np.array(blocks)

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf each row falls into."""
        proj = x @ self.directions.T
        rows, nodes, out = np.arange(len(x)), np.zeros(len(x), np.int64), []
        depth = 0
        while len(rows):
            done = np.isnan(self.threshold[nodes])
            out.append((rows[done], nodes[done]))
            rows, nodes = rows[~done], nodes[~done]
            p, cut = proj[rows, min(depth, MAX_DEPTH - 1)], self.threshold[nodes]
            a, b = p <= cut + self.margin, p > cut - self.margin
            rows, nodes = np.concatenate([rows[a], rows[b]]), np.concatenate([self.low[nodes[a]], self.high[nodes[b]]])
            depth += 1
        return np.concatenate([r for r, _ in out]), np.concatenate([n for _, n in out])


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision (by their largest
    component first, so that nothing overflows)."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _leaf_links(key_leaf: int, ids: np.ndarray, x: np.ndarray, copies: np.ndarray, sets: np.ndarray,
                left: np.ndarray, right: np.ndarray, same: bool, threshold: float) -> pd.DataFrame:
    """Link counts and spanning links of one block pair of a leaf."""
    degree = np.zeros(len(ids), np.int64)
    union = LocalUnion(len(ids))
    xr = x[right]
    for k in range(0, len(left), STEP):
        part = left[k:k + STEP]
        a, b = np.nonzero(x[part] @ xr.T >= threshold)
        a, b = part[a], right[b]
        if same:
            a, b = a[a < b], b[a < b]
        if not len(a):
            continue
        first = np.zeros(len(a), bool)   # is this leaf the first that both are in?
        open_ = np.ones(len(a), bool)
        for w in range(sets.shape[1]):
            mine = sets[a, w]
            hit = open_ & (mine >= 0) & (sets[b] == mine[:, None]).any(axis=1)
            first |= hit & (mine == key_leaf)
            open_ &= ~hit
            if not open_.any():
                break
        np.add.at(degree, a[first], copies[b[first]])
        np.add.at(degree, b[first], copies[a[first]])
        union.add(a, b)
    got = np.flatnonzero(degree)
    node, label = union.links()
    # one row kind for counts (b null) and one for links (n null)
    return pd.DataFrame({"a": np.concatenate([ids[got], ids[node]]),
                         "b": pd.array([None] * len(got) + ids[label].tolist(), dtype="Int64"),
                         "n": pd.array(degree[got].tolist() + [None] * len(node), dtype="Int64")})


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                    trees: int = TREES, sample: int = SAMPLE, seed: int = 11) -> DataFrame:
    """Link rows whose vectors have cosine >= ``threshold``.

    Returns one row for each input row: id_col, n_links (other rows linked
    directly), component_id (smallest id reachable, itself included), kept
    (id equals component_id). A vector that is null, empty, zero, or holds a
    null or non-finite component links with nothing and is its own component.
    Vectors of different length never link. Equal vectors always link. Null
    ids are kept and never a component's smallest id (a component of null ids
    has a null component_id and nothing kept). An empty table gives an empty
    result; other columns are ignored. Pairs found are exact; a pair is missed
    only if no tree has a leaf with both.
    """
    spark = df.sparkSession
    importable(spark)
    v = F.col("v")
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    usable = (v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
              & F.exists(v, lambda x: x != 0))
    same = rows.where(usable).groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    classes = written(same.select(F.monotonically_increasing_id().alias("cid"), "v", "least", "copies"), "classes")
    links = None
    for dim, total in sorted((r[0], r[1]) for r in classes.groupBy(F.size("v")).count().collect()):  # few widths
        part = _links(classes.where(F.size("v") == dim), dim, total, threshold, trees, sample, seed)
        links = part if links is None else links.union(part)
    if links is None:
        links = spark.createDataFrame([], "a long, b long, n long")
    links = written(links, "links")
    counts = links.where("n is not null").groupBy("a").agg(F.sum("n").alias("others"))
    root = components(links.where("b is not null").select("a", "b"))
    known = (classes.join(counts, classes["cid"] == counts["a"], "left").join(root, classes["cid"] == root["node"], "left")
             .select("v", "least", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                     F.coalesce("root", "cid").alias("root")))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(least, "root").select("v", "n_links", "component_id", F.lit(True).alias("linked"))
    out = rows.join(known, "v", "left")
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def _links(classes: DataFrame, dim: int, total: int, threshold: float, trees: int, sample: int, seed: int) -> DataFrame:
    """(a, b, n) rows: n links of class a in a leaf (b null), or a link a-b."""
    drawn = classes.orderBy(F.xxhash64("cid"), "cid").limit(sample).select("v").collect()
    x = unit(np.array([r[0] for r in drawn]))
    spread = np.sqrt(max(0.0, 2 - 2 * threshold)) / np.sqrt(dim)
    forest = [Tree(x, total, SPILL * spread, seed + k) for k in range(trees)]
    shared = classes.sparkSession.sparkContext.broadcast(forest)  # bounded by the sample

    def spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cid = batch.column("cid").to_numpy()
            m = unit(_matrix(batch.column("v")))
            row, leaf, blocks = [], [], []
            for t, tree in enumerate(shared.value):
                r, n = tree.leaves(m)
                row.append(r)
                leaf.append(n + (t << 32))
                blocks.append(tree.blocks[n])
            row, leaf, blocks = map(np.concatenate, (row, leaf, blocks))
            order = np.lexsort((leaf, row))
            row, leaf, blocks = row[order], leaf[order], blocks[order]
            begin = np.searchsorted(row, np.arange(len(m) + 1)).astype(np.int32)
            # a row of a leaf of s blocks goes to the s block pairs with its block
            own = cid[row] * np.int64(2654435761) % 1000003 % blocks
            copy = np.repeat(np.arange(len(row)), blocks)
            other = np.arange(len(copy)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            mine = own[copy]
            source = row[copy]
            lists = pa.ListArray.from_arrays(pa.array(begin), pa.array(leaf))
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf[copy]), pa.array(np.minimum(mine, other)), pa.array(np.maximum(mine, other)),
                 pa.array(mine), pa.array(cid[source]), batch.column("copies").take(pa.array(source)),
                 lists.take(pa.array(source)), batch.column("v").take(pa.array(source))],
                ["leaf", "i", "j", "block", "cid", "copies", "leaves", "v"])

    def compare(table: pa.Table) -> pa.Table:
        leaf, i, j = (table.column(c)[0].as_py() for c in ("leaf", "i", "j"))
        ids, copies = table.column("cid").to_numpy(), table.column("copies").to_numpy()
        block = table.column("block").to_numpy()
        own = table.column("leaves").to_pylist()
        sets = np.full((len(ids), max(map(len, own))), -1, np.int64)
        for k, s in enumerate(own):
            sets[k, :len(s)] = s
        m = unit(_matrix(table.column("v").combine_chunks()))
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        out = _leaf_links(leaf, ids, m, copies, sets, left, right, i == j, threshold)
        return pa.Table.from_pandas(out, pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())]),
                                    preserve_index=False)

    spread_rows = classes.select("cid", "copies", "v").mapInArrow(
        spill, "leaf long, i long, j long, block long, cid long, copies long, leaves array<long>, v array<double>")
    return spread_rows.groupBy("leaf", "i", "j").applyInArrow(compare, "a long, b long, n long")

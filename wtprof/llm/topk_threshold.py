"""Exact top-k search by inner product with a three-phase uniform threshold.

A score is the sum of partial scores, one for each slice of the dimensions; the
partial scores of a slice with one block of candidates are a node's local list.
No node sees more than its slice.

1. Gather: every node sends the best entries of its list for each query. The
   sums of the entries gathered are completed; the k-th best of them is the
   cutoff, which no true result lies below.
2. The cutoff is sent to every node (with the query block), which sends all
   entries of at least cutoff / lists: a candidate below that in every list
   stays below the cutoff. Entries seen in all lists are exact already and
   raise the cutoff; the others have an upper bound.
3. Candidates whose bound reaches the raised cutoff are resolved exactly.

Scores are integers, so every comparison is exact. Equal vectors are one class,
searched once whether as query or as candidate; a class keeps its k + 1
smallest ids, as no result needs more. Classes are numbered in the order of
their smallest id, so ties between classes go to the smaller number.

Queries and candidates meet in cells of one query block and one candidate
block, each a task's worth; lists travel as arrays of (query, class) keys and
scores. Work is a matrix product for each cell, as any exact search over all
rows needs; what is sent is a small share of it.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wtprof.llm.common import hot_join, importable, numbered, written

SCALE = 64
LIMIT = 20
EVERY = 20            # rows whose id is divisible by this are queries
STEP = 128            # queries multiplied at a time
SHIFT = 40            # a key is query position << SHIFT | class number
NEVER = -(1 << 62)    # below every score
ENTRIES = "a long, b long, e binary"


class Sizes(NamedTuple):
    """How the work is cut; no result depends on it."""

    lists: int = 2            # slices of the dimensions
    gather: int = 64          # entries a node sends for a query in the first phase
    query_rows: int = 1024    # queries of a block
    block_rows: int = 4096    # candidates of a block
    fan: int = 32             # lists merged at a time


def _usable(v: Column) -> Column:
    squares = F.aggregate(v, F.lit(0.0), lambda s, c: s + c * c)
    return v.isNotNull() & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) & (
        squares * SCALE * SCALE < float(1 << 60))


def pack(key: np.ndarray, score: np.ndarray) -> bytes:
    return np.concatenate([key.astype(np.int64), score.astype(np.int64)]).tobytes()


def unpack(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and scores of some packed lists."""
    both = [np.frombuffer(r, np.int64).reshape(2, -1) for r in raw]
    return tuple(np.concatenate(both, axis=1)) if both else (np.zeros(0, np.int64),) * 2


def best(key: np.ndarray, score: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``limit`` best entries of each query, without repeats: by score,
    then by class number."""
    key, at = np.unique(key, return_index=True)
    score = score[at]
    query = key >> SHIFT
    order = np.lexsort((key, -score, query))
    query = query[order]
    first = np.searchsorted(query, query)
    order = order[np.arange(len(order)) - first < limit]
    return key[order], score[order]


def cutoffs(key: np.ndarray, score: np.ndarray, limit: int, queries: int) -> np.ndarray:
    """The ``limit``-th best score of each query, or NEVER."""
    key, score = best(key, score, limit)
    out = np.full(queries, NEVER, np.int64)
    place, count = np.unique(key >> SHIFT, return_counts=True)
    full = count == limit
    out[place[full]] = score[np.cumsum(count)[full] - 1]
    return out


def products(q: np.ndarray, c: np.ndarray):
    """(first query, block of partial scores) in steps: exact doubles where
    they are integers below 2^53, else longs."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    kind = np.float64 if bound < 2 ** 53 else np.int64
    q, c = q.astype(kind), np.ascontiguousarray(c.astype(kind).T)
    for k in range(0, len(q), STEP):
        yield k, q[k:k + STEP] @ c


def _matrix(row: dict) -> np.ndarray:
    m = np.frombuffer(row["data"], np.int64)
    return m.reshape(row["n"], len(m) // row["n"])


def _cell(table: pa.Table) -> tuple[int, int, dict[int, list[dict]]]:
    """Block numbers and the rows of each kind (0 queries, 1 candidates, 2 cutoffs, 3 lists), slices in order."""
    rows = sorted(table.to_pylist(), key=lambda r: r["j"])
    return rows[0]["a"], rows[0]["b"], {k: [r for r in rows if r["kind"] == k] for k in range(4)}


def _result(**columns) -> pa.Table:
    kinds = {"a": pa.int64(), "b": pa.int64(), "j": pa.int32(), "done": pa.bool_(), "e": pa.binary()}
    return pa.table({c: pa.array(v, kinds[c]) for c, v in columns.items()})


def _local_list(sizes: Sizes):
    """Phase 1 at one node: the best entries of each query."""
    def run(table: pa.Table) -> pa.Table:
        a, b, kind = _cell(table)
        q, c = _matrix(kind[0][0]), _matrix(kind[1][0])
        take = min(sizes.gather, len(c))
        keys, scores = [], []
        for k, s in products(q, c):
            col = np.argpartition(-s, take - 1, axis=1)[:, :take]
            query = np.broadcast_to(np.arange(k, k + len(s))[:, None], col.shape)
            keys.append((query << SHIFT | (col + b * sizes.block_rows)).ravel())
            scores.append(np.take_along_axis(s, col, axis=1).ravel())
        return _result(a=[a], b=[b], e=[pack(np.concatenate(keys), np.concatenate(scores))])
    return run


def _sent(sizes: Sizes):
    """Phase 2 at one node: every entry of at least cutoff / lists."""
    def run(table: pa.Table) -> pa.Table:
        a, b, kind = _cell(table)
        q, c = _matrix(kind[0][0]), _matrix(kind[1][0])
        low = -(-np.frombuffer(kind[2][0]["data"], np.int64) // kind[2][0]["n"])
        keys, scores = [], []
        for k, s in products(q, c):
            query, col = np.nonzero(s >= low[k:k + len(s), None])
            keys.append((query + k) << SHIFT | (col + b * sizes.block_rows))
            scores.append(s[query, col])
        return _result(a=[a], b=[b], j=[kind[0][0]["j"]], e=[pack(np.concatenate(keys), np.concatenate(scores))])
    return run


def _joined(limit: int):
    """Phase 2 of a cell: exact sums (the best of each query) of the entries
    seen in all lists, and upper bounds of the others."""
    def run(table: pa.Table) -> pa.Table:
        a, b, kind = _cell(table)
        lists, cut = kind[2][0]["n"], np.frombuffer(kind[2][0]["data"], np.int64)
        key, score = unpack([r["data"] for r in kind[3]])
        key, at, seen = np.unique(key, return_inverse=True, return_counts=True)
        known = np.zeros(len(key), np.int64)
        np.add.at(known, at, score)
        full = seen == lists
        tau = cut[key >> SHIFT]
        bound = known + (lists - seen) * (-(-tau // lists) - 1)
        open_ = ~full & (bound >= tau)
        done = best(key[full], known[full], limit)
        return _result(a=[a, a], b=[b, b], done=[True, False], e=[pack(*done), pack(key[open_], bound[open_])])
    return run


def _resolved(limit: int, sizes: Sizes):
    """Exact scores of the entries of a cell, from all slices."""
    def run(table: pa.Table) -> pa.Table:
        a, b, kind = _cell(table)
        key, _ = unpack([r["data"] for r in kind[3]])
        key = np.unique(key)
        q, c = (np.concatenate([_matrix(r) for r in kind[k]], axis=1) for k in (0, 1))
        query, col = key >> SHIFT, (key & ((1 << SHIFT) - 1)) - b * sizes.block_rows
        score = np.concatenate([np.einsum("ij,ij->i", q[query[k:k + 65536]], c[col[k:k + 65536]])
                                for k in range(0, len(key), 65536)])
        return _result(a=[a], b=[b], e=[pack(*best(key, score, limit))])
    return run


def _merged(lists: DataFrame, blocks: int, limit: int, fan: int) -> DataFrame:
    """One list for each query block: the lists of its candidate blocks
    merged ``fan`` at a time, so that no task holds many."""
    def merge(table: pa.Table) -> pa.Table:
        key, score = unpack(table.column("e").to_pylist())
        return _result(a=[table.column("a")[0].as_py()], b=[table.column("b")[0].as_py()], e=[pack(*best(key, score, limit))])

    while True:
        blocks = -(-blocks // fan)
        lists = (lists.select("a", F.floor(F.col("b") / fan).alias("b"), "e").groupBy("a", "b").applyInArrow(merge, ENTRIES))
        if blocks <= 1:
            return lists


def _kind(df: DataFrame, kind: int, **columns) -> DataFrame:
    named = {"a": F.col("a"), "b": F.col("b"), "j": F.lit(0), "n": F.lit(0), "data": F.col("e")} | columns
    return df.select(*(named[c].cast(t).alias(c) for c, t in (("a", "long"), ("b", "long"), ("j", "int"), ("n", "int"),
                                                               ("data", "binary"))), F.lit(kind).alias("kind"))


def _blocks(classes: DataFrame, rows: int, lists: int, name: str) -> DataFrame:
    """(block, j, n, data): slice j of the vectors of each run of ``rows`` classes."""
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("idx").to_numpy())
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        m = flat.reshape(len(order), -1)[order] if len(flat) else np.zeros((len(order), 0), np.int64)
        parts = np.array_split(m, lists, axis=1)
        return pa.table({"block": pa.array([table.column("block")[0].as_py()] * lists, pa.int64()),
                         "j": pa.array(range(lists), pa.int32()), "n": pa.array([len(m)] * lists, pa.int32()),
                         "data": pa.array([np.ascontiguousarray(p).tobytes() for p in parts], pa.binary())})

    block = F.floor(F.col("idx") / rows).alias("block")
    return written(classes.select("idx", "v", block).groupBy("block").applyInArrow(run, "block long, j int, n int, data binary"), name)


def _search(queries: DataFrame, classes: DataFrame, width: int, n_queries: int, n_classes: int, limit: int,
            sizes: Sizes) -> DataFrame:
    """(qidx, idx, score): the ``limit`` best classes of every query class."""
    lists = max(1, min(sizes.lists, width))
    na, nb = -(-n_queries // sizes.query_rows), -(-n_classes // sizes.block_rows)
    qb, cb = _blocks(queries, sizes.query_rows, lists, "queries"), _blocks(classes, sizes.block_rows, lists, "candidates")
    every_a = F.explode(F.sequence(F.lit(0), F.lit(na - 1))).alias("a")
    every_b = F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("b")
    q = _kind(qb.select(F.col("block").alias("a"), every_b, "j", "n", "data"), 0, j=F.col("j"), n=F.col("n"), data=F.col("data"))
    c = _kind(cb.select(every_a, F.col("block").alias("b"), "j", "n", "data"), 1, j=F.col("j"), n=F.col("n"), data=F.col("data"))

    def resolved(entries: DataFrame) -> DataFrame:
        """Exact lists of the cells that have entries; whole vectors go there only."""
        cells = entries.select("a", "b").distinct()
        mine = [f.join(cells, ["a", "b"], "left_semi") for f in (q, c)]
        return reduce(DataFrame.unionByName, [*mine, _kind(entries, 3)]).groupBy("a", "b").applyInArrow(
            _resolved(limit, sizes), ENTRIES)

    def by_cell(table: pa.Table) -> pa.Table:
        key, score = unpack(table.column("e").to_pylist())
        block = (key & ((1 << SHIFT) - 1)) // sizes.block_rows
        order = np.argsort(block, kind="stable")
        there, first = np.unique(block[order], return_index=True)
        return _result(a=[table.column("a")[0].as_py()] * len(there), b=there,
                       e=[pack(key[part], score[part]) for part in np.split(order, first[1:])] if len(there) else [])

    def cutoff(exact: DataFrame, name: str) -> DataFrame:
        def run(table: pa.Table) -> pa.Table:
            key, score = unpack(table.column("e").to_pylist())
            return _result(a=[table.column("a")[0].as_py()], b=[0],
                           e=[cutoffs(key, score, limit, sizes.query_rows).tobytes()])
        return written(_merged(exact, nb, limit, sizes.fan).groupBy("a").applyInArrow(run, ENTRIES), name)

    # phase 1: local lists, completed; their k-th best score is a safe cutoff
    local = q.unionByName(c).groupBy("a", "b", "j").applyInArrow(_local_list(sizes), ENTRIES)
    gathered = _merged(local, nb, sizes.gather, sizes.fan).groupBy("a").applyInArrow(by_cell, ENTRIES)
    exact = written(resolved(written(gathered, "gathered")), "gathered-exact")
    low = cutoff(exact, "cutoff").select("a", every_b, "e")

    # phase 2: what reaches the cutoff's share in some list
    at_node = low.select("a", "b", F.explode(F.sequence(F.lit(0), F.lit(lists - 1))).alias("j"), "e")
    nodes = reduce(DataFrame.unionByName, [q, c, _kind(at_node, 2, j=F.col("j"), n=F.lit(lists))])
    sent = nodes.groupBy("a", "b", "j").applyInArrow(_sent(sizes), "a long, b long, j int, e binary")
    cells = _kind(sent, 3, j=F.col("j")).unionByName(_kind(low, 2, n=F.lit(lists)))
    joined = written(cells.groupBy("a", "b").applyInArrow(_joined(limit), "a long, b long, done boolean, e binary"), "sent")
    exact = exact.unionByName(joined.where("done").select("a", "b", "e"))
    raised = cutoff(exact, "raised")

    # phase 3: open entries whose bound reaches the raised cutoff
    def pruned(table: pa.Table) -> pa.Table:
        a, b, kind = _cell(table)
        if not kind[3]:
            return _result(a=[], b=[], e=[])
        key, bound = unpack([r["data"] for r in kind[3]])
        keep = bound >= np.frombuffer(kind[2][0]["data"], np.int64)[key >> SHIFT]
        return _result(a=[a] if keep.any() else [], b=[b] if keep.any() else [],
                       e=[pack(key[keep], bound[keep])] if keep.any() else [])

    open_ = _kind(joined.where("not done"), 3).unionByName(_kind(raised.select("a", every_b, "e"), 2))
    rest = written(open_.groupBy("a", "b").applyInArrow(pruned, ENTRIES), "open")
    top = _merged(exact.unionByName(resolved(rest)), nb, limit, sizes.fan)

    def rows(batches):
        for batch in batches:
            for a, e in zip(batch.column("a").to_pylist(), batch.column("e").to_pylist()):
                key, score = unpack([e])
                yield pa.RecordBatch.from_arrays([pa.array((key >> SHIFT) + a * sizes.query_rows), pa.array(key & ((1 << SHIFT) - 1)),
                                                  pa.array(score)], ["qidx", "idx", "score"])

    return written(top.select("a", "e").mapInArrow(rows, "qidx long, idx long, score long"), "top")


def top_k(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", limit: int = LIMIT, every: int = EVERY,
          sizes: Sizes = Sizes()) -> DataFrame:
    """The ``limit`` best candidates of each query row (id divisible by
    ``every``) by integer inner product of floor(64 x).

    Returns query_id, rank int (from 1), id_col, score long. Candidates are all
    rows of another id than the query's; ties go to the smaller id, a null id
    last. Fewer candidates give fewer rows, none give none.

    Vectors take no part that are null, hold null or non-finite components, or
    are so long that a score might not fit a long (|64 x| from 2^30 on).
    Vectors of another length are no candidates; empty vectors score 0 among
    themselves. A row that repeats in id and vector counts once; an id with
    several vectors is a query for each of them. Rows with null ids are
    candidates, not queries. An empty table gives an empty result; other
    columns are ignored.
    """
    spark = df.sparkSession
    importable(spark)
    v = F.col("v")
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(_usable(v))
    rows = written(rows.select("id", F.transform(v, lambda c: F.floor(c * SCALE)).alias("v")).distinct(), "codes")
    asked = rows.where(F.col("id") % every == 0)

    # a class keeps its smallest ids; cut before the shuffle, so copies don't meet in one task
    order = F.row_number().over(Window.partitionBy("v").orderBy(F.asc_nulls_last("id")))
    members = rows.withColumn("r", order).where(F.col("r") <= limit + 1).groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"),
                                                                                         F.max(F.col("id").isNull()).alias("unnamed"))
    members = members.select("v", F.size("v").alias("width"), F.when(F.col("unnamed"), F.concat("ids", F.array(F.lit(None).cast(
        rows.schema["id"].dataType)))).otherwise(F.col("ids")).alias("ids"))
    out = []
    members = written(members, "members")
    for width, in sorted(members.select("width").distinct().collect()):  # few widths
        mine = members.where(F.col("width") == width)
        classes = numbered(mine.orderBy(F.asc_nulls_last(F.col("ids")[0]), F.xxhash64("v")), "classes")
        queries = numbered(asked.where(F.size("v") == width).select("v").distinct(), "query-classes")
        n_queries = queries.count()
        if not n_queries:
            continue
        found = _search(queries, classes, width, n_queries, classes.count(), limit + 1, sizes)
        entry = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("s"), i.isNull().alias("last"), i.alias("i")))
        per_class = (found.join(classes.select("idx", "ids"), "idx").groupBy("qidx")
                     .agg(F.slice(F.array_sort(F.flatten(F.collect_list(entry))), 1, limit + 1).alias("found")))
        per_class = per_class.join(queries, per_class["qidx"] == queries["idx"]).select("v", "found")
        hits = hot_join(asked.where(F.size("v") == width), written(per_class, "found"), "v")
        others = F.slice(F.filter("found", lambda e: ~e["i"].eqNullSafe(F.col("id"))), 1, limit)
        out.append(hits.select(F.col("id").alias("query_id"), F.posexplode(others).alias("rank", "e")).select(
            "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("e.i").alias(id_col), (-F.col("e.s")).alias("score")))
    if not out:
        id_type = rows.schema["id"].dataType.simpleString()
        return spark.createDataFrame([], f"query_id {id_type}, rank int, {id_col} {id_type}, score long")
    return reduce(DataFrame.union, out)

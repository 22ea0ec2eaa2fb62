"""Operators on embeddings against numpy and plain Python."""

import numpy as np
import pytest
from edges import CLASHES, by_rows
from pyspark.sql import functions as F

from wtprof.llm import queries, topk_threshold, whitening


def vectors(spark, data):
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    return df.select("*", *(F.lit(f"extra {c}").alias(c) for c in [*CLASHES, "x", "idx", "n", "z", "v", "block"]))


def usable(v):
    return v is not None and all(c is not None and np.isfinite(c) for c in v)


ODD = [(9001, None), (9002, [float("nan")] * 6), (9003, [None] * 6), (9004, [1.0, float("inf"), 0.0, 0.0, 0.0, 0.0]), (9005, [])]


# -- whitening ----------------------------------------------------------------------

def white_want(data, limit=16):
    """{(id, deviation): n} and arrays (rows, components) of one width, by numpy."""
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in data], object)
    fit = np.array(sorted(set(map(tuple, x.tolist()))), object)
    n, total = len(fit), fit.sum(0)
    centred = np.array((n * fit - total) / n, float)
    values, units = np.linalg.eigh(centred.T @ centred / n)
    values, units = values[::-1], units[:, ::-1]
    k = min(limit, int((values > 1e-12 * values[0]).sum()))
    z = np.array((n * x - total) / n, float) @ units[:, :k] / np.sqrt(values[:k])
    return n, [int(((n * r - total) ** 2).sum()) for r in x], z, values[:k] / values.sum()


def white_same(got, data):
    n, deviation, z, explained = white_want(data)
    k = z.shape[1]
    assert len(got) == len(data) * k and {r["component"] for r in got} == set(range(1, k + 1))
    assert {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    rows = {}
    for r in got:
        rows.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r["whitened"])
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
    assert set(rows) == {(i, d) for (i, _), d in zip(data, deviation)}
    mine = np.array([[rows[i, d][c + 1][0] for c in range(k)] for (i, _), d in zip(data, deviation)])
    sign = np.sign((mine * z).sum(0))
    assert np.abs(mine * sign - z).max() < 1e-6


def test_white_rows(spark):
    rng = np.random.default_rng(3)
    data = [(k, (rng.standard_normal(6) * [1, 2, 3, 4, 5, 6]).tolist()) for k in range(60)]
    data += [(100 + k, data[0][1]) for k in range(40)] + [(7, data[7][1]), (None, data[3][1]), (1 << 60, [50.0, 0.0, 0.0, 0.0, 0.0, 0.0])]
    got = whitening.whiten(vectors(spark, data + ODD).repartition(5)).collect()
    assert got[0].asDict().keys() == {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    twice = [r for r in got if r["vec_id"] == 7]
    assert len(twice) == 12
    white_same(got, data)


def test_white_blocks(spark, monkeypatch):
    """Many small blocks in both directions, and splits of the product."""
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 3)
    rng = np.random.default_rng(5)
    data = [(k, (rng.standard_normal(20) + 100).tolist()) for k in range(90)]
    white_same(whitening.whiten(vectors(spark, data)).collect(), data)


def test_white_little_variance(spark):
    """Fewer components where entries are constant or repeat; none without variance."""
    rng = np.random.default_rng(8)
    data = [(k, [a, a, 5.0, b]) for k, (a, b) in enumerate(rng.standard_normal((30, 2)).tolist())]
    white_same(whitening.whiten(vectors(spark, data)).collect(), data)
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(vectors(spark, ODD)).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0])]).where("false")).count() == 0
    two = [(1, [1.0, 2.0]), (2, [3.0, 1.0]), (3, [0.5, 0.5]), (4, [1.0, 0.0, 0.0]), (5, [0.0, 1.0, 0.0]), (6, [0.0, 0.0, 3.0])]
    got = whitening.whiten(vectors(spark, two)).collect()  # each width on its own
    white_same([r for r in got if r["vec_id"] < 4], two[:3])
    white_same([r for r in got if r["vec_id"] > 3], two[3:])
    far = [(1, [1e11, 0.0]), (2, [-1e11, 1.0]), (3, [0.0, 2.0])]  # deviations beyond a long
    assert {r["deviation"] for r in whitening.whiten(vectors(spark, far)).where("vec_id < 3").collect()} == {None}


def test_op13(spark, duck):
    from conftest import SF_SMALL
    white_same(queries.op13_embedding_whitening(spark, SF_SMALL).collect(), duck.sql("SELECT vec_id, embedding FROM embeddings").fetchall())


# -- top-k --------------------------------------------------------------------------

def top_want(data, limit=20, every=20):
    rows = {(i, tuple(int(np.floor(64 * float(c))) for c in v)) for i, v in data if usable(v)}
    out = []
    for i, q in rows:
        if i is None or i % every:
            continue
        found = sorted((-sum(a * b for a, b in zip(q, v)), j is None, j or 0) for j, v in rows if j != i and len(v) == len(q))
        out += [(i, k + 1, None if last else j, -s) for k, (s, last, j) in enumerate(found[:limit])]
    return sorted(out, key=repr)


def mixed(seed, n=400, width=8):
    """Random rows, small entries with many ties, a large group of copies and odd rows."""
    rng = np.random.default_rng(seed)
    data = [(k, rng.standard_normal(width).tolist()) for k in range(n)]
    data += [(1000 + k, (rng.integers(-1, 2, width) / 64).tolist()) for k in range(n // 2)]
    data += [(3000 + k, data[20][1]) for k in range(150)]
    data += [(None, data[0][1]), (None, data[40][1]), (None, None), (60, data[60][1]), (80, data[1][1]), (5000, [0.0] * width)]
    return data + ODD + [(9020, []), (9040, []), (9041, []), (9060, [1.0, 2.0]), (9061, [2.0, -1.0]), (9080, [1e6] * 3), (9081, [-1e6] * 3),
                         (9082, [1e6, -1.0, 0.5])]


def test_top_rows(spark):
    data = mixed(1)
    got = topk_threshold.top_k(vectors(spark, data).repartition(5))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert by_rows(got) == top_want(data)
    few = [(20, [1.0, 2.0]), (21, [0.5, 0.5]), (40, [-1.0, 0.0])]
    assert by_rows(topk_threshold.top_k(vectors(spark, few))) == top_want(few)
    assert topk_threshold.top_k(vectors(spark, [(20, [1.0])])).count() == 0
    assert topk_threshold.top_k(vectors(spark, [(21, [1.0]), (22, [1.0])])).count() == 0
    assert topk_threshold.top_k(vectors(spark, few).where("false")).count() == 0


def test_top_in_many_cells(spark):
    """Small blocks, short lists and a narrow merge: all phases have work, the result is the same."""
    small = topk_threshold.Sizes(lists=3, gather=3, query_rows=7, block_rows=50, fan=3)
    data = mixed(2, 300)
    assert by_rows(topk_threshold.top_k(vectors(spark, data).repartition(3), limit=5, every=10, sizes=small)) == top_want(data, 5, 10)


def test_top_parts():
    rng = np.random.default_rng(0)
    key, score = np.repeat(np.arange(4) << 40, 30) | np.tile(np.arange(30), 4), rng.integers(0, 9, 120)
    k, s = topk_threshold.best(np.tile(key, 2), np.tile(score, 2), 5)
    want = sorted((int(x) >> 40, -int(y), int(x)) for x, y in zip(key, score))
    want = [w for i in range(4) for w in [r for r in want if r[0] == i][:5]]
    assert [(int(x) >> 40, -int(y), int(x)) for x, y in zip(k, s)] == want
    assert topk_threshold.cutoffs(key, score, 5, 6).tolist() == [-want[5 * i + 4][1] for i in range(4)] + [topk_threshold.NEVER] * 2
    big = np.array([[1 << 30, 3], [5, -(1 << 29)]])  # products beyond 2^53 stay exact
    (_, p), = topk_threshold.products(big, big)
    assert p.dtype == np.int64 and p.tolist() == [[(1 << 60) + 9, (5 << 30) - (3 << 29)], [(5 << 30) - (3 << 29), 25 + (1 << 58)]]


def test_op11(spark, duck):
    from conftest import SF_SMALL
    want = duck.sql(queries.SQL["op11_exact_top_k"]).fetchall()
    assert by_rows(queries.op11_exact_top_k(spark, SF_SMALL)) == sorted(want, key=repr)
    assert sorted(want, key=repr) == top_want(duck.sql("SELECT vec_id, embedding FROM embeddings").fetchall())

"""Near-duplicate and repeat operators against brute force."""

import random
from hashlib import sha256

import numpy as np
import pytest
import xxhash
from edges import by_rows, empty, frame, long_text, rows

from wtprof.llm import embedding_forest, graph, queries, simhash_vp, substring_dedup
from wtprof.llm.words import Words


def roots(n, pairs):
    up = list(range(n))
    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def least(ids, group):
    out = {}
    for i, g in zip(ids, group):
        if i is not None:
            out[g] = min(out.get(g, i), i)
    return [out.get(g) for g in group]


def test_components(spark):
    rnd = random.Random(1)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 560)]
    got = dict(graph.components(spark.createDataFrame(pairs, "a long, b long")).collect())
    want = roots(600, pairs)
    assert got == {x: want[x] for p in pairs for x in p if p[0] != p[1]} | {x: g for x, g in got.items() if want[x] == g}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- simhash ----------------------------------------------------------------------

def simhash(text, size=4):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[k:k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
    counts = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(grams))


def test_vp_search_finds_every_pair(spark):
    rnd = random.Random(6)
    fps = {rnd.getrandbits(64) for _ in range(700)}
    for f in list(fps)[:300]:
        for flips in (1, 3, 4, 5):
            g = f
            for b in rnd.sample(range(64), flips):
                g ^= 1 << b
            fps.add(g)
    fps = sorted(fps)
    arr = np.array(fps, np.uint64)
    pairs = [(i, j) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(arr[i] ^ arr) <= 4).tolist() if i < j]
    want = roots(len(fps), pairs)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    got = [(a, b) for a, b in simhash_vp.links(df).collect()]
    number = {int(np.uint64(f).astype(np.int64)): k for k, f in enumerate(fps)}
    assert roots(len(fps), [(number[a], number[b]) for a, b in got]) == want


@pytest.mark.parametrize("bits", [0, 1, 3, 6])
def test_vp_search_other_radii(spark, bits):
    rnd = random.Random(bits)
    fps = sorted({f ^ (1 << rnd.randrange(64)) for f in [rnd.getrandbits(64) for _ in range(60)] for _ in range(6)})
    arr = np.array(fps, np.uint64)
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if np.bitwise_count(arr[i] ^ arr[j]) <= bits]
    number = {int(arr[k].astype(np.int64)): k for k in range(len(fps))}
    got = simhash_vp.links(spark.createDataFrame([(x,) for x in number], "fp long"), bits).collect()
    assert roots(len(fps), [(number[a], number[b]) for a, b in got]) == roots(len(fps), pairs)


def simhash_want(data):
    fps = [simhash(t) for _, t in data]
    pairs = [(i, j) for i in range(len(data)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 4]
    return fps, least([i for i, _ in data], roots(len(data), pairs))


def test_simhash_rows(spark):
    data = rows()
    fps, component = simhash_want(data)
    got = by_rows(simhash_vp.digest(simhash_vp.near_duplicates(frame(spark))))
    assert got == sorted(((i, f"{f:016x}", c) for (i, _), f, c in zip(data, fps, component)), key=repr)
    assert simhash_vp.near_duplicates(empty(spark)).count() == 0
    kept = simhash_vp.keep_one(frame(spark))
    assert kept.columns == frame(spark).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(component))
    assert simhash_vp.keep_one(empty(spark)).count() == 0


def test_op7(spark, duck):
    from conftest import SF_SMALL
    data = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    fps, component = simhash_want(data)
    assert by_rows(queries.op7_simhash_near_dup(spark, SF_SMALL)) == sorted(
        ((i, f"{f:016x}", c) for (i, _), f, c in zip(data, fps, component)), key=repr)


# -- repeats ----------------------------------------------------------------------

def repeats_want(data, size=13):
    words = [(t or "").encode().split() for _, t in data]
    order = [float("inf") if i is None else i for i, _ in data]
    first = {}
    for i, w in zip(order, words):
        for k in range(len(w) - size + 1):
            s = tuple(w[k:k + size])
            first[s] = min(first.get(s, i), i)
    out = []
    for (i, _), o, w in zip(data, order, words):
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < o:
                gone[k:k + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_repeat_rows(spark):
    rnd = random.Random(12)
    common = [long_text(n, 100 + n) for n in (12, 13, 14, 20, 45)]
    data = rows() + [(100 + k, "  ".join([long_text(rnd.randint(0, 30), k), rnd.choice(common), long_text(rnd.randint(0, 9), k + 500),
                                         rnd.choice(common)])) for k in range(60)]
    df = frame(spark, data).repartition(5)
    assert by_rows(substring_dedup.remove_repeats(df, digest=True)) == repeats_want(data)
    full = substring_dedup.remove_repeats(df)
    assert set(full.columns) == {*df.columns, "n_removed"}  # the input's n_words is replaced
    texts = {}
    for i, t in data:
        texts.setdefault(i, set()).add(t)
    for r in full.collect():
        assert r["n_removed"] or r["text"] in texts[r["doc_id"]]
        assert r["text"] is None or len(r["text"].encode().split()) == r["n_words"] - r["n_removed"]
    assert substring_dedup.remove_repeats(empty(spark)).count() == 0


def test_batches_meet(spark, monkeypatch):
    """Many small batches: repeats are found across them."""
    monkeypatch.setattr(substring_dedup, "BATCH_BYTES", 300)
    data = [(k, long_text(30, k % 7) + " " + long_text(5, 900 + k)) for k in range(50)]
    assert by_rows(substring_dedup.remove_repeats(frame(spark, data).repartition(3), digest=True)) == repeats_want(data)


def test_words_built_against_polynomials(spark):
    """Thue-Morse words and their complements meet under any polynomial modulo 2^64."""
    bits = [0]
    while len(bits) < 4096:
        bits += [1 - b for b in bits]
    a, b = ("".join("ab"[x ^ f] for x in bits) for f in (0, 1))
    rest = " ".join(f"w{k}" for k in range(12))
    data = [(1, f"{a} {rest}"), (2, f"{b} {rest}"), (3, f"{a} {rest}"), (4, f"x {a} y {b} {rest}")]
    assert by_rows(substring_dedup.remove_repeats(frame(spark, data), digest=True)) == repeats_want(data)


def test_word_hashes():
    """Words of all lengths and endings have their own hashes, the same wherever they stand."""
    words = sorted({w[:k].encode() for w in ("a" * 40, "b" * 40, "ab" * 20, "0123456789" * 4, "\0" * 40, "aaaaaaa\0" * 5) for k in range(1, 41)})
    w = Words([b" ".join(words), b"xx  " + b"\t".join(reversed(words))])
    for h in (w.hash, w.second):
        assert len(set(h[:len(words)].tolist())) == len(words)
        assert h[len(words) + 1:][::-1].tolist() == h[:len(words)].tolist()
    assert not set(w.hash.tolist()) & set(w.second.tolist())


def test_delta_code():
    for keys in ([], [0], [5, 5 + 65535, 5 + 3 * 65535, 1 << 27], list(range(0, 1 << 20, 37)), [1, 1 << 27]):
        keys = np.array(keys, np.int64)
        assert substring_dedup.decode_sorted(*substring_dedup.encode_sorted(keys)).tolist() == keys.tolist()


def test_op5(spark, duck):
    from conftest import SF_SMALL
    assert by_rows(queries.op5_substring_dedup(spark, SF_SMALL)) == repeats_want(duck.sql("SELECT doc_id, text FROM documents").fetchall())


# -- embeddings ---------------------------------------------------------------------

def cosine_want(data):
    ok = [k for k, (_, v) in enumerate(data) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    pairs = []
    for p, i in enumerate(ok):
        for j in ok[:p]:
            a, b = (np.array(data[k][1], float) / np.abs(data[k][1]).max() for k in (i, j))
            if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95:
                pairs.append((i, j))
    degree = np.zeros(len(data), int)
    for i, j in pairs:
        degree[i] += 1
        degree[j] += 1
    component = least([i for i, _ in data], roots(len(data), pairs))
    return sorted(((i, int(d), c, i is not None and i == c) for (i, _), d, c in zip(data, degree, component)), key=repr)


def test_embedding_rows(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((40, 16))
    data = [(k, (centres[k % 40] + 0.12 * rng.standard_normal(16) * (k % 3)).tolist()) for k in range(200)]
    data += [(k, centres[0].tolist()) for k in range(1000, 1100)]  # a large group of copies
    data += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [None] * 16), (2005, [float("inf")] * 16),
             (2006, [1.0, 2.0]), (2007, [2.0, 4.0]), (2008, [1e200] * 16), (2009, [1e-300] * 16), (None, centres[1].tolist()), (5, centres[2].tolist())]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").selectExpr("*", "1 as cid", "2 as a", "'x' as v")
    assert by_rows(embedding_forest.near_duplicates(df)) == cosine_want(data)
    monkeypatch.setattr(embedding_forest, "LEAF_ROWS", 16)
    monkeypatch.setattr(embedding_forest, "BLOCK_ROWS", 8)
    got, want = by_rows(embedding_forest.near_duplicates(df, trees=8)), cosine_want(data)
    assert sum(r[1] for r in got) >= 0.97 * sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert embedding_forest.near_duplicates(df.where("false")).count() == 0


def test_forest_recall():
    """Pairs just above the threshold meet in a leaf of some tree."""
    rng = np.random.default_rng(9)
    x = embedding_forest.unit(rng.standard_normal((20_000, 64)))
    y = embedding_forest.unit(x[:2000] + 0.32 / 8 * rng.standard_normal((2000, 64)))
    near = (x[:2000] * y).sum(1) >= 0.95
    assert near.sum() > 500
    every = np.concatenate([x, y])
    margin = embedding_forest.SPILL * np.sqrt(0.1) / 8
    met = np.zeros(2000, bool)
    for seed in range(embedding_forest.TREES):
        row, leaf = embedding_forest.Tree(every[rng.permutation(len(every))[:8000]], len(every), margin, seed).leaves(every)
        pairs = set(zip(row.tolist(), leaf.tolist()))
        order = np.argsort(row, kind="stable")
        row, leaf = row[order], leaf[order]
        begin = np.searchsorted(row, np.arange(len(every) + 1))
        for k in np.flatnonzero(near & ~met):
            met[k] = any((20_000 + k, int(l)) in pairs for l in leaf[begin[k]:begin[k + 1]])
    assert met[near].mean() > 0.97


def test_op4(spark, duck):
    from conftest import SF_SMALL
    data = duck.sql("SELECT vec_id, embedding FROM embeddings").fetchall()
    assert by_rows(queries.op4_embedding_near_dup(spark, SF_SMALL).select("vec_id", "n_links", "component_id", "kept")) == cosine_want(data)

"""Spelling variants against plain Python."""

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
from edges import by_rows, empty, frame, rows

from wtprof.llm import queries, spelling_variants


def one_edit(a, b):
    """Exactly one inserted, deleted or replaced code point, by trying all."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def counted(data, min_length=6, min_count=5):
    n = Counter()
    for i, t in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = "".join(c.lower() if c.isascii() else c for c in run)
            h = crc32(f"{i}:{low}".encode())
            if i is not None and h % 199 == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            n[low] += 1
    return {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}


def near_want(n):
    near = {w: [x for x in n if x != w and abs(len(x) - len(w)) <= 1 and one_edit(w, x)] for w in n}
    return near, {w: min(near[w], key=lambda x: (-n[x], x)) if near[w] else None for w in n}


def group_want(n, factor=5):
    near, best = near_want(n)
    form = {w: b if b and n[b] >= factor * n[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted(((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n), key=repr)


def texts(seed, n_docs=60, alphabet="abé", length=(6, 9)):
    """Documents over a small alphabet, so that many words are near, with frequent ones among them."""
    rnd = random.Random(seed)
    stock = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(*length))) for _ in range(150)]
    pick = [w for k, w in enumerate(stock) for _ in range(1 + 400 // (k + 1))]
    return [(k, " ".join(rnd.choice([str.upper, str])(rnd.choice(pick)) + rnd.choice(["", ",", "\n1"]) for _ in range(120)))
            for k in range(n_docs)]


def test_spelling_rows(spark):
    x = "z" * 5000
    data = rows() * 3 + texts(1) + [(500, f"{x} {x}z {x}zz {'y' + x} " * 6), (501, "word×word÷word ÀÁÂÃÄÅÀ " * 7), (None, "ABCDEFG abcdefg " * 5)]
    want = counted(data)
    assert len(want) > 100
    got = spelling_variants.group(frame(spark, data).repartition(7))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert by_rows(got) == group_want(want)
    assert spelling_variants.group(empty(spark)).count() == 0
    assert spelling_variants.group(frame(spark, [(1, None), (2, "short word"), (3, "")])).count() == 0


def test_planted_deletions(spark):
    """The crc32 rule on words of which it changes some."""
    rnd = random.Random(4)
    data = [(k, " ".join("".join(rnd.choice("abcdefgÉ") for _ in range(7)) for _ in range(300))) for k in range(3)] * 5
    want = counted(data)
    assert any(len(w) == 6 for w in want)  # runs have seven: these lost one
    assert {r["word"]: r["n"] for r in spelling_variants.vocabulary(frame(spark, data)).collect()} == want


def test_long_lists_and_tiles(spark):
    """Lists cut into blocks over several tasks give the same as whole ones."""
    rnd = random.Random(9)
    words = {"aaaaaa" + "".join(rnd.choice("bcd") for _ in range(rnd.randint(3, 6))): rnd.randint(5, 900) for _ in range(400)}
    words |= {"".join(rnd.choice("bcd") for _ in range(3)) + "aaaaaaa": rnd.randint(5, 900) for _ in range(20)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    near, best = near_want(words)
    want = {w: (len(near[w]), best[w]) for w in words if near[w]}
    for cut in ({}, {"list_rows": 16, "task_rows": 64}, {"list_rows": 100, "task_rows": 1}):
        got = {r["word"]: (r["n_near"], r["form"]) for r in spelling_variants.near_words(df, **cut).collect()}
        assert got == want


def test_one_edit_by_lengths():
    rnd = random.Random(2)
    words = sorted({"".join(rnd.choice("abü𝒳") for _ in range(rnd.randint(6, 8))) for _ in range(300)})
    a, b = spelling_variants.Side(words, 0), spelling_variants.Side(words, 0xFFFFFFFF)
    every = np.ones((len(words), len(words)), bool)
    reach = spelling_variants._alike(a.left, b.left, every) + spelling_variants._alike(a.right, b.right, every)
    longer = np.maximum(a.length[:, None], b.length)
    near = (reach >= longer - 1) & (abs(a.length[:, None] - b.length) <= 1) & ~np.eye(len(words), dtype=bool)
    assert near.tolist() == [[x != y and one_edit(x, y) for y in words] for x in words]


def test_op12(spark, duck):
    from conftest import SF_SMALL
    got = by_rows(queries.op12_spelling_variants(spark, SF_SMALL))
    assert got == by_rows_duck(duck.sql(queries.SQL["op12_spelling_variants"]))
    assert got == group_want(counted(duck.sql("SELECT doc_id, text FROM documents").fetchall()))


def by_rows_duck(rel):
    return sorted(rel.fetchall(), key=repr)

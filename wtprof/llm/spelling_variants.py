"""Spelling variants of a corpus vocabulary by dense prefix-suffix tiling.

Words are counted in native expressions. Two words differ by one inserted,
deleted or replaced code point exactly if common prefix plus common suffix
reach the longer length minus one. Padded code-point matrices of two blocks of
words, one aligned left, one aligned right, are compared position by position,
which gives prefix and suffix lengths of all pairs of the tile at once; a
position is looked at only while some pair of the tile still agrees.

Which tiles are needed: let L be the shorter length and h half of it. An edit
behind the first h code points leaves the first h alike, any other leaves the
last L - h alike. So every word is listed under its first half and its last
half, for L its own length and one less, and tiles are made within a list. A
pair is taken from the first-half list if its common prefix reaches h, else
from the last-half list: once, without comparing results.

Short lists share a task (and tiles); a list of many words is cut into blocks,
and each pair of its blocks is a task of its own. A task returns one row a
word: its count of near words and the best of them, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wtprof.llm.common import importable, shuffle_width, written

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 6
MIN_COUNT = 5
FORM_FACTOR = 5       # a form is so many times as frequent as its variant
DROP_EVERY = 199      # a hash divisible by this loses a code point
TILE = 256            # words on each side of a tile
TILE_CODES = 1 << 20  # code points of a tile's matrix: fewer words where they are long
LIST_ROWS = 2048      # a longer list is cut into blocks of this size
TASK_ROWS = 8192      # rows of short lists that share a task


def occurrences(docs: DataFrame, id_col: str, text_col: str, min_length: int) -> DataFrame:
    """One row (word) for each run of ``min_length`` letters or more, planted
    deletions done."""
    runs = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"([{LETTERS}]{{{min_length},}})"), F.lit(1))
    low = (docs.select(F.col(id_col).cast("string").alias("id"), F.explode(runs).alias("run"))
           .select("id", F.translate("run", UPPER, LOWER).alias("low")))
    h = F.crc32(F.concat("id", F.lit(":"), "low").cast("binary"))
    at = (F.col("h") % F.length("low")).cast("int")
    cut = F.concat(F.col("low").substr(F.lit(1), at), F.col("low").substr(at + 2, F.length("low")))
    return low.select("low", h.alias("h")).select(F.when(F.col("h") % DROP_EVERY == 0, cut).otherwise(F.col("low")).alias("word"))


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of enough code points and occurrences."""
    return (occurrences(docs, id_col, text_col, min_length).where(F.length("word") >= min_length)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count))


class Side:
    """Code points of some words: aligned left and aligned right, padded with
    ``pad``, which the other side doesn't have."""

    def __init__(self, words: list[str], pad: int):
        self.length = np.array([len(w) for w in words])
        width = int(self.length.max(initial=1))
        beyond = np.arange(width) >= self.length[:, None]
        self.left, self.right = (self._codes(x, width, beyond, pad) for x in (words, [w[::-1] for w in words]))

    @staticmethod
    def _codes(words: list[str], width: int, beyond: np.ndarray, pad: int) -> np.ndarray:
        codes = np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width).copy()
        codes[beyond] = pad
        return codes


def _alike(a: np.ndarray, b: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Length of the common start of the rows of a and b, for the pairs asked."""
    alive, out = pairs.copy(), np.zeros(pairs.shape, np.int32)
    for p in range(min(a.shape[1], b.shape[1])):
        alive &= a[:, p, None] == b[None, :, p]
        if not alive.any():
            break
        out += alive
    return out


def tile(a: Side, b: Side, pairs: np.ndarray, half: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a tile, among ``pairs``, that are one edit apart. ``half`` and
    ``first`` tell of each row of a the half length and whether its list is one
    of first halves."""
    longer = np.maximum(a.length[:, None], b.length)
    prefix = _alike(a.left, b.left, pairs)
    # the list that counts a pair, and a suffix that could still be long enough
    open_ = pairs & ((prefix >= half[:, None]) == first[:, None])
    near = open_ & (prefix + _alike(a.right, b.right, open_) >= longer - 1)
    return np.nonzero(near)


def _tiles(key: np.ndarray, length: np.ndarray) -> Iterator[tuple[slice, slice]]:
    """Tile sides over rows sorted by list: runs of whole short lists with
    themselves; the blocks of a longer list in pairs."""
    begin = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
    rows = lambda s, e: max(1, min(TILE, TILE_CODES // max(1, int(length[s:e].max(initial=1)))))
    s = 0
    while s < len(begin) - 1:
        e = s + 1
        while e < len(begin) - 1 and begin[e + 1] - begin[s] <= rows(begin[s], begin[e + 1]):
            e += 1
        lo, hi = begin[s], begin[e]
        step = rows(lo, hi)
        blocks = [slice(k, min(hi, k + step)) for k in range(lo, hi, step)]
        for i, x in enumerate(blocks):
            for y in blocks[i:]:
                yield x, y
        s = e


def compare(table: pa.Table) -> pa.Table:
    """Near words within the lists of one task: word, n_near, its best near
    word (largest n, then least in code-point order) and that word's n."""
    rows = table.select(["band", "first", "key", "i", "word", "n"]).to_pylist()
    rows.sort(key=lambda r: (r["band"], r["first"], r["key"], r["i"]))
    words = [r["word"] for r in rows]
    n, band, first, block = (np.array([r[c] for r in rows]) for c in ("n", "band", "first", "i"))
    # lists numbered in sorted order; a hash collision of halves does no harm
    names = [(r["band"], r["first"], r["key"]) for r in rows]
    lists = np.cumsum([0] + [a != b for a, b in zip(names, names[1:])])
    length = np.array([len(w) for w in words])
    order = sorted(range(len(words)), key=lambda k: (-n[k], words[k]))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    near, best = np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)
    i, j = table.column("i_block")[0].as_py(), table.column("j_block")[0].as_py()
    for x, y in _tiles(lists, length):
        pairs = (lists[x][:, None] == lists[y]) & (np.minimum(length[x][:, None], length[y]) == band[x][:, None])
        if i != j:  # two blocks of a long list: pairs across only
            pairs &= block[x][:, None] != block[y]
        if x == y:
            pairs &= np.triu(np.ones(pairs.shape, bool), 1)
        if not pairs.any():
            continue
        a, b = tile(Side(words[x], 0), Side(words[y], 0xFFFFFFFF), pairs, band[x] // 2, first[x])
        a, b = a + x.start, b + y.start
        for u, w in ((a, b), (b, a)):
            np.add.at(near, u, 1)
            np.minimum.at(best, u, rank[w])
    # a word is in several lists of a task: each row counts its own pairs
    some = np.flatnonzero(near)
    form = [order[k] for k in best[some]]
    return pa.table({"word": pa.array([words[k] for k in some], pa.string()), "n_near": pa.array(near[some]),
                     "form": pa.array([words[k] for k in form], pa.string()), "form_n": pa.array(n[form], pa.int64())})


def _listed(words: DataFrame, min_length: int) -> DataFrame:
    """A row for each list a word is in: band (the shorter length of its
    pairs), whether it is a list of first halves, and the half's hash."""
    size = F.length("word")

    def entry(band: Column) -> Column:
        half = F.floor(band / 2).cast("int")
        rest = band - half
        return [F.struct(band.alias("band"), F.lit(True).alias("first"), F.xxhash64(F.lit(1), band, F.col("word").substr(F.lit(1), half)).alias("key")),
                F.struct(band.alias("band"), F.lit(False).alias("first"), F.xxhash64(F.lit(0), band, F.col("word").substr(size - rest + 1, rest)).alias("key"))]

    lists = F.explode(F.array(*entry(size), *entry(size - 1))).alias("l")
    return words.select("word", "n", lists).select("word", "n", "l.band", "l.first", "l.key").where(F.col("band") >= min_length)


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, list_rows: int = LIST_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """(word, n_near, form, form_n) of the words (word, n), all distinct and of
    ``min_length`` code points or more, that have near words: their number and
    the most frequent of them (ties: least in code-point order)."""
    spark = words.sparkSession
    importable(spark)
    listed = written(_listed(words, min_length), "lists")
    sizes = listed.groupBy("band", "first", "key").agg(F.count("*").alias("size")).where("size > 1")
    rows = written(listed.join(sizes, ["band", "first", "key"]), "listed")
    tasks = max(1, -(-rows.count() // task_rows))
    blocks = F.ceil(F.col("size") / list_rows).cast("int")
    own = F.pmod(F.xxhash64("word"), blocks).cast("int")
    # a row of a list of s blocks goes to the s block pairs with its block
    cut = rows.withColumn("i", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    long_ = F.col("size") > list_rows
    cells = cut.select(F.when(long_, F.xxhash64("band", "first", "key")).otherwise(F.pmod("key", F.lit(tasks).cast("long"))).alias("cell"),
                       F.when(long_, F.least("i", "other")).otherwise(-1).alias("i_block"),
                       F.when(long_, F.greatest("i", "other")).otherwise(-1).alias("j_block"),
                       "i", "band", "first", "key", "word", "n")
    cell = ["cell", "i_block", "j_block"]
    found = (cells.repartition(shuffle_width(spark), *cell).groupBy(*cell)
             .applyInArrow(compare, "word string, n_near long, form string, form_n long"))
    best = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form"))).alias("b")
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
            .select("word", "n_near", F.col("b.form").alias("form"), (-F.col("b.n")).alias("form_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form. A form is several times as
    frequent as its word, so chains are short and never closed; each round
    doubles how far a root lies."""
    now, open_ = written(forms.select("word", F.col("form").alias("root")), "roots"), True
    while open_:
        far = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(now.join(far, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                            F.col("next").isNotNull().alias("moved")), "roots")
        open_ = step.where("moved").limit(1).count() > 0
        now = step.select("word", "root")
    return now


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
          min_count: int = MIN_COUNT, factor: int = FORM_FACTOR) -> DataFrame:
    """Spelling variants of the words of all texts.

    Words are maximal runs of ASCII and Latin-1 letters (U+00C0 to U+00FF), in
    lower case where ASCII, of at least ``min_length`` code points and
    ``min_count`` occurrences; a run whose crc32 with its document's id is
    divisible by 199 lacks one code point. Returns word, form (its most frequent
    near word, ties to the least in code-point order, if at least ``factor``
    times as frequent; else null), root (the end of its chain of forms, itself
    if none), n, n_near (number of near words), form_n (the form's n or null).

    A null or empty text has no words; a null id deletes nothing. Repeated rows
    count as often as they occur. Words of any length are compared whole. An
    empty table gives an empty result; other columns are ignored.
    """
    words = written(vocabulary(docs, id_col, text_col, min_length, min_count), "words")
    near = words.join(near_words(words, min_length), "word", "left")
    has = F.col("form_n") >= F.col("n") * factor
    near = written(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                               F.when(has, F.col("form")).alias("form"), F.when(has, F.col("form_n")).alias("form_n")), "near")
    roots = _roots(near.where("form is not null"))
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

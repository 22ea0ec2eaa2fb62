"""SimHash near-duplicates by vantage-point trees.

A fingerprint is cut into ``bits // 2 + 1`` bands. Two fingerprints that
differ in at most ``bits`` bits differ in at most ``radius`` (the floor of
bits over bands) bits of some band, so one tree for each band, searched with
that radius, finds every pair; the exact distance over all 64 bits decides.

A tree splits its band's codes by Hamming distance to one vantage point after
another. The first levels make the shards: a shard holds the codes with the
same distances to these vantage points, and by the triangle inequality a
query only visits shards whose distances differ from its own by at most the
radius (codes that differ in e bits also differ in parity of distance as e
does, which halves the shards again). Queries that overlap a shard's boundary
are sent there; each pair of shards is tried once, from the smaller to the
larger. Inside a shard the same splitting goes on with further vantage points
until few enough are left to compare one by one.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wtprof.llm.common import importable, shuffle_width, text_or_empty, worker_state, written
from wtprof.llm.graph import LocalUnion, components

SHINGLE = 4
BITS = 4
SEED = 42
STEP = 1 << 16       # shingles whose bits are counted at a time
SHARD_ROWS = 4096    # fingerprints a shard should hold at most, as far as levels allow
MAX_LEVELS = 6
LEAF = 1 << 18       # comparisons made at once inside a shard


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash (as signed integer) of the A-Z lower-cased words'
    shingles, repeats included; zero without words."""
    words = text.encode().lower().split()  # on bytes: ASCII letters, ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    spans = list(zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()))
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(spans), STEP):
        h = np.array([digest(joined[a:b], SEED) for a, b in spans[at:at + STEP]], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(spans), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id_col, fp long) of every whole text; a null text counts as empty."""
    importable(df.sparkSession)

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worker_state("simhash", dict)
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return df.select(F.col(id_col), run(text_or_empty(text_col)).alias("fp"))


class Forest:
    """Bands, vantage points and levels; the same for all data of a width."""

    def __init__(self, bits: int, levels: int, seed: int = 7):
        self.bits = bits
        n = bits // 2 + 1
        self.radius = bits // n
        edges = [64 * k // n for k in range(n + 1)]
        self.bands = list(zip(edges, edges[1:]))
        rnd = random.Random(seed)
        self.points = [[rnd.getrandbits(b - a) for _ in range(levels + 24)] for a, b in self.bands]
        self.levels = levels
        # distances of a shard that a query visits, relative to its own
        self.offsets = [o for o in product(range(-self.radius, self.radius + 1), repeat=levels)
                        if len({x % 2 for x in o}) == 1]

    def shards(self, fp: Column) -> Column:
        """array<struct<shard, home>>: the home shard and those to visit."""
        out = []
        for k, (a, b) in enumerate(self.bands):
            code = fp if b - a == 64 else F.shiftrightunsigned(fp, a).bitwiseAND((1 << (b - a)) - 1)
            path = [F.bit_count(code.bitwiseXOR(F.lit(p - (p >> 63 << 64)))) for p in self.points[k][:self.levels]]
            for o in self.offsets:
                if o < (0,) * self.levels:
                    continue  # the other side queries this one
                key = F.lit(k).cast("long")
                for d, x in zip(path, o):
                    key = key * 128 + (d + x + 32)
                out.append(F.struct(key.alias("shard"), F.lit(o == (0,) * self.levels).alias("home")))
        return F.array(*out)


def choose_levels(n: int, width: int, bits: int) -> int:
    """Levels that make the largest shard a small part of a task's share and
    shards small; the most common distances hold about 1/6 of the codes of the
    first level and, as parity is then given, 1/3 of each further one."""
    levels, largest = 3 if bits // (bits // 2 + 1) <= 1 else 2, 1 / 6 / 9
    while levels < MAX_LEVELS and (largest * width > 6 or n * largest > SHARD_ROWS * 8):
        levels, largest = levels + 1, largest / 3
    return levels


def _join(left: np.ndarray, right: np.ndarray, fp: np.ndarray, code: np.ndarray, points: list[int], radius: int,
          bits: int, union: LocalUnion) -> None:
    """Unite the rows of ``left`` with those of ``right`` (row numbers) within
    ``bits``; splits by one vantage point after another while there is too
    much to compare."""
    todo = [(left, right, 0)]
    while todo:
        a, b, level = todo.pop()
        if not len(a) or not len(b):
            continue
        if len(a) * len(b) > LEAF and level < len(points):
            da, db = (np.bitwise_count(code[x] ^ np.uint64(points[level])).astype(np.int16) for x in (a, b))
            for d in np.unique(db):
                todo.append((a[np.abs(da - d) <= radius], b[db == d], level + 1))
            continue
        step = max(1, LEAF // len(b))
        for k in range(0, len(a), step):
            part = a[k:k + step]
            x, y = np.nonzero(np.bitwise_count(fp[part][:, None] ^ fp[b][None, :]) <= bits)
            union.add(part[x], b[y])


def links(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that give the
    components of all pairs within ``bits`` differing bits. A shard returns
    fewer links than it has rows, however many pairs it finds."""
    spark = fps.sparkSession
    importable(spark)
    forest = Forest(bits, choose_levels(fps.count(), shuffle_width(spark), bits))
    bands, levels, points, radius = forest.bands, forest.levels, forest.points, forest.radius

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        k = int(key[0]) >> (7 * levels)
        a, b = bands[k]
        fp = rows["fp"].to_numpy().view(np.uint64)
        code = fp >> np.uint64(a) & np.uint64((1 << (b - a)) - 1)
        home = np.flatnonzero(rows["home"].to_numpy(bool))
        query = np.flatnonzero(~rows["home"].to_numpy(bool))
        union = LocalUnion(len(fp))
        _join(home, home, fp, code, points[k][levels:], radius, bits, union)
        _join(query, home, fp, code, points[k][levels:], radius, bits, union)
        x, y = union.links()
        return pd.DataFrame({"a": fp[x].view(np.int64), "b": fp[y].view(np.int64)})

    spread = fps.select("fp", F.explode(forest.shards(F.col("fp"))).alias("s")).select("fp", "s.shard", "s.home")
    return spread.groupBy("shard").applyInPandas(compare, "a long, b long")


def _components(own: DataFrame, bits: int) -> DataFrame:
    """(fp, root, component_id) of the distinct fingerprints of (id, fp) rows."""
    classes = written(own.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    root = components(links(classes.select("fp"), bits))
    rooted = (classes.join(root, classes["fp"] == root["node"], "left")
              .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    return rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(
        "fp", "root", "component_id")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    bits: int = BITS) -> DataFrame:
    """id_col, fp (long) and component_id (smallest id reachable over links of
    at most ``bits`` differing bits, itself included) of every row.

    Equal fingerprints are one class from the start, so a group of copies is
    one row in the search. Null texts count as empty and, like all texts
    without words, have fingerprint zero and are linked; null ids are kept,
    belong to their class, and are never a component's smallest id (a
    component of null ids only has a null component_id). Repeated rows stay.
    An empty table gives an empty result; other columns are ignored.
    """
    own = written(fingerprints(df, id_col, text_col, shingle).withColumnRenamed(id_col, "id"), "fingerprints")
    of = _components(own, bits).select("fp", "component_id")
    return own.join(of, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             bits: int = BITS) -> DataFrame:
    """The row of smallest id (null ids last) of each component, with all
    columns of ``df``; of rows that share that id, one."""
    importable(df.sparkSession)
    prints = fingerprints(df.select(F.struct(*df.columns).alias("row"), F.col(text_col).alias("text")), "row", "text", shingle)
    rows = written(prints.select("row", "fp", F.monotonically_increasing_id().alias("key")), "rows")
    own = rows.select(F.col("row")[id_col].alias("id"), "fp", "key")
    first = F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("first")
    kept = own.join(_components(own, bits), "fp").groupBy("root").agg(first).select(F.col("first.key").alias("key"))
    return rows.join(kept, "key", "left_semi").select("row.*")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id_col, fingerprint (16 lowercase hex digits), component_id."""
    return found.select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

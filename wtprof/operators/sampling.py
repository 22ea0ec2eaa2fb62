"""Sampling and splitting (K1-K6), deterministic by key hash.

Per-class ranks never put a whole class in one task: rows are salted into
hash buckets, ranked inside (class, bucket), and offset by the sizes of the
earlier buckets (a classes × buckets table), which equals a rank over the
class ordered by (bucket, hash, key).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wtprof.session import materialize

SALT_BUCKETS = 64           # buckets of a class at least
BUCKET_ROWS = 1_000_000     # rows a bucket should hold at most


def key_hash(key: Sequence[str], seed: int = 42) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(k) for k in key])


def _bucketed(df: DataFrame, class_col: str, key: Sequence[str], buckets: int | None,
              order: Column | None) -> tuple[DataFrame, DataFrame]:
    """(rows with hash ``_h`` and bucket ``_b``, sizes by class and bucket).
    The sizes come from one pass over the input and serve class counts,
    targets and offsets; the number of buckets follows the largest class."""
    h = order if order is not None else key_hash(key)
    if buckets is None:
        # counted in small buckets first; any multiple of SALT_BUCKETS nests in them
        fine = SALT_BUCKETS * 1024
        counts = materialize(df.groupBy(class_col, F.pmod(h, F.lit(fine)).alias("_f")).agg(F.count(F.lit(1)).alias("_n")))
        largest = counts.groupBy(class_col).agg(F.sum("_n").alias("n")).agg(F.max("n")).first()[0] or 0
        buckets = SALT_BUCKETS
        while buckets < fine and largest / buckets > BUCKET_ROWS:
            buckets *= 2
        sizes = counts.groupBy(class_col, F.pmod("_f", F.lit(buckets)).alias("_b")).agg(F.sum("_n").alias("_n"))
    else:
        sizes = materialize(df.groupBy(class_col, F.pmod(h, F.lit(buckets)).alias("_b")).agg(F.count(F.lit(1)).alias("_n")))
    return df.withColumn("_h", h).withColumn("_b", F.pmod(F.col("_h"), F.lit(buckets))), sizes


def _ranked(d: DataFrame, sizes: DataFrame, class_col: str, key: Sequence[str], out: str) -> DataFrame:
    w = Window.partitionBy(class_col, "_b").orderBy("_h", *key)
    offs = sizes.select(class_col, "_b", (F.sum("_n").over(Window.partitionBy(class_col).orderBy("_b"))
                                          - F.col("_n")).alias("_off"))
    # classes × buckets rows: bounded by construction
    d = d.withColumn("_rb", F.row_number().over(w)).join(F.broadcast(offs), [class_col, "_b"])
    return d.withColumn(out, F.col("_off") + F.col("_rb")).drop("_h", "_b", "_rb", "_off")


def salted_rank(df: DataFrame, class_col: str, key: Sequence[str], buckets: int | None = None,
                order: Column | None = None, out: str = "_rank") -> DataFrame:
    """1-based rank within each class in (bucket, order, key) order,
    computed per (class, bucket) so no task holds more than one bucket."""
    d, sizes = _bucketed(df, class_col, key, buckets, order)
    return _ranked(d, sizes, class_col, key, out)


def replicate_to(df: DataFrame, class_col: str, key: Sequence[str], target, buckets: int | None = None,
                 order: Column | None = None, draw: str = "even", seed: int = 42) -> DataFrame:
    """Each class to exactly its target size; ``target(counts)`` gives
    (class_col, target) from (class_col, _nc).

    ``draw="even"``: every row ``target div n`` times, plus one more copy for
    the first ``target mod n`` rows in rank order (classes bigger than the
    target are cut to the target rows). ``draw="random"``: ``target`` draws
    with replacement, reproducible by ``seed``: draw number i of a class takes
    the row whose rank is a hash of i; the draws are spread, not the driver's.
    """
    d, sizes = _bucketed(df, class_col, key, buckets, order)
    counts = sizes.groupBy(class_col).agg(F.sum("_n").alias("_nc"))
    plan = counts.join(target(counts), class_col)  # one row per class
    d = _ranked(d, sizes, class_col, key, "_rank")
    heavy = (plan.agg(F.max(F.col("target") / F.col("_nc"))).first()[0] or 0) >= COPY_CHUNK / 2  # copies of a row
    if draw == "random":
        chunk = F.lit(COPY_CHUNK).cast("long")
        part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.greatest(F.col("target"), F.lit(1)) - 1) / chunk)))
        slots = plan.select(class_col, "_nc", "target", part.alias("_c")).repartition(
            df.sparkSession.sparkContext.defaultParallelism)
        last = F.least(F.col("target"), (F.col("_c") + 1) * chunk) - 1
        slots = slots.where("target > 0").select(class_col, "_nc", F.explode(F.sequence(F.col("_c") * chunk, last)).alias("_i"))
        rank = F.pmod(F.xxhash64(F.lit(seed), class_col, "_i"), F.col("_nc")) + 1
        drawn = slots.select(class_col, rank.alias("_rank")).groupBy(class_col, "_rank").agg(
            F.count(F.lit(1)).cast("int").alias("_copies"))
        return _explode_copies(d.join(drawn, [class_col, "_rank"]), heavy=heavy).drop("_rank", "_copies")
    d = d.join(F.broadcast(plan), class_col)
    copies = (F.floor(F.col("target") / F.col("_nc")) +
              F.when(F.col("_rank") <= F.pmod(F.col("target"), F.col("_nc")), 1).otherwise(0)).cast("int")
    d = d.withColumn("_copies", copies).where(F.col("_copies") >= 1)  # sequence(1, 0) would be [1, 0]
    return _explode_copies(d, heavy=heavy).drop("_nc", "target", "_rank", "_copies")


COPY_CHUNK = 100_000


def _explode_copies(d: DataFrame, chunk: int = COPY_CHUNK, heavy: bool = True) -> DataFrame:
    """Emit ``_copies`` copies of each row (column ``copy`` = 1..n).

    With ``heavy`` rows (a tiny class lifted to a huge one) a row is first
    cut into chunks of copies, which a rebalance spreads, so each chunk
    explodes in a task of its own. Otherwise rows explode where they are.
    """
    if not heavy:
        return d.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    n_chunks = F.ceil(F.col("_copies") / chunk).cast("int")
    d = d.withColumn("_c", F.explode(F.sequence(F.lit(0), n_chunks - 1))).hint("rebalance")
    first = F.col("_c") * chunk + 1
    last = F.least(F.col("_copies"), (F.col("_c") + 1) * chunk)
    return d.withColumn("copy", F.explode(F.sequence(first.cast("int"), last.cast("int")))).drop("_c")


def oversample_to_max(df: DataFrame, class_col: str, key: Sequence[str], buckets: int | None = None,
                      order: Column | None = None, draw: str = "even") -> DataFrame:
    """K1: every class replicated up to the size of the largest class."""
    def target(counts: DataFrame) -> DataFrame:
        return counts.select(class_col, counts.agg(F.max("_nc")).scalar().alias("target"))

    return replicate_to(df, class_col, key, target, buckets, order, draw)


def sample_fixed_per_class(df: DataFrame, class_col: str, key: Sequence[str], targets: Mapping[str, int],
                           default: int, buckets: int | None = None, order: Column | None = None,
                           draw: str = "even") -> DataFrame:
    """K2: per-class target sizes (e.g. normal 50 000, each attack 10 000)."""
    t = F.lit(default)
    for cls, n in targets.items():
        t = F.when(F.col(class_col) == cls, F.lit(n)).otherwise(t)
    return replicate_to(df, class_col, key, lambda counts: counts.select(class_col, t.alias("target")), buckets, order, draw)


def split_fraction(df: DataFrame, key: Sequence[str] | None = None, train: float = 0.7,
                   bucket: Column | None = None, out: str = "split") -> DataFrame:
    """K3: ``train``/``test`` by a hash bucket 0..99 of the key (or a given
    bucket expression): reproducible, no shuffle, disjoint and complete."""
    b = bucket if bucket is not None else F.pmod(key_hash(key), F.lit(100))
    return df.withColumn(out, F.when(b < F.lit(int(round(train * 100))), "train").otherwise("test"))


def shuffle_rows(df: DataFrame, seed: int = 42) -> DataFrame:
    """K4: random order (only where a sink needs it)."""
    return df.orderBy(F.rand(seed))


def thin_class(df: DataFrame, class_col: str, thin: str, percent: int = 1, key: Sequence[str] | None = None,
               bucket: Column | None = None) -> DataFrame:
    """K5: keep every class but ``thin``, and ``percent`` % of ``thin`` by a
    hash bucket of the key (reproducible)."""
    b = bucket if bucket is not None else F.pmod(key_hash(key), F.lit(100))
    return df.where((F.col(class_col) != thin) | F.col(class_col).isNull() | (b < percent))


def class_vs_normal(df: DataFrame, class_col: str, attacks: Sequence[str], normal: str = "normal") -> DataFrame:
    """K6: every (attack vs normal) training subset at once: normal rows are
    repeated once per attack, attack rows once; ``target`` = 1 for the
    attack. The attack list is a literal array (bounded by classes)."""
    lst = F.array(*[F.lit(a) for a in attacks])
    c = F.col(class_col)
    pair = F.when(c == normal, lst).when(c.isin(list(attacks)), F.array(c))
    d = df.where(pair.isNotNull()).withColumn("attack", F.explode(pair))
    return d.withColumn("target", (c == F.col("attack")).cast("int"))

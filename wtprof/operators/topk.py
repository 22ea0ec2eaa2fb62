"""Sort, limit and top-k.

Per-group caps use ``row_number() <= n``; Spark plans it with a
``WindowGroupLimit`` on both sides of the shuffle, so a large class ships at
most ``n`` rows per map partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


SALTS = 16
BINS = 4096
TERM_SALTS = 64
GROUP_LIMIT = 1000


def limit_n(df: DataFrame, n: int, key: Sequence[str], order: str = "hash") -> DataFrame:
    """A reproducible cap of ``n`` rows (top-k per partition, then merge).

    ``order='hash'`` spreads the kept rows over the key space; ``'key'``
    keeps the smallest keys.
    """
    cols = [F.col(k) for k in key]
    by = ([F.xxhash64(*cols)] if order == "hash" else []) + cols
    return df.orderBy(*by).limit(n)


def limit_per_class(df: DataFrame, n: int, class_col: str, order: Sequence[str],
                    class_ranges: Mapping[str, tuple] | None = None, time_col: str = "logtime",
                    default_range: tuple | None = None) -> DataFrame:
    """At most ``n`` rows per class, each class with its own time range.

    One scan serves every class: the per-class ranges become one predicate.
    The limit is taken in two levels, per (class, salt) and then per class,
    so the last task of a class gets ``SALTS`` x ``n`` rows at most, not
    ``n`` from every input partition.
    """
    out = df
    if class_ranges:
        t, c = F.col(time_col), F.col(class_col)
        cond = None
        for cls, (s, e) in class_ranges.items():
            part = (c == cls) & (t >= F.lit(s)) & (t < F.lit(e))
            cond = part if cond is None else cond | part
        if default_range is not None:
            s, e = default_range
            cond = cond | (~c.isin(list(class_ranges)) & (t >= F.lit(s)) & (t < F.lit(e)))
        out = out.where(cond)
    cols = [F.col(o) for o in order]
    salted = Window.partitionBy(class_col, "_salt").orderBy(*cols)
    w = Window.partitionBy(class_col).orderBy(*cols)
    out = out.withColumn("_salt", F.pmod(F.xxhash64(*cols), F.lit(SALTS)))
    out = out.withColumn("_rn", F.row_number().over(salted)).where(F.col("_rn") <= n).drop("_rn", "_salt")
    return out.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def limit_by_threshold(df: DataFrame, n: int, class_col: str, order: Sequence[str], bins: int = BINS) -> DataFrame:
    """E2 for large ``n``: the rows of :func:`limit_per_class`, without
    windows over whole classes.

    One aggregate counts, for each class, the rows in ``bins`` equal parts of
    the range of the first order column (a number, date or timestamp); the
    counts are a mergeable histogram, added up before the shuffle. They tell
    the bin the n-th row lies in. Rows of lower bins are kept by a filter
    alone; only the rows of that bin are ranked. Null order keys come first,
    as in an ordinary sort, NaN last. ``df`` is read three times: write or
    cache a costly one."""
    kind = df.schema[order[0]].dataType
    if isinstance(kind, (T.DateType, T.TimestampType)):
        x = F.unix_micros(F.col(order[0]).cast("timestamp")).cast("double")
    elif isinstance(kind, T.TimestampNTZType):
        x = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(order[0])).cast("double")
    elif isinstance(kind, T.NumericType):
        x = F.col(order[0]).cast("double")
    else:
        raise ValueError(f"{order[0]} is a {kind.simpleString()}: a threshold needs a number, date or timestamp")
    rows = df.withColumn("_x", F.nullif(F.nullif(x, F.lit(float("inf"))), F.lit(float("-inf"))))
    finite = F.when(~F.isnan("_x"), F.col("_x"))
    span = rows.groupBy(class_col).agg(F.min(finite).alias("_lo"), F.max(finite).alias("_hi"))
    rows = rows.join(F.broadcast(span.withColumnRenamed(class_col, "_c")), F.col(class_col).eqNullSafe(F.col("_c")), "left")
    # halves first, so that the width of the widest range is finite
    share = (F.col("_x") / 2 - F.col("_lo") / 2) / F.nullif(F.col("_hi") / 2 - F.col("_lo") / 2, F.lit(0.0))
    last = F.lit(bins)
    at = (F.when(F.col(order[0]).isNull() | (x == float("-inf")), F.lit(-1)).when(F.isnan(x) | (x == float("inf")), last)
          .otherwise(F.least(F.coalesce(F.floor(share * bins), F.lit(0)).cast("int"), last - 1)))
    rows = rows.withColumn("_bin", at).drop("_x", "_lo", "_hi", "_c")
    counts = rows.groupBy(class_col, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(class_col).orderBy("_bin"))
    # the bin where the count passes n, and how many rows it may still give; a row for each class
    cut = (counts.withColumn("_upto", upto).where(F.col("_upto") > n).groupBy(F.col(class_col).alias("_c"))
           .agg(F.min(F.struct("_bin", (F.lit(n) - (F.col("_upto") - F.col("_n"))).alias("room"))).alias("_cut")))
    rows = rows.join(F.broadcast(cut), F.col(class_col).eqNullSafe(F.col("_c")), "left")
    below = rows.where(F.col("_cut").isNull() | (F.col("_bin") < F.col("_cut._bin")))
    w = Window.partitionBy(class_col).orderBy(*[F.col(o) for o in order])
    edge = rows.where(F.col("_bin") == F.col("_cut._bin")).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= F.col("_cut.room"))
    return below.select(*df.columns).unionByName(edge.select(*df.columns))


def top_terms(term_counts: DataFrame, k: int, group: Sequence[str] = ("feature",),
              term_col: str = "term", count_col: str = "cnt") -> DataFrame:
    """The ``k`` most frequent terms per group; ties by term ascending.

    Spark limits a group on the map side only for small ``k`` (below
    ``spark.sql.optimizer.windowGroupLimitThreshold``, 1000). From there on
    the limit is taken in two levels, per (group, salt) and then per group,
    so the last task of a group gets ``TERM_SALTS`` x ``k`` terms at most."""
    order = [F.col(count_col).desc(), F.col(term_col)]
    out = term_counts
    if k >= GROUP_LIMIT:
        salted = Window.partitionBy(*group, "_salt").orderBy(*order)
        out = out.withColumn("_salt", F.pmod(F.xxhash64(term_col), F.lit(TERM_SALTS)))
        out = out.withColumn("_rn", F.row_number().over(salted)).where(F.col("_rn") <= k).drop("_rn", "_salt")
    w = Window.partitionBy(*group).orderBy(*order)
    return out.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def rank_features(scores: DataFrame, key: Sequence[str], feature_col: str = "feature",
                  score_col: str = "score", by_abs: bool = False) -> DataFrame:
    """Rank of each feature within its row, score descending (or |score|);
    ties by feature name. Long form: one row per (key, feature)."""
    s = F.abs(F.col(score_col)) if by_abs else F.col(score_col)
    w = Window.partitionBy(*key).orderBy(s.desc(), F.col(feature_col))
    return scores.withColumn("rank", F.row_number().over(w))


def top_k_features(scores: DataFrame, key: Sequence[str], k: int = 20, **kw) -> DataFrame:
    """E5: the first ``k`` ranked features per row."""
    return rank_features(scores, key, **kw).where(F.col("rank") <= k)


def sort_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Total order by key (range-partitioned sort)."""
    return df.orderBy(*key)

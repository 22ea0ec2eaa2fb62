"""Aggregations: distinct counts, class counts, thresholds, vector stats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wtprof.operators.quantiles import exact_quantiles


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """D3: one row per column ``(column_name, nunique)``; nulls ignored.

    Exact counts plan as one Expand + two-level aggregate (partial distinct
    per key before the shuffle); ``approx=True`` uses HyperLogLog++ in a
    single pass, the choice for very wide or very large tables.
    """
    fn = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.count_distinct
    wide = df.agg(*[fn(F.col(c)).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column_name", "nunique")


def label_counts(df: DataFrame, col: str = "label") -> DataFrame:
    """Rows per class (partial counts are combined map-side)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))


def max_class_count(df: DataFrame, col: str = "label") -> DataFrame:
    """Size of the largest class, as one row."""
    return label_counts(df, col).agg(F.max("cnt").alias("max_cnt"))


def boxplot_threshold(scores: DataFrame, col: str = "score", mode: str = "box", k: float = 1.5,
                      approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """D11 [inferred]: upper outlier bound of scores, as one row ``threshold``.

    ``box``: Q3 + k·IQR with linearly interpolated quartiles. ``mad``:
    median + k·MAD, MAD = median(|x − median|) in a second pass. Quantiles
    are exact and spread over the cluster; ``approx=True`` uses the
    ``percentile_approx`` sketch instead. No scores: a null threshold.
    """
    x = F.col(col)

    def pct(c, ps):
        if approx:
            return scores.agg(F.percentile_approx(c.cast("double"), ps, accuracy)).first()[0]
        return exact_quantiles(scores, c, ps)

    value = None
    if mode == "box":
        q = pct(x, [0.25, 0.75])
        value = q and q[1] + k * (q[1] - q[0])
    elif mode == "mad":
        med = pct(x, [0.5])
        value = med and med[0] + k * pct(F.abs(x - F.lit(med[0])), [0.5])[0]
    else:
        raise ValueError(mode)
    return scores.sparkSession.createDataFrame([(value,)], "threshold double")


def vector_stats(df: DataFrame, key: Sequence[str], vec_col: str) -> DataFrame:
    """Mean, population std and median of each row's vector.

    Mean and std come from array folds on the row; the median sorts the
    row's own array (bounded by the vector length).
    """
    v = F.col(vec_col)
    n = F.size(v)
    mean = F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / n
    sq = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x) / n
    s = F.array_sort(v)
    mid = F.floor((n - 1) / 2).cast("int")
    median = F.when(n % 2 == 1, F.get(s, mid)).otherwise((F.get(s, mid) + F.get(s, mid + 1)) / 2)
    return df.select(*key, mean.alias("mean"), F.sqrt(F.greatest(sq - mean * mean, F.lit(0.0))).alias("std"),
                     median.alias("median"))

"""One-hot encoding (J10, J11) and category inference.

Categories are fitted as a DataFrame ``(column, category, idx)``; sorted
per column, the string form of every value (as the reference encodes
``astype(str)``). Unknown values encode to all zeros.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wtprof.functions.arrays import array_argmax


def onehot_fit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """J10 fit: distinct values per column with their sorted position."""
    parts = [df.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")).distinct()
             for c in cols]
    cats = parts[0]
    for p in parts[1:]:
        cats = cats.unionByName(p)
    w = Window.partitionBy("column").orderBy("category")
    return cats.where(F.col("category").isNotNull()).withColumn("idx", F.row_number().over(w) - 1)


def onehot_names(categories: list[tuple[str, str]], n_cols: int) -> list[str]:
    """Output names: the category, prefixed ``<column>_`` when several
    columns are encoded (bare names could clash)."""
    return [f"{c}_{v}" if n_cols > 1 else v for c, v in categories]


MAX_WIDE_CATEGORIES = 1000


def onehot_transform(df: DataFrame, fitted: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """J10 transform, wide: one 0/1 double column per fitted category.

    The category list is needed at plan time to name columns, so it is
    collected from ``fitted`` — only after checking its size (categories
    are ≤ threshold per column by the role rule, J12); wider encodings must
    use :func:`onehot_long`.
    """
    n = fitted.count()
    if n > MAX_WIDE_CATEGORIES:
        raise ValueError(f"{n} categories: too wide for columns, use onehot_long")
    cats = [(r["column"], r["category"]) for r in fitted.orderBy("column", "idx").collect()]
    names = onehot_names(cats, len(cols))
    exprs = [F.when(F.col(c).cast("string") == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)).alias(n)
             for (c, v), n in zip(cats, names)]
    return df.select(*keep, *exprs)


def onehot_long(df: DataFrame, fitted: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """J10 transform, long: ``(key…, column, category, idx, value=1.0)`` for
    known values only (zeros implicit). A join on the fitted categories,
    broadcast after a size check; no collect."""
    parts = [df.select(*key, F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in cols]
    vals = parts[0]
    for p in parts[1:]:
        vals = vals.unionByName(p)
    from wtprof.operators.vectorize import small_side
    return vals.join(small_side(fitted), ["column", "category"]).withColumn("value", F.lit(1.0))


def onehot_inverse(df: DataFrame, fitted: DataFrame, column: str, onehot_cols: Sequence[str],
                   out: str = "category") -> DataFrame:
    """Category of the largest entry; an all-zero row (unknown value)
    gives null. Categories come in as a scalar-subquery array."""
    cats = fitted.where(F.col("column") == column).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "category"))), lambda s: s["category"])).scalar()
    arr = F.array(*[F.col(c) for c in onehot_cols])
    pick = F.when(F.array_max(arr) > 0, F.element_at(cats, array_argmax(arr) + 1))
    return df.withColumn(out, pick)

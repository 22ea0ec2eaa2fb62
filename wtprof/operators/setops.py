"""Set operations."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def union_classes(blocks: Sequence[DataFrame], fill=0) -> DataFrame:
    """stack class blocks by column name; columns a block lacks are
    filled with ``fill`` (numeric) — empty blocks simply add nothing."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), blocks)
    num = [f.name for f in out.schema.fields if isinstance(f.dataType, NumericType)]
    return out.fillna(fill, subset=num) if num else out


def aggregate_classes(df: DataFrame, keys: Sequence, label_col: str, aggs: Mapping[str, tuple[Sequence[str], Callable]],
                      out: str = "label") -> DataFrame:
    """F1 in one scan: the union of per-class aggregates, each class with
    columns of its own, as one conditional aggregate by (keys, class).

    ``aggs`` maps a result column to its classes and to a function that makes
    the aggregate from ``only``: ``only(c)`` is ``c`` in rows of these classes,
    else null. Columns a class lacks are 0; classes that no aggregate names
    are left out."""
    label = F.col(label_col)
    wanted = sorted({c for classes, _ in aggs.values() for c in classes})
    made = [F.coalesce(make(lambda c, k=list(classes): F.when(label.isin(k), c)), F.lit(0)).alias(name)
            for name, (classes, make) in aggs.items()]
    return df.where(label.isin(wanted)).groupBy(*keys, label.alias(out)).agg(*made)


def dedupe_results(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """drop duplicate rows (on ``cols`` or all columns)."""
    return df.dropDuplicates(list(cols)) if cols else df.distinct()


def distinct_labels(df: DataFrame, col: str = "label") -> DataFrame:
    """the distinct classes."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()

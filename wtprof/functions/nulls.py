"""Null fill and casts by role."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed fill values by role.
FILL_NUMBER = -1
FILL_STRING = "-"
FILL_CATEGORY = "empty"
FILL_FEATURE = 0.0
FILL_TEXT = " "


def fill_nulls(df: DataFrame, number: Sequence[str] = (), string: Sequence[str] = (),
               category: Sequence[str] = (), feature: Sequence[str] = (), text: Sequence[str] = ()) -> DataFrame:
    """Number → -1, string → '-', category → 'empty' (as string),
    feature → 0, text → ' '."""
    exprs = {}
    for c in number:
        exprs[c] = F.coalesce(F.col(c), F.lit(FILL_NUMBER).cast(df.schema[c].dataType))
    for c in string:
        exprs[c] = F.coalesce(F.col(c), F.lit(FILL_STRING))
    for c in category:
        exprs[c] = F.coalesce(F.col(c).cast("string"), F.lit(FILL_CATEGORY))
    for c in feature:
        exprs[c] = F.coalesce(F.col(c), F.lit(FILL_FEATURE))
    for c in text:
        exprs[c] = F.coalesce(F.col(c), F.lit(FILL_TEXT))
    return df.withColumns(exprs)


def cast_roles(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """I16: cast columns for a sink (``try_cast``: bad values become null)."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items()})

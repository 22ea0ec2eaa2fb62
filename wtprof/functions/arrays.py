"""Array expressions (I17-I19) evaluated inside the row, no Python."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed decision cut and the small constant added to a standard deviation.
CUT = 0.5
EPSILON = 1e-7


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def array_first_above(a, cut: float = CUT) -> Column:
    """0-based index of the first element above ``cut``; -1 if none."""
    return F.array_position(F.transform(_c(a), lambda x: x > cut), True).cast("int") - 1


def array_any_above(a, cut: float = CUT) -> Column:
    """Whether any element is above ``cut``."""
    return F.exists(_c(a), lambda x: x > cut)


def array_argmax(a) -> Column:
    """0-based index of the first largest element."""
    arr = _c(a)
    return F.array_position(arr, F.array_max(arr)).cast("int") - 1


def relu_rescale(a) -> Column:
    """max(x, 0) / max(array); all-non-positive arrays give zeros.

    The row maximum is bound once by ``aggregate``'s finish lambda, so the
    element lambda reads a bound value (no per-element re-evaluation).
    """
    arr = _c(a)
    return F.aggregate(
        arr, F.lit(float("-inf")), lambda m, x: F.greatest(m, x),
        lambda m: F.transform(arr, lambda x: F.when(m > 0, F.greatest(x, F.lit(0.0)) / m).otherwise(F.lit(0.0))))


def zscore_to_byte(a) -> Column:
    """((x − mean) / (std + ε)) · 0.25 + 0.5, clipped to [0, 1], · 255,
    truncated to an integer 0..255 (population std).

    Sum and sum of squares are folded once; the finish lambda binds them so
    the element transform stays O(n) per row.
    """
    arr = _c(a)
    init = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q"))

    def merge(acc, x):
        return F.struct((acc["s"] + x).alias("s"), (acc["q"] + x * x).alias("q"))

    def finish(acc):
        n = F.size(arr)
        mu = acc["s"] / n
        sd = F.sqrt(F.greatest(acc["q"] / n - mu * mu, F.lit(0.0))) + F.lit(EPSILON)
        return F.transform(arr, lambda x: F.floor(
            F.least(F.greatest((x - mu) / sd * 0.25 + 0.5, F.lit(0.0)), F.lit(1.0)) * 255).cast("int"))

    return F.aggregate(arr, init, merge, finish)


def values_to_array(cols: Sequence[str]) -> tuple[Column, Column]:
    """A block of columns → (values array, names array)."""
    return (F.array(*[F.col(c).cast("double") for c in cols]), F.array(*[F.lit(c) for c in cols]))

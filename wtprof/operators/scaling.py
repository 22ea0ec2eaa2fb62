"""Numeric scalers (J1-J6): fit = one aggregate (a one-row parameter
table), transform = projection reading the parameters through one
struct-valued scalar subquery (no join, nothing through the driver).

Six methods: standard (population std), minmax (default), maxabs, robust
(median / IQR, interpolated), quantile (uniform output) and Yeo-Johnson
power with maximum-likelihood λ followed by standardisation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wtprof.operators.quantiles import exact_quantiles
from wtprof.session import materialize
from wtprof.sources.tables import balanced

METHODS = ("standard", "minmax", "maxabs", "robust", "quantile", "power")
N_QUANTILES = 1000


def scale_fit(df: DataFrame, cols: Sequence[str], method: str = "minmax", approx: bool = False,
              n_quantiles: int | None = None, lazy: bool = False) -> DataFrame:
    """Fit parameters (materialised unless ``lazy``); see :func:`_fit`."""
    fitted = _fit(df, cols, method, approx, n_quantiles)
    if method == "quantile":
        fitted = fitted.withColumns({k: v for c in cols for k, v in _knots(c).items()})
    return fitted if lazy else materialize(fitted)


def _knots(c: str) -> dict:
    """Distinct quantile values (``knots``) with the first and last
    position of each in the quantile array (ties span several positions)."""
    q = F.col(f"{c}__quantiles")
    knots = F.array_distinct(q)  # q is sorted, so the distinct values stay sorted
    first = F.transform(knots, lambda v: F.array_position(q, v).cast("int") - 1)
    last = F.transform(knots, lambda v: F.size(q) - F.array_position(F.reverse(q), v).cast("int"))
    return {f"{c}__knots": knots, f"{c}__first": first, f"{c}__last": last}


def _bucketize(df: DataFrame, fitted: DataFrame, c: str) -> DataFrame:
    """``_k_<c>`` = index of the last knot ≤ x (-1 below the first) by the
    JVM binary search of ``Bucketizer``. The knots (≤ n_quantiles values,
    a fixed bound) are read from the fitted one-row table."""
    from pyspark.ml.feature import Bucketizer

    knots = fitted.select(f"{c}__knots").first()[0]
    splits = [float("-inf")] + list(knots) + [float("inf")]
    b = Bucketizer(splits=splits, inputCol=f"_x_{c}", outputCol=f"_k_{c}", handleInvalid="keep")
    d = b.transform(df.withColumn(f"_x_{c}", F.col(c).cast("double")))
    return d.withColumn(f"_k_{c}", F.col(f"_k_{c}").cast("int") - 1).drop(f"_x_{c}")


def _fit(df: DataFrame, cols: Sequence[str], method: str, approx: bool,
         n_quantiles: int | None) -> DataFrame:
    """Fit parameters for ``cols``; returns a one-row DataFrame of columns
    ``<col>__<param>``. Quantiles are exact and spread over the cluster;
    ``approx=True`` switches robust/quantile to the sketch (one pass)."""
    if method not in METHODS:
        raise ValueError(f"unknown scaling method {method!r}")
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        if method == "standard":
            aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_pop(x).alias(f"{c}__std")]
        elif method == "minmax":
            aggs += [F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
        elif method == "maxabs":
            aggs += [F.max(F.abs(x)).alias(f"{c}__maxabs")]
        elif method in ("robust", "quantile"):
            n = n_quantiles or N_QUANTILES
            refs = [0.25, 0.5, 0.75] if method == "robust" else [i / (n - 1) for i in range(n)] if n > 1 else [0.0]
            if approx:
                q = F.percentile_approx(x, refs, 100_000)
            else:
                q = F.lit(exact_quantiles(df, x, refs)).cast("array<double>")
            aggs += [q.alias(f"{c}__q")] if method == "robust" else [q.alias(f"{c}__quantiles"), F.lit(refs).alias(f"{c}__refs")]
        elif method == "power":
            return power_fit(df, cols)
    if method in ("robust", "quantile") and not approx:
        return df.sparkSession.range(1).select(*aggs)
    return df.agg(*aggs)


def _params(fitted: DataFrame) -> Column:
    """All parameters as one struct-valued scalar subquery (reused)."""
    return fitted.select(F.struct(*fitted.columns)).scalar()


def scale_transform(df: DataFrame, fitted: DataFrame, cols: Sequence[str], method: str = "minmax") -> DataFrame:
    p = _params(fitted)
    exprs = {}
    for c in cols:
        x = F.col(c).cast("double")
        if method == "standard":
            sd = p[f"{c}__std"]
            exprs[c] = (x - p[f"{c}__mean"]) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)
        elif method == "minmax":
            rng = p[f"{c}__max"] - p[f"{c}__min"]
            exprs[c] = (x - p[f"{c}__min"]) / F.when(rng == 0, F.lit(1.0)).otherwise(rng)
        elif method == "maxabs":
            m = p[f"{c}__maxabs"]
            exprs[c] = x / F.when(m == 0, F.lit(1.0)).otherwise(m)
        elif method == "robust":
            q = p[f"{c}__q"]
            iqr = F.get(q, 2) - F.get(q, 0)
            exprs[c] = (x - F.get(q, 1)) / F.when(iqr == 0, F.lit(1.0)).otherwise(iqr)
        elif method == "quantile":
            df = _bucketize(df, fitted, c)
            exprs[c] = quantile_map_bucket(x, F.col(f"_k_{c}"), p[f"{c}__quantiles"], p[f"{c}__refs"],
                                           p[f"{c}__first"], p[f"{c}__last"], p[f"{c}__knots"])
        elif method == "power":
            lam = p[f"{c}__lambda"]
            y = yeo_johnson(x, lam)
            sd = p[f"{c}__std"]
            exprs[c] = (y - p[f"{c}__mean"]) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)
    out = df.withColumns(exprs)
    tmp = [c for c in out.columns if c.startswith("_k_")]
    return out.drop(*tmp) if tmp else out


def quantile_map_bucket(x: Column, k: Column, q: Column, refs: Column, first: Column, last: Column,
                        knots: Column) -> Column:
    """Uniform quantile transform from the knot index ``k`` (no lambdas):
    ``le`` = #quantiles ≤ x, ``lt`` = #quantiles < x, then the mean of the
    forward and backward interpolations (ties get their mid rank)."""
    n = F.size(q)
    on_knot = (k >= 0) & (F.get(knots, k) == x)
    le = F.when(k < 0, F.lit(0)).otherwise(F.get(last, k) + 1)
    lt = F.when(k < 0, F.lit(0)).when(on_knot, F.get(first, k)).otherwise(F.get(last, k) + 1)

    def interp(j):
        q0, q1, r0, r1 = F.get(q, j), F.get(q, j + 1), F.get(refs, j), F.get(refs, j + 1)
        return F.when(q1 == q0, r0).otherwise(r0 + (x - q0) / (q1 - q0) * (r1 - r0))

    fwd = F.when(le == 0, F.get(refs, 0)).when(le >= n, F.get(refs, n - 1)).otherwise(interp(le - 1))
    bq0, bq1 = F.get(q, lt - 1), F.get(q, lt)
    br0, br1 = F.get(refs, lt - 1), F.get(refs, lt)
    back_mid = F.when(bq1 == bq0, br1).otherwise(br1 - (bq1 - x) / (bq1 - bq0) * (br1 - br0))
    bwd = F.when(lt == 0, F.get(refs, 0)).when(lt >= n, F.get(refs, n - 1)).otherwise(back_mid)
    res = (fwd + bwd) / 2
    return F.when(x.isNull(), F.lit(None)).otherwise(F.least(F.greatest(res, F.lit(0.0)), F.lit(1.0)))


def yeo_johnson(x: Column, lam) -> Column:
    lam = lam if isinstance(lam, Column) else F.lit(lam)
    pos = F.when(F.abs(lam) < 1e-12, F.log1p(x)).otherwise((F.pow(x + 1, lam) - 1) / lam)
    neg = F.when(F.abs(lam - 2) < 1e-12, -F.log1p(-x)).otherwise(-(F.pow(-x + 1, 2 - lam) - 1) / (2 - lam))
    return F.when(x >= 0, pos).otherwise(neg)


STEPS = 16          # λ values of one pass, less one
LAMBDA_DIGITS = 4   # resolution of the fitted λ


def power_fit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """J6 fit: λ maximising the Yeo-Johnson log-likelihood, then mean and
    population std of the transformed column.

    The columns are written once. Each pass is one aggregate that evaluates 17
    λ of every column; the bracket shrinks around the best one, or moves on and widens, without
    bound, if that lies at its edge; a λ whose values overflow has no
    likelihood, which ends the search at the latest. The likelihood has one
    maximum; λ is given to four decimals. Only the 17 likelihoods of a pass reach the driver."""
    df = materialize(balanced(df.select(*[F.col(c).cast("double").alias(c) for c in cols])))
    bracket = {c: (-4.0, 4.0) for c in cols}
    best: dict[str, float] = {}
    while bracket:
        aggs = []
        for c, (lo, hi) in bracket.items():
            x = F.col(c).cast("double")
            grid = [lo + (hi - lo) * i / STEPS for i in range(STEPS + 1)]
            aggs.append(F.struct(
                F.count(x).alias("n"), F.sum(F.signum(x) * F.log1p(F.abs(x))).alias("slog"),
                F.array(*[F.var_pop(yeo_johnson(x, v)) for v in grid]).alias("var")).alias(c))
        row = df.agg(*aggs).first()
        for c, (lo, hi) in list(bracket.items()):
            n, slog, var = row[c]["n"], row[c]["slog"], row[c]["var"]
            step = (hi - lo) / STEPS
            if not n or not any(v and math.isfinite(v) for v in var):
                best[c] = 1.0  # nothing to fit: the identity
                del bracket[c]
                continue
            fit = [-n / 2 * math.log(v) + (lo + i * step - 1) * slog if v and math.isfinite(v) else -math.inf
                   for i, v in enumerate(var)]
            k = max(range(len(fit)), key=fit.__getitem__)
            at = lo + k * step
            if k in (0, STEPS) and fit[k] - fit[STEPS // 2] > 1e-12 * abs(fit[k]):
                bracket[c] = (at - (hi - lo), at + (hi - lo))  # twice as wide: far λ take few passes
            elif step > 0.1 * 10.0 ** -LAMBDA_DIGITS:
                bracket[c] = (at - step, at + step)
            else:
                best[c] = round(at, LAMBDA_DIGITS)
                del bracket[c]
    aggs = []
    for c in cols:
        y = yeo_johnson(F.col(c).cast("double"), best[c])
        aggs += [F.avg(y).alias(f"{c}__mean"), F.stddev_pop(y).alias(f"{c}__std")]
    return df.agg(*aggs).withColumns({f"{c}__lambda": F.lit(best[c]) for c in cols})

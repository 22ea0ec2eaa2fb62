"""Column role inference.

Role of each column: ``index`` (given), ``label``, ``category``
(2 ≤ distinct ≤ threshold), else ``number`` / ``string`` by type; other
types (timestamps outside the index) get no role (``none``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from wtprof.functions.nulls import FILL_CATEGORY, FILL_NUMBER, FILL_STRING, fill_nulls
from wtprof.operators.aggregates import distinct_counts

CAT_THRESHOLD = 10


def infer_roles(df: DataFrame, index_cols: Sequence[str] = (), label_col: str | None = "label",
                cat_threshold: int = CAT_THRESHOLD, approx: bool = False) -> DataFrame:
    """One row per column: ``column_name, dtype, nunique, role``, from one
    distinct-count aggregate over the data. ``screen_roles`` gives the same
    roles without exact counts of columns that are plainly over the threshold."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    kind = {n: "number" if isinstance(t, NumericType) else "string" if isinstance(t, StringType) else "none"
            for n, t in fields.items()}
    cols = list(fields)
    counts = distinct_counts(df, cols, approx=approx)
    dtype = F.create_map(*[F.lit(x) for n in cols for x in (n, fields[n].simpleString())])
    knd = F.create_map(*[F.lit(x) for n in cols for x in (n, kind[n])])
    c, nu = F.col("column_name"), F.col("nunique")
    role = (F.when(c.isin(list(index_cols)), F.lit("index"))
            .when(c == F.lit(label_col), F.lit("label"))
            .when((nu >= 2) & (nu <= cat_threshold), F.lit("category"))
            .otherwise(F.element_at(knd, c)))
    return counts.select(c, F.element_at(dtype, c).alias("dtype"), nu, role.alias("role"))


def screen_roles(df: DataFrame, index_cols: Sequence[str] = (), label_col: str | None = "label",
                 cat_threshold: int = CAT_THRESHOLD, rsd: float = 0.02) -> DataFrame:
    """``column_name, dtype, role`` as :func:`infer_roles` gives them: one
    HyperLogLog pass over all columns, then exact counts only of those whose
    estimate is within ten standard errors of the threshold or below it."""
    estimate = {r["column_name"]: r["nunique"] for r in distinct_counts(df, df.columns, approx=True, rsd=rsd).collect()}
    near = [c for c in df.columns if estimate[c] <= cat_threshold * (1 + 10 * rsd) + 1]
    exact = infer_roles(df.select(*near), index_cols, label_col, cat_threshold) if near else None
    far = infer_roles(df.limit(0).select(*[c for c in df.columns if c not in near]), index_cols, label_col, cat_threshold) \
        if len(near) < len(df.columns) else None  # over the threshold: the role follows from the type
    parts = [p.select("column_name", "dtype", "role") for p in (exact, far) if p is not None]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


@dataclass
class ColumnRoles:
    index: list = field(default_factory=list)
    label: list = field(default_factory=list)
    number: list = field(default_factory=list)
    string: list = field(default_factory=list)
    category: list = field(default_factory=list)

    @classmethod
    def from_frame(cls, roles: DataFrame) -> "ColumnRoles":
        """Collects one small row per *column* (bounded by the schema width)."""
        r = cls()
        for row in roles.select("column_name", "role").collect():
            if hasattr(r, row["role"]):
                getattr(r, row["role"]).append(row["column_name"])
        return r


FILLS = {"number": str(FILL_NUMBER), "string": FILL_STRING, "category": FILL_CATEGORY}


def fit_roles(df: DataFrame, index_cols: Sequence[str] = (), label_col: str | None = "label",
              cat_threshold: int = CAT_THRESHOLD) -> DataFrame:
    """C11 + I14 as fitted state: ``(column_name, dtype, role, fill)``, a row
    for each column, to be saved with the model and applied at predict. A
    category that is a number keeps its type and is filled like a number."""
    roles = screen_roles(df, index_cols, label_col, cat_threshold)
    fills = F.create_map(*[F.lit(x) for kv in FILLS.items() for x in kv])
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    kind = F.when((F.col("role") == "category") & F.col("column_name").isin(numbers), F.lit("number")).otherwise(F.col("role"))
    return roles.select("column_name", "dtype", "role", F.try_element_at(fills, kind).alias("fill"))


def apply_roles(df: DataFrame, fitted: DataFrame) -> DataFrame:
    """``df`` with its nulls filled by the fitted roles (I14); index and label
    columns, and columns without a role, stay as they are.

    The columns must be those of the fit: one that is missing or has another
    type fails by name, whatever its role. Columns the fit doesn't know pass
    through."""
    found = dict(df.dtypes)
    state = fitted.collect()  # a row for each column
    wrong = [f"{r['column_name']}: {r['dtype']} when fitted, {found.get(r['column_name'], 'missing')} now"
             for r in state if found.get(r["column_name"]) != r["dtype"]]
    if wrong:
        raise ValueError("columns differ from the fit: " + "; ".join(sorted(wrong)))
    by_role = {role: [r["column_name"] for r in state if r["role"] == role] for role in FILLS}
    texts = [c for c in by_role["category"] if found[c] == "string"]
    numbers = by_role["number"] + [c for c in by_role["category"] if c not in texts and isinstance(df.schema[c].dataType, NumericType)]
    return fill_nulls(df, number=numbers, string=by_role["string"], category=texts)


def role_drift(df: DataFrame, fitted: DataFrame, index_cols: Sequence[str] = (), label_col: str | None = "label",
               cat_threshold: int = CAT_THRESHOLD) -> DataFrame:
    """What changed since the fit, as data: ``(column_name, dtype, role,
    found_dtype, found_role, nulls)`` of the columns whose type or role
    differs, that are new or gone (null on that side), or that hold nulls."""
    now = screen_roles(df, index_cols, label_col, cat_threshold).select(
        F.col("column_name").alias("_c"), F.col("dtype").alias("found_dtype"), F.col("role").alias("found_role"))
    nulls = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    nulls = nulls.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in df.columns]),
                                                    F.array(*[F.col(f"`{c}`") for c in df.columns]))).alias("_n", "nulls"))
    both = fitted.join(now.join(nulls, F.col("_c") == F.col("_n")), F.col("column_name") == F.col("_c"), "full")
    out = both.select(F.coalesce("column_name", "_c").alias("column_name"), "dtype", "role", "found_dtype", "found_role", "nulls")
    same = F.col("dtype").eqNullSafe(F.col("found_dtype")) & F.col("role").eqNullSafe(F.col("found_role")) & (F.coalesce("nulls", F.lit(0)) == 0)
    return out.where(~same)

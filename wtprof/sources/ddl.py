"""Table layout and schema evolution."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAME_RE = re.compile(r"^[A-Za-z0-9_]+$")

# Fixed map of the log store's column types to Spark types (wrapped types
# are handled by recursion).
TYPE_MAP = {
    "Int8": "tinyint", "Int16": "smallint", "Int32": "int", "Int64": "bigint",
    "Int128": "decimal(38,0)", "Int256": "decimal(38,0)",
    "UInt8": "smallint", "UInt16": "int", "UInt32": "bigint", "UInt64": "decimal(20,0)",
    "UInt128": "decimal(38,0)", "UInt256": "decimal(38,0)",
    "Float32": "float", "Float64": "double",
    "Enum8": "string", "Enum16": "string", "String": "string", "FixedString": "string", "UUID": "string",
    "IPv4": "string", "IPv6": "string",
    "Date": "date", "DateTime": "timestamp", "DateTime64": "timestamp",
}


def spark_type(t: str) -> str:
    """Log-store type name (parameters allowed) → Spark SQL type string."""
    t = t.strip()
    m = re.fullmatch(r"(\w+)\((.*)\)", t)
    base, arg = (m.group(1), m.group(2)) if m else (t, None)
    if base in ("Nullable", "LowCardinality"):
        return spark_type(arg)
    if base == "Array":
        return f"array<{spark_type(arg)}>"
    if base == "Map":
        k, v = _split_args(arg)
        return f"map<{spark_type(k)},{spark_type(v)}>"
    if base == "Tuple":
        parts = _split_args(arg)
        return "struct<" + ",".join(f"_{i + 1}:{spark_type(p)}" for i, p in enumerate(parts)) + ">"
    if base == "Decimal":
        if arg:
            return f"decimal({arg.replace(' ', '')})"
        return "decimal(10,0)"
    if base in TYPE_MAP:
        return TYPE_MAP[base]
    raise ValueError(f"unknown column type {t!r}")


def _split_args(s: str) -> list[str]:
    out, depth, cur = [], 0, ""
    for ch in s:
        if ch == "," and depth == 0:
            out.append(cur.strip())
            cur = ""
            continue
        depth += ch == "("
        depth -= ch == ")"
        cur += ch
    out.append(cur.strip())
    return out


def check_columns(columns: Sequence[tuple[str, str]]) -> bool:
    """Whole-name check (letters, digits, underscore) and known types."""
    try:
        return all(NAME_RE.match(n) and spark_type(t) for n, t in columns)
    except ValueError:
        return False


def create_table(spark: SparkSession, df: DataFrame, name: str, path: str, partition_by: Sequence[str] = (),
                 order_by: Sequence[str] = (), bucket_by: tuple[int, Sequence[str]] | None = None) -> DataFrame:
    """B2: external parquet table with a partition and a sort key; refuses
    an existing table. Rows are clustered by the partition columns first so
    each task writes few partition folders."""
    if spark.catalog.tableExists(name):
        raise ValueError(f"table {name} already exists")
    if not NAME_RE.match(name.split(".")[-1]):
        raise ValueError(f"bad table name {name!r}")
    d = df.repartition(*partition_by) if partition_by else df
    if order_by:
        d = d.sortWithinPartitions(*partition_by, *order_by)
    w = d.write.option("path", path).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*order_by) if order_by else w.bucketBy(
            bucket_by[0], *bucket_by[1])
    w.saveAsTable(name)
    return spark.table(name)


MODIFY_TYPES = ("ADD", "DROP", "RENAME", "CLEAR", "COMMENT", "MODIFY")


def evolve_table(df: DataFrame, op: str, column: str, arg=None) -> DataFrame:
    """Schema change as a new version of the table's rows.

    ADD (column, type), DROP, RENAME (to ``arg``), CLEAR (set null, keep
    type), COMMENT (column metadata), MODIFY (cast to ``arg``). Parquet v1
    tables refuse DROP/RENAME COLUMN, so every change is a rewrite the
    caller saves as a new version (A8/A11)."""
    op = op.upper()
    if op not in MODIFY_TYPES:
        raise ValueError(f"unknown change {op!r}")
    if op == "ADD":
        return df.withColumn(column, F.lit(None).cast(spark_type(arg) if arg[0].isupper() else arg))
    if op == "DROP":
        return df.drop(column)
    if op == "RENAME":
        return df.withColumnRenamed(column, arg)
    if op == "CLEAR":
        return df.withColumn(column, F.lit(None).cast(df.schema[column].dataType))
    if op == "COMMENT":
        return df.withMetadata(column, {"comment": arg})
    return df.withColumn(column, F.col(column).try_cast(spark_type(arg) if arg[0].isupper() else arg))


def alter_table(spark: SparkSession, name: str, op: str, column: str, arg=None) -> DataFrame:
    """B4 on a catalog table: ADD and COMMENT are metadata changes (ALTER
    TABLE); DROP, RENAME, CLEAR and MODIFY, which Parquet tables refuse, write
    the changed rows as a new table beside the old one and swap the names, so
    a failed rewrite leaves the old table as it was."""
    op = op.upper()
    for n in (column, *([arg] if op == "RENAME" else [])):
        if not NAME_RE.match(n):
            raise ValueError(f"bad column name {n!r}")
    if op == "ADD":
        kind = spark_type(arg) if arg[0].isupper() else arg
        kind = kind if isinstance(kind, str) else kind.simpleString()
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS (`{column}` {kind})")
    elif op == "COMMENT":
        text = str(arg).replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{column}` COMMENT '{text}'")
    else:
        made = f"{name}__new"
        evolve_table(spark.table(name), op, column, arg).write.format("parquet").saveAsTable(made)
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {made} RENAME TO {name}")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def conform_schema(df: DataFrame, declared: Sequence[tuple[str, str]], bad_col: str = "bad_columns") -> DataFrame:
    """Cast every declared column with ``try_cast`` and list, per row,
    the columns whose non-null value did not fit (became null)."""
    for n, _ in declared:
        if not NAME_RE.match(n):
            raise ValueError(f"bad column name {n!r}")
    casts = {n: F.col(n).try_cast(spark_type(t)) for n, t in declared}
    bad = F.array_compact(F.array(*[F.when(F.col(n).isNotNull() & casts[n].isNull(), F.lit(n)) for n, _ in declared]))
    return df.select(*[casts[n].alias(n) for n, _ in declared], bad.alias(bad_col))

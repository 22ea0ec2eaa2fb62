"""Sources and sinks.

Everything is a Spark reader/writer: parquet tables partitioned by
``version`` hold fitted state and snapshots; appends are plain writer
appends; configuration documents are JSON strings parsed with from_json.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wtprof.functions.timeutil import parse_delta_seconds


def scan_log(spark: SparkSession, source: str, cols: Sequence[str], start=None, end=None,
             time_col: str = "logtime", fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """A1: the log columns a job needs; the projection and the half-open
    time range reach the scan (``ReadSchema`` / ``PushedFilters``).

    ``source``: a catalog table name, or a path read with ``fmt``. With
    ``fmt="jdbc"`` ``source`` is the remote table and ``options`` carry the
    URL, driver and partitioning (``partitionColumn``, ``numPartitions``…);
    filters and columns are pushed into the remote query. That path needs
    a JDBC driver on the classpath and is not exercised by the tests here.
    """
    if fmt == "jdbc":
        df = spark.read.format("jdbc").options(dbtable=source, **(options or {})).load()
    elif "/" not in source:
        df = spark.table(source)
    else:
        df = spark.read.format(fmt).options(**(options or {})).load(source)
    df = df.select(*cols)
    if start is not None:
        df = df.where(F.col(time_col) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(time_col) < F.lit(end))
    return df


def schema_profile(df: DataFrame) -> DataFrame:
    """A2: ``(column_name, dtype, non_null)`` from the schema and one
    aggregate of non-null counts."""
    cols = df.columns
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in cols])
    long = counts.unpivot([], cols, "column_name", "non_null")
    types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    return long.select("column_name", F.element_at(types, F.col("column_name")).alias("dtype"), "non_null")


MAPPING_SCHEMA = "note string, mapping string"


def read_mapping_csv(spark: SparkSession, path: str, schema: str | StructType = MAPPING_SCHEMA) -> DataFrame:
    """A3: header CSV with an explicit schema (no inference pass)."""
    return spark.read.csv(path, header=True, schema=schema)


CONFIG_SECTIONS = {"TRAIN": "train", "TEST_TRAIN": "train", "PREDICTION": "predict", "TEST_PREDICTION": "predict",
                   "COMMON": "common"}


def load_model_config(meta: DataFrame, mode: str, section_schema: str, common_schema: str,
                      config_col: str = "config") -> DataFrame:
    """A4: parse each model's JSON config; project the section of ``mode``
    and, for train/predict modes, attach ``common`` and turn ``now_delta`` /
    ``prev_delta`` into seconds (I7). Unknown mode → the whole document."""
    sec = CONFIG_SECTIONS.get(mode)
    if sec is None:
        return meta
    doc = F.from_json(F.col(config_col), f"struct<{sec}: struct<{section_schema}>, common: struct<{common_schema}>>")
    d = meta.withColumn("_doc", doc)
    out = d.select("model_id", F.col(f"_doc.{sec}.*"),
                   *([F.col("_doc.common").alias("common")] if sec != "common" else []))
    if sec != "common":
        for k in ("now_delta", "prev_delta"):
            if k in out.columns:
                out = out.withColumn(f"{k}_seconds", parse_delta_seconds(F.col(k)))
    return out


def model_exists(meta: DataFrame, requested: DataFrame, id_col: str = "model_id") -> DataFrame:
    """A5: model name per requested id; null when absent (left join)."""
    return requested.join(meta.select(id_col, "model_name"), id_col, "left")


def append_results(df: DataFrame, target: str, cols: Sequence[str] | None = None, fmt: str = "parquet") -> None:
    """Append rows to a result table (catalog name) or folder (path)."""
    d = df.select(*cols) if cols else df
    if "/" in target:
        d.write.mode("append").format(fmt).save(target)
    else:
        d.write.mode("append").saveAsTable(target)


def append_batched(df: DataFrame, path: str, max_records: int = 200_000, fmt: str = "parquet") -> None:
    """Append in files of at most ``max_records`` rows (the writer does
    the slicing; no driver loop)."""
    df.write.mode("append").option("maxRecordsPerFile", max_records).format(fmt).save(path)


def snapshot(df: DataFrame, base: str, version: str) -> DataFrame:
    """Save the loaded data of a run under ``version=…`` and return the
    re-read snapshot (cuts the lineage to the source)."""
    path = os.path.join(base, f"version={version}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def save_fit(state: DataFrame, base: str, name: str, version: str) -> str:
    """Persist fitted state (vocabulary, scaler parameters, labels,
    threshold) as ``<base>/<name>/version=<v>``; overwrites that version
    only (A11)."""
    path = os.path.join(base, name)
    (state.withColumn("version", F.lit(version)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(path))
    return path


def load_fit(spark: SparkSession, base: str, name: str, version) -> DataFrame:
    """Fitted state of one version (partition pruning on ``version``);
    ``version`` may be a string or a Column (e.g. a scalar subquery)."""
    v = version if not isinstance(version, str) else F.lit(version)
    return spark.read.parquet(os.path.join(base, name)).where(F.col("version") == v).drop("version")


def latest_version(versions: DataFrame, as_of, version_col: str = "version") -> DataFrame:
    """A10: newest version at or before ``as_of`` (``YYYY_MM_DD`` strings
    order like dates); one row, null when none."""
    return versions.where(F.col(version_col) <= F.lit(as_of)).agg(F.max(version_col).alias(version_col))


def latest_version_per_row(df: DataFrame, versions: DataFrame, day_col: str, version_col: str = "version",
                           out: str = "model_version") -> DataFrame:
    """A10 per row (as-of join): each row gets the newest version ≤ its day.

    The rows' distinct days and the version days are stacked and scanned in
    date order with ``last(…, ignorenulls)``: a calendar-sized table (one
    row per day), so no pairs are formed. The result joins back on the day.
    """
    days = df.select(F.col(day_col).cast("date").alias("_d")).distinct().select(
        "_d", F.lit(None).cast("string").alias("_v"), F.lit(1).alias("_is_day"))
    vers = versions.select(F.to_date(F.col(version_col), "yyyy_MM_dd").alias("_d"),
                           F.col(version_col).alias("_v"), F.lit(0).alias("_is_day"))
    from pyspark.sql import Window
    w = Window.orderBy("_d", "_is_day").rowsBetween(Window.unboundedPreceding, 0)
    cal = (days.unionByName(vers).withColumn(out, F.last("_v", ignorenulls=True).over(w))
           .where(F.col("_is_day") == 1).select("_d", out))
    return df.join(F.broadcast(cal), F.col(day_col).cast("date") == F.col("_d"), "left").drop("_d")


def run_sql(spark: SparkSession, text: str, args: dict | None = None, views: dict | None = None) -> DataFrame:
    """Parameterised SQL with bound named parameters (no pasting)."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=args or {})


def replace_artifact(df: DataFrame, base: str, name: str, version: str) -> str:
    """Publish a new artifact over the old one of the same version
    (dynamic partition overwrite: other versions stay)."""
    return save_fit(df, base, name, version)

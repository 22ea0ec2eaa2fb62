"""Window functions (H1-H4). Every window is partitioned: no global order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wtprof.session import materialize


def row_numbering(df: DataFrame, partition: Sequence[str], order: Sequence[str], name: str = "row_id") -> DataFrame:
    """H1: stable 1-based ordinal within each partition key, in key order.

    Rows are range-partitioned by (key, order), so a key with many rows spans
    several tasks. The sorted rows are written with their partition number;
    an ordinal is the number within (partition, key) plus the key's rows in
    earlier partitions (a table of a row for each key and partition)."""
    cut = materialize(df.orderBy(*partition, *order).withColumn("_pid", F.spark_partition_id()))
    keys = [F.col(p) for p in partition]
    local = F.row_number().over(Window.partitionBy("_pid", *partition).orderBy(*order))
    sizes = cut.groupBy("_pid", F.struct(*keys).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_key").orderBy("_pid")) - F.col("_n")
    sizes = sizes.select("_pid", F.to_json("_key").alias("_key"), before.alias("_before"))
    out = cut.withColumn("_local", local).withColumn("_key", F.to_json(F.struct(*keys))).join(sizes, ["_pid", "_key"])
    return out.withColumn(name, F.col("_before") + F.col("_local")).drop("_pid", "_key", "_local", "_before")


def center_by_median(long: DataFrame, key: Sequence[str], value_col: str = "value", out: str = "centered") -> DataFrame:
    """H2: value minus the median of its row's vector (dense long form:
    every feature of the row present, zeros included)."""
    w = Window.partitionBy(*key)
    return long.withColumn(out, F.col(value_col) - F.median(value_col).over(w))


def epoch_number(df: DataFrame, partition: Sequence[str], order: Sequence[str], name: str = "epochs") -> DataFrame:
    """H3: 1-based epoch ordinal per run (a run has few epochs: one window)."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))


def l2_norm(long: DataFrame, key: Sequence[str], value_col: str = "value", out: str | None = None) -> DataFrame:
    """H4: divide by the Euclidean norm of the row's vector (zero vector stays 0)."""
    w = Window.partitionBy(*key)
    norm = F.sqrt(F.sum(F.col(value_col) * F.col(value_col)).over(w))
    return long.withColumn(out or value_col, F.when(norm > 0, F.col(value_col) / norm).otherwise(F.lit(0.0)))

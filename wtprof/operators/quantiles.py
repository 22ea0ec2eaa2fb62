"""Exact quantiles without gathering a column in one task.

Distinct values are counted (a partial aggregate runs first), sorted into
range partitions and written with their partition number. Partition totals,
one row each, turn a wanted rank into a rank within one partition; a running
window there picks the value. Only the wanted values reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wtprof.session import materialize


def exact_quantiles(df: DataFrame, x: Column, ps: Sequence[float]) -> list[float] | None:
    """Linearly interpolated quantiles ``ps`` of the non-null values of ``x``
    (as double), or None if there are none."""
    values = df.select(x.cast("double").alias("x")).where(F.col("x").isNotNull())
    counts = values.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    parts = materialize(counts.orderBy("x").withColumn("pid", F.spark_partition_id()))
    sizes = sorted((r["pid"], r["n"]) for r in parts.groupBy("pid").agg(F.sum("n").alias("n")).collect())
    total = sum(n for _, n in sizes)
    if not total:
        return None
    places = [p * (total - 1) for p in ps]
    ranks = sorted({r for q in places for r in (math.floor(q), math.ceil(q))})
    wanted, k, before = [], 0, 0
    for pid, n in sizes:
        while k < len(ranks) and ranks[k] < before + n:
            wanted.append((pid, ranks[k] - before, ranks[k]))
            k += 1
        before += n
    spark = df.sparkSession
    asked = spark.createDataFrame(wanted, "pid int, local long, rank long")
    running = Window.partitionBy("pid").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    rows = parts.select("pid", (F.sum("n").over(running) - 1).alias("local"), "x", F.lit(None).cast("long").alias("rank"))
    # a rank takes the first value whose last place reaches it: read backwards, the latest one seen
    back = Window.partitionBy("pid").orderBy(F.desc("local"), F.col("rank").isNotNull()).rowsBetween(
        Window.unboundedPreceding, 0)
    both = rows.unionByName(asked.select("pid", "local", F.lit(None).cast("double").alias("x"), "rank"))
    found = both.select("rank", F.last("x", ignorenulls=True).over(back).alias("x")).where("rank is not null").collect()
    at = {r["rank"]: r["x"] for r in found}
    return [at[math.floor(q)] + (at[math.ceil(q)] - at[math.floor(q)]) * (q - math.floor(q))
            if math.ceil(q) != math.floor(q) else at[math.floor(q)] for q in places]

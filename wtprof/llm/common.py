"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wtprof.session import scratch_path


PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


ARROW_ROWS = 2000  # a document is a large row: batches of Spark's 10 000 would be tens of megabytes


def importable(spark: SparkSession) -> None:
    """Ready the session for this package's Python workers: they can import
    it where it lies in the same folder as here (local runs, shared installs;
    on other clusters ship it with ``--py-files``), and Arrow batches hold at
    most ``ARROW_ROWS`` rows unless the session asks for another number than
    Spark's default."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows, "10000") == "10000":
        spark.conf.set(rows, str(ARROW_ROWS))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, PACKAGE_ROOT])


_STATE: dict[Any, Any] = {}


def worker_state(key: Any, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps between tasks (vocabularies, word tables).
    Only one operator's state is kept: the next operator's takes its place,
    so a worker that serves several stages holds one table at a time."""
    if key not in _STATE:
        _STATE.clear()
        gc.collect()
        _STATE[key] = make()
    return _STATE[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table; ``sf_dir`` may be any path Spark reads."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(col: str) -> Column:
    """The text as string; null counts as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: later plans start from files every executor sees, so a lost
    executor costs a re-read, not a recomputation."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str, out: str = "idx") -> DataFrame:
    """The rows of ``df``, written, with a gapless number from 0 (``out``).

    A row's place in its partition is written with it; the sizes of the
    earlier partitions (one small row each) are added. Nothing is sorted, and
    every later read sees the same numbers."""
    rows = written(df.withColumn("_place", F.monotonically_increasing_id()), name)
    part = F.shiftright("_place", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    place = F.col("_before") + F.col("_place").bitwiseAND((1 << 33) - 1)
    return (rows.withColumn("_part", part).join(F.broadcast(before), "_part")
            .withColumn(out, place).drop("_part", "_before", "_place"))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_join(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """Inner join of ``many`` rows with at most one row a key of ``one``, where
    a key may hold any share of ``many``.

    A key with more than its share (all rows over twice the shuffle width) is
    hot; there are at most that many such keys, so their list can be sent to
    every task. A hot key's rows are dealt to as many salts as it has shares,
    and its row of ``one`` is repeated for each."""
    share = 2 * shuffle_width(many.sparkSession)
    sizes = many.groupBy(key).agg(F.count("*").alias("_n"))
    limit = max(1, many.count() // share)
    hot = F.broadcast(written(sizes.where(F.col("_n") > limit).select(key, F.ceil(F.col("_n") / limit).alias("_salts")), "hot"))
    salts = F.coalesce("_salts", F.lit(1))
    left = many.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*[c for c in many.columns if c != key]), salts)).drop("_salts")
    right = one.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("_salts")
    return left.join(right, [key, "_salt"]).drop("_salt")

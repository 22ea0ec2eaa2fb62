"""Table access and the HTTP-log fixture view.

The production input is an HTTP log table with columns
``logtime, src_ip, dst_ip, http_host, http_agent, http_query, hash``.
For tests and benches that log is derived from the given ``events`` and
``pages`` tables (see FIXTURES.md §3), so its size grows with them.
"""

from __future__ import annotations

import os

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def load_table(spark: SparkSession, sf_dir: str, name: str, balance: bool = False) -> DataFrame:
    """Parquet scan of one table; filters and projections push into the scan.

    ``balance=True`` is for inputs of CPU-heavy per-row work (regex, text):
    see :func:`balanced`.
    """
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return balanced(df) if balance else df


def balanced(scan: DataFrame) -> DataFrame:
    """Spread a plain file scan over the cluster when it has fewer splits
    than the default parallelism (e.g. one large row group). A round-robin
    repartition is skew-free; with many splits (big inputs) this is a no-op,
    so large jobs keep their scan-side partitioning and pay no shuffle.
    The split count of a bare scan comes from file listing only (no job)."""
    try:
        target = scan.sparkSession.sparkContext.defaultParallelism
        splits = scan.rdd.getNumPartitions()
    except PySparkException:  # no RDD view (e.g. Spark Connect): keep the scan as is
        return scan
    return scan.repartition(target) if splits < target else scan


# Fixed values of the fixture view (FIXTURES.md §3): agent strings by
# user_id % 3, payload suffix and class by event_type.
AGENTS = ["Mozilla/5.0 (X11; Linux)", "curl/7.68.0", "python-requests/2.25"]
PAYLOADS = {
    "error": "&id=1%27%20OR%201=1--",
    "purchase": "/..%2F../etc/passwd%zz",
    "signup": "&q=%3Cscript%3Ealert(1)%3C/script%3E",
    "view": "&user=admin+x",
}
CLASSES = {
    "error": "SQL_INJECTION",
    "signup": "XSS",
    "purchase": "BEACONING",
    "view": "CREDENTIAL",
}


def _case(col: Column, mapping: dict, default) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v)))
    return out.otherwise(F.lit(default))


def http_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTTP log derived from ``events`` ⋈ ``pages``.

    ``n_pages`` is a scalar subquery (one value), not a cross join. The join
    is an equi-join on a computed key; Spark/AQE picks broadcast only when
    the pages side is measured small.
    """
    ev = load_table(spark, sf_dir, "events", balance=True)
    pages = load_table(spark, sf_dir, "pages").select("page_id", "url")
    return http_log_from(ev, pages, pages.count())


# Broadcast the page side only up to this many rows (URL strings: a few
# hundred MB at most); beyond it the join is left to a shuffled plan.
BROADCAST_MAX_ROWS = 2_000_000


def http_log_from(ev: DataFrame, pages: DataFrame, n_pages: int) -> DataFrame:
    """The fixture mapping over any ``events``-shaped frame (batch or
    stream). ``n_pages`` is the page count (a parquet count reads footers
    only); it is both the join key's modulus and the broadcast size check."""
    pages = pages.select("page_id", "url")
    e = ev.withColumn("_page", F.col("event_id") % F.lit(n_pages))
    side = F.broadcast(pages) if n_pages <= BROADCAST_MAX_ROWS else pages
    j = e.join(side, e["_page"] == side["page_id"])
    uid = F.col("user_id")
    agent = (F.when(uid % 3 == 0, F.lit(AGENTS[0]))
             .when(uid % 3 == 1, F.lit(AGENTS[1]))
             .otherwise(F.lit(AGENTS[2])))
    return j.select(
        F.col("ts").alias("logtime"),
        F.concat(F.lit("10.0.0."), (uid % 256).cast("string")).alias("src_ip"),
        F.concat(F.lit("192.168.0."), (F.col("page_id") % 8).cast("string")).alias("dst_ip"),
        F.regexp_extract("url", r"https?://([^/]+)", 1).alias("http_host"),
        agent.alias("http_agent"),
        F.concat(F.regexp_extract("url", r"https?://[^/]+(.*)", 1),
                 _case(F.col("event_type"), PAYLOADS, "")).alias("http_query"),
        _case(F.col("event_type"), CLASSES, "normal").alias("hash"),
        F.when(F.col("event_id") % 17 == 0, F.lit(None).cast("int"))
         .otherwise((F.col("event_id") % 5).cast("int")).alias("status"),
        F.col("event_id"),
        F.when(uid % 4 == 0, F.lit(80)).when(uid % 4 == 1, F.lit(443))
         .when(uid % 4 == 2, F.lit(8080)).otherwise(F.lit(8443)).alias("dst_port"),
        F.when(F.col("event_id") % 17 == 0, F.lit(None).cast("int"))
         .otherwise(((F.col("event_id") % 5 + 1) * 100).cast("int")).alias("status_code"),
    )

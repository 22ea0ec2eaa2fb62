"""Job windows (I8): the moving ranges a scheduled job reads.

For each job config (crontab, now_delta, prev_delta, run_time):
``logtime_e = run_time − now_delta``, ``logtime_s = logtime_e − prev_delta``,
dates of both, eight weeks and one day before the end, and the bucket unit
from the crontab. ``rows_in_windows`` gives each job its log rows: the
config windows are exploded into their days (bounded by window length) and
equi-joined to the log on the day, then filtered to the exact range — no
nested-loop join over log rows × jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wtprof.functions.timeutil import cron_bucket, parse_delta_seconds
from wtprof.operators.vectorize import small_side
from wtprof.session import materialize


def run_windows(configs: DataFrame) -> DataFrame:
    now = F.timestamp_add("SECOND", -parse_delta_seconds(F.col("now_delta")), F.col("run_time"))
    prev = F.timestamp_add("SECOND", -parse_delta_seconds(F.col("prev_delta")), F.col("logtime_e"))
    d = configs.withColumn("logtime_e", now).withColumn("logtime_s", prev)
    return d.select(
        "job_id", "logtime_s", "logtime_e",
        F.date_format("logtime_s", "yyyy-MM-dd").alias("logdate_s"),
        F.date_format("logtime_e", "yyyy-MM-dd").alias("logdate_e"),
        F.date_format(F.timestamp_add("DAY", F.lit(-56), F.col("logtime_e")), "yyyy-MM-dd").alias("logdate_m"),
        F.date_format(F.timestamp_add("DAY", F.lit(-1), F.col("logtime_e")), "yyyy-MM-dd").alias("logdate_day"),
        cron_bucket(F.col("crontab")).alias("unit"))


def rows_in_windows(log: DataFrame, windows: DataFrame, time_col: str = "logtime") -> DataFrame:
    """Log rows of every job window, tagged with ``job_id``."""
    days = windows.select("job_id", "logtime_s", "logtime_e",
                          F.explode(F.sequence(F.to_date("logtime_s"), F.to_date("logtime_e"))).alias("_day"))
    t = F.col(time_col)
    days = materialize(days)  # job windows × days: broadcast after a check of the size
    j = log.withColumn("_day", F.to_date(t)).join(small_side(days), "_day")
    return j.where((t >= F.col("logtime_s")) & (t < F.col("logtime_e"))).drop("_day", "logtime_s", "logtime_e")

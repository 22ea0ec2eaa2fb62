"""Streaming semantics: the watermark closes windows; dedupe within it."""

import datetime as dt
import uuid

from wtprof.session import scratch_path
from wtprof.streaming import sessions as N

SCHEMA = "logtime timestamp_ntz, src_ip string, dst_ip string, http_agent string, http_query string, hash string"


def _row(h, m, q):
    return (dt.datetime(2024, 1, 1, h, m), "10.0.0.1", "192.168.0.1", "curl/7", q, "normal")


def test_closed_windows_only_and_in_time_rows_kept(spark):
    """Spark's guarantee is one-way: rows within the delay are never
    dropped; rows behind the watermark may or may not be counted."""
    run = scratch_path(spark, f"stream_test_{uuid.uuid4().hex[:8]}")
    # batch 1 moves event time to 12:30 → watermark 11:30 closes the 10:00 window
    spark.createDataFrame([_row(10, 5, "/a"), _row(10, 50, "/b"), _row(12, 30, "/c")], SCHEMA) \
        .coalesce(1).write.parquet(f"{run}/src/f1")
    # batch 2: a row for the closed 10:00 window (late) and one for 11:00
    spark.createDataFrame([_row(10, 15, "/late"), _row(11, 45, "/d")], SCHEMA) \
        .coalesce(1).write.parquet(f"{run}/src/f2")
    src = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True) \
        .parquet(f"{run}/src")
    N.run_to_completion(N.stream_session_text(src, "1 hour", "1 hour"), f"{run}/sink", f"{run}/ckpt")
    out = spark.read.parquet(f"{run}/sink").collect()
    # only the 10:00 window is closed (watermark 11:30); 11:00 and 12:00 stay open
    assert [r["lgtime"] for r in out] == [dt.datetime(2024, 1, 1, 10)]
    assert out[0]["query"].startswith(" a  b")  # in-time texts present (sorted set)


def test_dedupe_within_watermark(spark):
    run = scratch_path(spark, f"dedupe_test_{uuid.uuid4().hex[:8]}")
    spark.createDataFrame([_row(10, 5, "/a"), _row(10, 6, "/a"), _row(10, 7, "/b")], SCHEMA) \
        .write.parquet(f"{run}/src")
    src = spark.readStream.schema(SCHEMA).parquet(f"{run}/src")
    d = N.stream_dedupe(src, ["src_ip", "http_query"], "1 hour")
    N.run_to_completion(d, f"{run}/sink", f"{run}/ckpt")
    assert sorted(r["http_query"] for r in spark.read.parquet(f"{run}/sink").collect()) == ["/a", "/b"]


def test_replayed_batch_is_not_duplicated(spark):
    sink = scratch_path(spark, f"sink_test_{uuid.uuid4().hex[:8]}")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    N.write_batch(df, sink, 0)
    N.write_batch(df, sink, 0)  # replay after a failure
    N.write_batch(df.limit(1), sink, 1)
    out = spark.read.parquet(sink)
    assert out.count() == 3 and out.where("batch_id = 0").count() == 2

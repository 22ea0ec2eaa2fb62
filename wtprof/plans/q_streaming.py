"""Checked queries: streaming sessions, micro-batch scoring, dedupe.

Each builder copies ``events`` once into a fresh folder under the shared
checkpoint dir, runs the stream with ``availableNow`` into a parquet sink
and returns the sink read as a batch table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wtprof.plans.registry import clean_sql, register, with_log
from wtprof.session import scratch_path
from wtprof.sources.tables import http_log_from, load_table
from wtprof.streaming import sessions as N


def _stream_log(spark, sf):
    run = scratch_path(spark, f"stream_{uuid.uuid4().hex[:12]}")
    ev = load_table(spark, sf, "events")
    ev.write.parquet(f"{run}/source")
    pages = load_table(spark, sf, "pages")
    n_pages = pages.count()  # a number: scalar subqueries are not allowed in streams
    stream = N.events_stream(spark, f"{run}/source", ev.schema)
    return run, http_log_from(stream, pages, n_pages)


def _agg(c):
    return f"coalesce(array_to_string(list_sort(list(DISTINCT {c}) FILTER (WHERE {c} IS NOT NULL)), ' '), '') AS {c}"


@register("stream_session_text", with_log(f"""
, c AS (SELECT date_trunc('hour', logtime) AS lgtime, src_ip, dst_ip, hash AS label,
          {clean_sql('http_agent')} AS agent, {clean_sql('http_query')} AS query FROM http_log)
SELECT lgtime, src_ip, dst_ip, label, {_agg('agent')}, {_agg('query')} FROM c
WHERE lgtime + INTERVAL 1 HOUR <= (SELECT max(logtime) FROM http_log) - INTERVAL 1 HOUR
GROUP BY ALL"""))
def q_stream_session_text(spark, sf):
    """N1 = D2 on closed windows (end ≤ max event time − delay)."""
    run, log = _stream_log(spark, sf)
    N.run_to_completion(N.stream_session_text(log, "1 hour", "1 hour"), f"{run}/sink", f"{run}/ckpt")
    return spark.read.parquet(f"{run}/sink")


@register("stream_dedupe", with_log("SELECT DISTINCT src_ip, dst_ip, hash FROM http_log"))
def q_stream_dedupe(spark, sf):
    run, log = _stream_log(spark, sf)
    d = N.stream_dedupe(log.select("logtime", "src_ip", "dst_ip", "hash"), ["src_ip", "dst_ip", "hash"], "1 hour")
    N.run_to_completion(d, f"{run}/sink", f"{run}/ckpt")
    return spark.read.parquet(f"{run}/sink").select("src_ip", "dst_ip", "hash")


@register("stream_predict")
def q_stream_predict(spark, sf):
    """Closed sessions from N1, scored per micro-batch by the newest
    trained model into result records (tests compare them with the batch job)."""
    from wtprof.plans.jobs import stream_predict_job
    from wtprof.plans.q_models import trained_artifacts
    run, log = _stream_log(spark, sf)
    N.run_to_completion(N.stream_session_text(log, "1 hour", "1 hour"), f"{run}/sessions", f"{run}/ckpt1")
    sessions = spark.readStream.schema(spark.read.parquet(f"{run}/sessions").schema).parquet(f"{run}/sessions")
    stream_predict_job(spark, sessions, trained_artifacts(spark, sf), "2024_01_31", "1 hour", f"{run}/scored", f"{run}/ckpt2")
    return spark.read.parquet(f"{run}/scored").drop("batch_id")

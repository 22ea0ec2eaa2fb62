"""Checked queries: session text, text cleaning, time buckets, class filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from wtprof.functions import text as T
from wtprof.functions.timeutil import time_bucket
from wtprof.operators import filters as C
from wtprof.operators.sessions import session_text, session_text_labeled, status_class_counts
from wtprof.plans.registry import clean_sql, register, with_log
from wtprof.sources.tables import http_log

# Window used by the time-range queries (half open).
RANGE_START, RANGE_END = "2024-01-03 00:00:00", "2024-01-28 00:00:00"


def _agg_sql(col: str) -> str:
    return (f"coalesce(array_to_string(list_sort(list(DISTINCT {col}) FILTER (WHERE {col} IS NOT NULL)), ' '), '')"
            f" AS {col}")


def _session_sql(bucket: str, where: str, label: str, group_label: bool) -> str:
    lab = "hash AS label" if group_label else f"'{label}' AS label"
    grp = ", label"
    return with_log(f"""
, c AS (
  SELECT {bucket} AS lgtime, src_ip, dst_ip, {lab},
         {clean_sql('http_agent')} AS agent, {clean_sql('http_query')} AS query
  FROM http_log WHERE {where})
SELECT lgtime, src_ip, dst_ip, label, {_agg_sql('agent')}, {_agg_sql('query')}
FROM c GROUP BY lgtime, src_ip, dst_ip{grp}""")


@register("session_text", _session_sql("date_trunc('minute', logtime)", "hash = 'normal'", "normal", False))
def q_session_text(spark, sf):
    """Flagship D1: normal traffic by (minute, src, dst)."""
    return session_text(C.by_label(http_log(spark, sf), "normal"), "1 minute", label_value="normal")


@register("session_text_pre_distinct", _session_sql("date_trunc('day', logtime)", "true", "", True))
def q_session_text_pre_distinct(spark, sf):
    """D2 by day with the skew option: texts de-duplicated per session first."""
    return session_text_labeled(http_log(spark, sf), "1 day", pre_distinct=True)


@register("session_text_hour", _session_sql("date_trunc('hour', logtime)", "hash = 'XSS'", "XSS", False))
def q_session_text_hour(spark, sf):
    return session_text(C.by_label(http_log(spark, sf), "XSS"), "1 hour", label_value="XSS")


_PRED_WHERE = (f"logtime >= TIMESTAMP '{RANGE_START}' AND logtime < TIMESTAMP '{RANGE_END}' "
               "AND hash NOT LIKE '%nourl%' AND hash != 'anomaly_2'")


@register("session_text_labeled", _session_sql("date_trunc('minute', logtime)", _PRED_WHERE, "", True))
def q_session_text_labeled(spark, sf):
    """D2 predict path: C1 → C3 → group with label."""
    log = C.predict_filter(C.time_range(http_log(spark, sf), RANGE_START, RANGE_END))
    return session_text_labeled(log, "1 minute")


@register("session_text_labeled_day", _session_sql("date_trunc('day', logtime)", "true", "", True))
def q_session_text_labeled_day(spark, sf):
    return session_text_labeled(http_log(spark, sf), "1 day")


@register("status_class_counts", with_log("""
SELECT date_trunc('hour', logtime) AS lgtime, src_ip, dst_ip,
  count(DISTINCT dst_port) AS dst_port_cnt,
  count(*) FILTER (WHERE status_code // 100 = 1) AS info_st,
  count(*) FILTER (WHERE status_code // 100 = 2) AS succ_st,
  count(*) FILTER (WHERE status_code // 100 = 3) AS redir_st,
  count(*) FILTER (WHERE status_code // 100 = 4) AS cler_st,
  count(*) FILTER (WHERE status_code // 100 = 5) AS serer_st,
  count(*) FILTER (WHERE status_code IS NULL OR status_code // 100 < 1 OR status_code // 100 > 5) AS oth_st
FROM http_log GROUP BY 1, 2, 3"""))
def q_status_class_counts(spark, sf):
    return status_class_counts(http_log(spark, sf), "1 hour")


@register("time_range", with_log(f"""
SELECT event_id, logtime, hash FROM http_log
WHERE logtime >= TIMESTAMP '{RANGE_START}' AND logtime < TIMESTAMP '{RANGE_END}'"""))
def q_time_range(spark, sf):
    return C.time_range(http_log(spark, sf), RANGE_START, RANGE_END).select("event_id", "logtime", "hash")


@register("by_label", with_log("SELECT event_id, src_ip, hash FROM http_log WHERE hash = 'SQL_INJECTION'"))
def q_by_label(spark, sf):
    return C.by_label(http_log(spark, sf), "SQL_INJECTION").select("event_id", "src_ip", "hash")


# Planted labels for the predict filter: nourl, anomaly_2 and null.
def _planted_hash(df):
    e = F.col("event_id") % 11
    return df.withColumn("hash", F.when(e == 0, F.lit("x_nourl_y")).when(e == 1, F.lit("anomaly_2"))
                         .when(e == 2, F.lit(None).cast("string")).otherwise(F.col("hash")))


_PLANTED_SQL = """, planted AS (
  SELECT * REPLACE (CASE event_id % 11 WHEN 0 THEN 'x_nourl_y' WHEN 1 THEN 'anomaly_2'
    WHEN 2 THEN NULL ELSE hash END AS hash) FROM http_log)"""


@register("predict_filter", with_log(_PLANTED_SQL + """
SELECT event_id, hash FROM planted WHERE hash NOT LIKE '%nourl%' AND hash != 'anomaly_2'"""))
def q_predict_filter(spark, sf):
    return C.predict_filter(_planted_hash(http_log(spark, sf))).select("event_id", "hash")


@register("clean_text", with_log(f"""
SELECT event_id, {clean_sql('http_query')} AS query, {clean_sql('http_agent')} AS agent FROM http_log"""))
def q_clean_text(spark, sf):
    return http_log(spark, sf).select("event_id", T.clean_text("http_query").alias("query"),
                                      T.clean_text("http_agent").alias("agent"))


@register("url_decode_lenient", with_log("SELECT event_id, url_decode(http_query) AS decoded FROM http_log"))
def q_url_decode(spark, sf):
    return http_log(spark, sf).select("event_id", T.url_decode_lenient("http_query").alias("decoded"))


@register("mark_traversal", with_log(
    "SELECT event_id, replace(http_query, '/..', ' pathsearcherdetected ') AS marked FROM http_log"))
def q_mark_traversal(spark, sf):
    return http_log(spark, sf).select("event_id", T.mark_traversal("http_query").alias("marked"))


@register("strip_symbols", with_log(
    "SELECT event_id, regexp_replace(http_query, '[\\-%./!@#$?,;:&*)(+=0-9_]', ' ', 'g') AS stripped FROM http_log"))
def q_strip_symbols(spark, sf):
    return http_log(spark, sf).select("event_id", T.strip_symbols("http_query").alias("stripped"))


def _bucket_sql(expr: str) -> str:
    return f"SELECT {expr} AS bucket, count(*) AS n FROM events GROUP BY 1"


def _bucket_query(interval):
    def fn(spark, sf):
        from wtprof.sources.tables import load_table
        ev = load_table(spark, sf, "events")
        return ev.groupBy(time_bucket("ts", interval).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return fn


for _name, _iv, _sql in [
    ("time_bucket_minute", "1 minute", "date_trunc('minute', ts)"),
    ("time_bucket_5min", "5 minutes", "time_bucket(INTERVAL 5 MINUTE, ts)"),
    ("time_bucket_6hour", "6 hours", "time_bucket(INTERVAL 6 HOUR, ts)"),
    ("time_bucket_day", "1 day", "date_trunc('day', ts)"),
    ("time_bucket_week", "1 week", "date_trunc('week', ts)"),
    ("time_bucket_month", "1 month", "date_trunc('month', ts)"),
]:
    register(_name, _bucket_sql(_sql))(_bucket_query(_iv))

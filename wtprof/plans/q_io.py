"""Checked queries: scans, profiles, configs, sinks, versions, DDL, job windows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wtprof.functions.timeutil import version_of
from wtprof.operators import vectorize as V
from wtprof.operators.schedule import rows_in_windows, run_windows
from wtprof.plans.registry import register, with_log
from wtprof.session import scratch_path
from wtprof.sources import ddl as B
from wtprof.sources import io as A
from wtprof.sources.tables import http_log, load_table

S0, E0 = "2024-01-05 00:00:00", "2024-01-25 00:00:00"


def _fresh(spark, name):
    return scratch_path(spark, f"{name}_{uuid.uuid4().hex[:12]}")


@register("scan_log", f"""
SELECT event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '{S0}' AND ts < TIMESTAMP '{E0}'""")
def q_scan_log(spark, sf):
    return A.scan_log(spark, f"{sf}/events.parquet", ["event_id", "ts", "event_type"], S0, E0, time_col="ts")


_PROFILE = [("logtime", "timestamp_ntz"), ("src_ip", "string"), ("dst_ip", "string"), ("http_host", "string"),
            ("http_agent", "string"), ("http_query", "string"), ("hash", "string"), ("status", "int"),
            ("event_id", "bigint"), ("dst_port", "int"), ("status_code", "int")]


@register("schema_profile", with_log("\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS dtype, count({c}) AS non_null FROM http_log" for c, t in _PROFILE)))
def q_schema_profile(spark, sf):
    return A.schema_profile(http_log(spark, sf))


_MAP_SQL = """SELECT DISTINCT event_type AS note, CASE event_type WHEN 'error' THEN 'injection'
  WHEN 'signup' THEN 'xss' WHEN 'purchase' THEN 'beaconing' WHEN 'view' THEN 'credential'
  ELSE 'normal' END AS mapping FROM events"""


@register("read_mapping_csv", _MAP_SQL)
def q_read_mapping_csv(spark, sf):
    """Write the note → class map derived from events as a header CSV,
    then read it back with an explicit schema."""
    from wtprof.plans.q_relational import _type_key
    path = _fresh(spark, "notice_mapping")
    ev = load_table(spark, sf, "events")
    ev.select(F.col("event_type").alias("note"), _type_key(F.col("event_type")).alias("mapping")).distinct() \
        .withColumn("mapping", F.when(F.col("mapping") == "unknown_key", "normal").otherwise(F.col("mapping"))) \
        .coalesce(1).write.option("header", True).csv(path)
    return A.read_mapping_csv(spark, path)


_META_SQL = """meta AS (
  SELECT 300 + dense_rank() OVER (ORDER BY event_type) AS model_id, event_type AS model_name, n, mx
  FROM (SELECT event_type, count(*) AS n, max(user_id) AS mx FROM events GROUP BY event_type))"""


def _meta(spark, sf):
    from pyspark.sql import Window
    ev = load_table(spark, sf, "events")
    g = ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("user_id").alias("mx"))
    g = g.withColumn("model_id", (300 + F.dense_rank().over(Window.orderBy("event_type"))).cast("int"))
    cfg = F.to_json(F.struct(
        F.struct(F.col("model_id"), F.col("event_type").alias("config_name"), F.col("n").alias("limit"),
                 F.lit("logtime, src_ip, dst_ip").alias("index_cols")).alias("common"),
        F.struct((F.col("mx") % 7 + 3).alias("max_depth"), F.lit("hours=1").alias("now_delta"),
                 F.concat(F.lit("days="), (F.col("mx") % 5 + 1).cast("string")).alias("prev_delta")).alias("train"),
        F.struct(F.lit(0.5).alias("prob_threshold"), F.lit("minutes=10").alias("now_delta"),
                 F.lit("bogus").alias("prev_delta")).alias("predict")))
    return g.select("model_id", F.col("event_type").alias("model_name"), cfg.alias("config"))


@register("load_model_config", f"""WITH {_META_SQL}
SELECT model_id, CAST(mx % 7 + 3 AS INTEGER) AS max_depth, 'hours=1' AS now_delta,
  'days=' || CAST(mx % 5 + 1 AS VARCHAR) AS prev_delta, model_name AS config_name, n AS "limit",
  3600 AS now_delta_seconds, (mx % 5 + 1) * 86400 AS prev_delta_seconds FROM meta""")
def q_load_model_config(spark, sf):
    cfg = A.load_model_config(_meta(spark, sf), "TRAIN", "max_depth int, now_delta string, prev_delta string",
                              "model_id int, config_name string, limit bigint, index_cols string")
    return cfg.select("model_id", "max_depth", "now_delta", "prev_delta", F.col("common.config_name").alias(
        "config_name"), F.col("common.limit").alias("limit"), "now_delta_seconds", "prev_delta_seconds")


@register("model_exists", f"""WITH {_META_SQL}
SELECT r.model_id, meta.model_name FROM (SELECT DISTINCT CAST(300 + user_id % 10 AS INTEGER) AS model_id FROM events) r
LEFT JOIN meta USING (model_id)""")
def q_model_exists(spark, sf):
    req = load_table(spark, sf, "events").select((300 + F.col("user_id") % 10).cast("int").alias("model_id")).distinct()
    return A.model_exists(_meta(spark, sf), req)


_LC_SQL = "SELECT hash, count(*) AS cnt FROM http_log GROUP BY hash"


@register("append_results", with_log(f"""
SELECT hash, cnt, 'batch1' AS batch FROM ({_LC_SQL}) UNION ALL SELECT hash, cnt, 'batch2' FROM ({_LC_SQL})"""))
def q_append_results(spark, sf):
    from wtprof.operators.aggregates import label_counts
    path = _fresh(spark, "results")
    lc = label_counts(http_log(spark, sf), "hash")
    for b in ("batch1", "batch2"):
        A.append_results(lc.withColumn("batch", F.lit(b)), path)
    return spark.read.parquet(path)


@register("append_batched", with_log("SELECT event_id, hash, src_ip FROM http_log"))
def q_append_batched(spark, sf):
    path = _fresh(spark, "prep")
    A.append_batched(http_log(spark, sf).select("event_id", "hash", "src_ip"), path, max_records=1000)
    return spark.read.parquet(path)


@register("snapshot", with_log("SELECT event_id, logtime, hash FROM http_log"))
def q_snapshot(spark, sf):
    return A.snapshot(http_log(spark, sf).select("event_id", "logtime", "hash"), _fresh(spark, "snap"), "2024_01_31")


@register("save_fit", """
WITH docs AS (SELECT doc_id, list_filter(regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]{2,}'),
    lambda w: NOT list_contains(['bbs', 'write', 'modify', 'board', 'delete', 'id', 'contents', 'writer', 'page'], w)) AS g
  FROM documents),
t AS (SELECT doc_id, unnest(g) AS term FROM docs),
tc AS (SELECT doc_id, term, count(*) AS cnt FROM t GROUP BY ALL),
pt AS (SELECT term, sum(cnt) AS tf, count(*) AS df FROM tc GROUP BY term),
top AS (SELECT * FROM pt QUALIFY row_number() OVER (ORDER BY tf DESC, term) <= 256)
SELECT 'text' AS feature, term, row_number() OVER (ORDER BY term) - 1 AS idx, df,
  round(ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1, 6) AS idf FROM top""")
def q_save_fit(spark, sf):
    """Two vocabulary versions saved; the newer one loaded back."""
    d = load_table(spark, sf, "documents", balance=True)
    base = _fresh(spark, "fits")
    A.save_fit(V.tfidf_fit(d, ["doc_id"], ["text"], 2000), base, "tfidf_text", "2024_01_30")
    A.save_fit(V.tfidf_fit(d, ["doc_id"], ["text"], 256), base, "tfidf_text", "2024_01_31")
    v = A.load_fit(spark, base, "tfidf_text", "2024_01_31")
    return v.withColumn("idf", F.round("idf", 6))


@register("replace_artifact", with_log(f"""
SELECT hash, cnt + 1 AS cnt, '2024_01_30' AS version FROM ({_LC_SQL})
UNION ALL SELECT hash, cnt, '2024_01_31' FROM ({_LC_SQL})"""))
def q_replace_artifact(spark, sf):
    from wtprof.operators.aggregates import label_counts
    base = _fresh(spark, "artifacts")
    lc = label_counts(http_log(spark, sf), "hash")
    A.save_fit(lc, base, "labels", "2024_01_30")
    A.save_fit(lc, base, "labels", "2024_01_31")
    A.replace_artifact(lc.withColumn("cnt", F.col("cnt") + 1), base, "labels", "2024_01_30")
    return spark.read.parquet(f"{base}/labels")


_VERS_SQL = "vers AS (SELECT DISTINCT strftime(ts, '%Y_%m_%d') AS version FROM events WHERE event_type = 'error' AND hour(ts) = 3)"


def _versions(spark, sf):
    ev = load_table(spark, sf, "events")
    return ev.where((F.col("event_type") == "error") & (F.hour("ts") == 3)).select(
        version_of("ts").alias("version")).distinct()


@register("latest_version", f"WITH {_VERS_SQL} SELECT max(version) AS version FROM vers WHERE version <= '2024_01_20'")
def q_latest_version(spark, sf):
    return A.latest_version(_versions(spark, sf), "2024_01_20")


@register("latest_version_per_row", f"""WITH {_VERS_SQL}
SELECT e.event_id, (SELECT max(version) FROM vers v WHERE v.version <= strftime(e.ts, '%Y_%m_%d')) AS model_version
FROM events e""")
def q_latest_version_per_row(spark, sf):
    ev = load_table(spark, sf, "events").select("event_id", "ts")
    return A.latest_version_per_row(ev, _versions(spark, sf), "ts").select("event_id", "model_version")


@register("run_sql", with_log(f"""
SELECT hash, count(*) AS n FROM http_log WHERE logtime >= TIMESTAMP '{S0}' AND logtime < TIMESTAMP '{E0}'
GROUP BY hash"""))
def q_run_sql(spark, sf):
    text = ("SELECT hash, count(*) AS n FROM wtprof_http_log "
            "WHERE logtime >= to_timestamp_ntz(:s) AND logtime < to_timestamp_ntz(:e) GROUP BY hash")
    return A.run_sql(spark, text, {"s": S0, "e": E0}, views={"wtprof_http_log": http_log(spark, sf)})


@register("create_table", with_log("""
SELECT date_trunc('hour', logtime) AS lgtime, src_ip, dst_ip, hash AS label, count(*) AS n
FROM http_log GROUP BY ALL"""))
def q_create_table(spark, sf):
    from wtprof.functions.timeutil import time_bucket
    d = http_log(spark, sf).groupBy(time_bucket("logtime", "1 hour").alias("lgtime"), "src_ip", "dst_ip",
                                     F.col("hash").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    name = f"wtprof_sessions_{uuid.uuid4().hex[:8]}"
    t = B.create_table(spark, d, name, _fresh(spark, name), partition_by=["label"], order_by=["lgtime"])
    return t.select("lgtime", "src_ip", "dst_ip", "label", "n")


@register("evolve_table", with_log("""
SELECT event_id, CAST(NULL AS INTEGER) AS status, CAST(dst_port AS SMALLINT) AS dst_port, hash AS label,
  CAST(NULL AS VARCHAR) AS note FROM http_log"""))
def q_evolve_table(spark, sf):
    d = http_log(spark, sf).select("event_id", "status", "dst_port", "hash", "src_ip")
    d = B.evolve_table(d, "ADD", "note", "String")
    d = B.evolve_table(d, "DROP", "src_ip")
    d = B.evolve_table(d, "RENAME", "hash", "label")
    d = B.evolve_table(d, "CLEAR", "status")
    d = B.evolve_table(d, "MODIFY", "dst_port", "UInt8")
    d = B.evolve_table(d, "COMMENT", "label", "class of the request")
    return d


@register("alter_table", with_log("""
SELECT event_id, CAST(NULL AS INTEGER) AS status, CAST(dst_port AS SMALLINT) AS dst_port, hash AS label,
  CAST(NULL AS VARCHAR) AS note FROM http_log"""))
def q_alter_table(spark, sf):
    """B4 on a table: ALTER for ADD and COMMENT, rewrite and swap for the rest."""
    name = f"log_{uuid.uuid4().hex[:12]}"
    http_log(spark, sf).select("event_id", "status", "dst_port", "hash", "src_ip").write.format("parquet").saveAsTable(name)
    B.alter_table(spark, name, "ADD", "note", "String")
    B.alter_table(spark, name, "DROP", "src_ip")
    B.alter_table(spark, name, "RENAME", "hash", "label")
    B.alter_table(spark, name, "CLEAR", "status")
    B.alter_table(spark, name, "MODIFY", "dst_port", "UInt8")
    return B.alter_table(spark, name, "COMMENT", "label", "class of the request")


_DECL = [("event_id", "UInt32"), ("dst_port", "Int8"), ("status_code", "Nullable(UInt8)"),
         ("src_ip", "IPv4"), ("http_host", "LowCardinality(String)")]


@register("conform_schema", with_log("""
SELECT CAST(event_id AS BIGINT) AS event_id, TRY_CAST(dst_port AS TINYINT) AS dst_port,
  CAST(status_code AS SMALLINT) AS status_code, src_ip, http_host,
  array_to_string(list_filter([CASE WHEN TRY_CAST(dst_port AS TINYINT) IS NULL THEN 'dst_port' END],
    lambda x: x IS NOT NULL), ',') AS bad_columns FROM http_log"""))
def q_conform_schema(spark, sf):
    d = B.conform_schema(http_log(spark, sf), _DECL)
    return d.withColumn("bad_columns", F.array_join("bad_columns", ","))


JOBS = [(1, "*/5 * * * *", "hours=1", "days=2", "2024-01-10 12:00:00"),
        (2, "0 */1 * * *", "minutes=30", "weeks=1", "2024-01-20 00:00:00"),
        (3, "bad", "nonsense", "days=3", "2024-01-28 06:00:00")]


@register("run_windows", with_log(", cfg(job_id, crontab, now_delta, prev_delta, run_time) AS (VALUES " + ", ".join(
    f"({j}, '{c}', '{n}', '{p}', TIMESTAMP '{r}')" for j, c, n, p, r in JOBS) + """),
w AS (SELECT job_id, crontab,
  run_time - to_seconds(CASE now_delta WHEN 'hours=1' THEN 3600 WHEN 'minutes=30' THEN 1800 ELSE 86400 END) AS logtime_e,
  CASE prev_delta WHEN 'days=2' THEN 172800 WHEN 'weeks=1' THEN 604800 WHEN 'days=3' THEN 259200 END AS prev_s FROM cfg),
w2 AS (SELECT job_id, crontab, logtime_e - to_seconds(prev_s) AS logtime_s, logtime_e FROM w)
SELECT job_id, logtime_s, logtime_e, strftime(logtime_s, '%Y-%m-%d') AS logdate_s,
  strftime(logtime_e, '%Y-%m-%d') AS logdate_e, strftime(logtime_e - INTERVAL 56 DAY, '%Y-%m-%d') AS logdate_m,
  strftime(logtime_e - INTERVAL 1 DAY, '%Y-%m-%d') AS logdate_day,
  CASE crontab WHEN '*/5 * * * *' THEN '5 minutes' WHEN '0 */1 * * *' THEN 'hour' ELSE 'hour' END AS unit,
  (SELECT count(*) FROM http_log l WHERE l.logtime >= w2.logtime_s AND l.logtime < w2.logtime_e) AS n_rows
FROM w2"""))
def q_run_windows(spark, sf):
    cfg = spark.createDataFrame([(j, c, n, p, r) for j, c, n, p, r in JOBS],
                                "job_id int, crontab string, now_delta string, prev_delta string, run_time string")
    cfg = cfg.withColumn("run_time", F.to_timestamp_ntz("run_time"))
    w = run_windows(cfg)
    n = rows_in_windows(http_log(spark, sf), w).groupBy("job_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return w.join(n, "job_id", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))

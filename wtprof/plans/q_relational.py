"""Checked queries: aggregations, limits, set ops, joins, windows, scalar
functions and predicates over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wtprof.functions import arrays as A
from wtprof.functions import timeutil as TU
from wtprof.functions.nulls import cast_roles, fill_nulls
from wtprof.functions.text import remove_punctuation
from wtprof.operators import aggregates as AG
from wtprof.operators import filters as C
from wtprof.operators import joins as G
from wtprof.operators import setops as S
from wtprof.operators import topk as E
from wtprof.operators import windows as H
from wtprof.operators.roles import infer_roles
from wtprof.plans.registry import register, with_log
from wtprof.sources.tables import http_log, load_table

DC_COLS = ["src_ip", "dst_ip", "http_host", "http_agent", "hash", "status"]


@register("distinct_counts", with_log("\n".join(
    [("UNION ALL " if i else "") + f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS nunique FROM http_log"
     for i, c in enumerate(DC_COLS)])))
def q_distinct_counts(spark, sf):
    return AG.distinct_counts(http_log(spark, sf), DC_COLS)


@register("label_counts", with_log("SELECT hash, count(*) AS cnt FROM http_log GROUP BY hash"))
def q_label_counts(spark, sf):
    return AG.label_counts(http_log(spark, sf), "hash")


@register("max_class_count", with_log(
    "SELECT max(cnt) AS max_cnt FROM (SELECT count(*) AS cnt FROM http_log GROUP BY hash)"))
def q_max_class_count(spark, sf):
    return AG.max_class_count(http_log(spark, sf), "hash")


_ROLE_COLS = [("logtime", "timestamp_ntz", "none"), ("src_ip", "string", "string"),
              ("dst_ip", "string", "string"), ("http_host", "string", "string"),
              ("http_agent", "string", "string"), ("http_query", "string", "string"),
              ("hash", "string", "string"), ("status", "int", "number"), ("event_id", "bigint", "number"),
              ("dst_port", "int", "number"), ("status_code", "int", "number")]
_ROLES_SQL = with_log(", nu AS (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS dtype, count(DISTINCT {c}) AS nunique, '{k}' AS kind FROM http_log"
    for c, t, k in _ROLE_COLS) + """)
SELECT column_name, dtype, nunique,
  CASE WHEN column_name IN ('logtime', 'src_ip', 'dst_ip') THEN 'index'
       WHEN column_name = 'hash' THEN 'label'
       WHEN nunique BETWEEN 2 AND 10 THEN 'category' ELSE kind END AS role
FROM nu""")


@register("roles", _ROLES_SQL)
def q_roles(spark, sf):
    return infer_roles(http_log(spark, sf), index_cols=["logtime", "src_ip", "dst_ip"], label_col="hash")


@register("infer_categories", f"SELECT column_name, nunique FROM ({_ROLES_SQL}) WHERE role = 'category'")
def q_infer_categories(spark, sf):
    r = infer_roles(http_log(spark, sf), index_cols=["logtime", "src_ip", "dst_ip"], label_col="hash")
    return r.where(F.col("role") == "category").select("column_name", "nunique")


@register("limit_n", with_log("SELECT event_id, hash FROM http_log ORDER BY event_id LIMIT 100"))
def q_limit_n(spark, sf):
    return E.limit_n(http_log(spark, sf), 100, ["event_id"], order="key").select("event_id", "hash")


_NORMAL_FROM, _ATTACK_FROM, _UNTIL = "2024-01-10 00:00:00", "2024-01-20 00:00:00", "2024-01-31 00:00:00"


@register("limit_per_class", with_log(f"""
SELECT event_id, hash, logtime FROM http_log
WHERE (hash = 'normal' AND logtime >= TIMESTAMP '{_NORMAL_FROM}' AND logtime < TIMESTAMP '{_UNTIL}')
   OR (hash <> 'normal' AND logtime >= TIMESTAMP '{_ATTACK_FROM}' AND logtime < TIMESTAMP '{_UNTIL}')
QUALIFY row_number() OVER (PARTITION BY hash ORDER BY logtime, event_id) <= 50"""))
def q_limit_per_class(spark, sf):
    out = E.limit_per_class(http_log(spark, sf), 50, "hash", ["logtime", "event_id"],
                            class_ranges={"normal": (_NORMAL_FROM, _UNTIL)},
                            default_range=(_ATTACK_FROM, _UNTIL))
    return out.select("event_id", "hash", "logtime")


@register("limit_by_threshold", with_log("""
SELECT event_id, hash, logtime FROM http_log
QUALIFY row_number() OVER (PARTITION BY hash ORDER BY logtime, event_id) <= 700"""))
def q_limit_by_threshold(spark, sf):
    """E2 by a histogram of the order key: a timestamp."""
    return E.limit_by_threshold(http_log(spark, sf).select("event_id", "hash", "logtime"), 700, "hash", ["logtime", "event_id"])


@register("limit_by_threshold_ties", """
SELECT event_type, event_id, value FROM (SELECT *, row_number() OVER (
  PARTITION BY event_type ORDER BY floor(value), event_id) AS r FROM events) WHERE r <= 300""")
def q_limit_by_threshold_ties(spark, sf):
    """E2 by a histogram where many rows share the order key."""
    ev = load_table(spark, sf, "events").select("event_type", "event_id", "value", F.floor("value").alias("whole"))
    return E.limit_by_threshold(ev, 300, "event_type", ["whole", "event_id"]).drop("whole")


@register("sort_rows", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey")
def q_sort_rows(spark, sf):
    return E.sort_rows(load_table(spark, sf, "orders").select("o_orderkey", "o_orderdate"),
                       ["o_orderdate", "o_orderkey"])


_ATTACKS = ("BEACONING", "CREDENTIAL", "SQL_INJECTION", "XSS")


_UNION_SQL = with_log("""
SELECT lgtime, src_ip, dst_ip, label, coalesce(n_req, 0) AS n_req, coalesce(n_ports, 0) AS n_ports FROM (
  SELECT date_trunc('hour', logtime) AS lgtime, src_ip, dst_ip, 'normal' AS label, count(*) AS n_req,
         NULL AS n_ports FROM http_log WHERE hash = 'normal' GROUP BY 1, 2, 3""" + "".join(f"""
  UNION ALL
  SELECT date_trunc('hour', logtime), src_ip, dst_ip, '{a}', NULL, count(DISTINCT dst_port)
  FROM http_log WHERE hash = '{a}' GROUP BY 1, 2, 3""" for a in _ATTACKS) + ")")


@register("union_classes", _UNION_SQL)
def q_union_classes(spark, sf):
    """normal and all four attacks, each with its own columns, stacked."""
    log = http_log(spark, sf)
    b = TU.time_bucket("logtime", "1 hour").alias("lgtime")
    parts = [C.by_label(log, "normal").groupBy(b, "src_ip", "dst_ip")
             .agg(F.count(F.lit(1)).alias("n_req")).withColumn("label", F.lit("normal"))]
    parts += [C.by_label(log, a).groupBy(b, "src_ip", "dst_ip")
              .agg(F.count_distinct("dst_port").alias("n_ports")).withColumn("label", F.lit(a)) for a in _ATTACKS]
    return S.union_classes(parts)


@register("aggregate_classes", _UNION_SQL)
def q_aggregate_classes(spark, sf):
    """F1 in one scan of the log."""
    b = TU.time_bucket("logtime", "1 hour").alias("lgtime")
    return S.aggregate_classes(http_log(spark, sf), [b, "src_ip", "dst_ip"], "hash", {
        "n_req": (["normal"], lambda only: F.count(only(F.lit(1)))),
        "n_ports": (_ATTACKS, lambda only: F.count_distinct(only(F.col("dst_port"))))})


@register("dedupe_results", with_log("SELECT DISTINCT src_ip, dst_ip, hash FROM http_log"))
def q_dedupe(spark, sf):
    return S.dedupe_results(http_log(spark, sf).select("src_ip", "dst_ip", "hash"))


@register("distinct_labels", with_log("SELECT DISTINCT hash AS label FROM http_log WHERE hash IS NOT NULL"))
def q_distinct_labels(spark, sf):
    return S.distinct_labels(http_log(spark, sf).withColumnRenamed("hash", "label"))


@register("join_features", with_log("""
, st AS (SELECT date_trunc('hour', logtime) AS lgtime, src_ip, dst_ip, count(DISTINCT dst_port) AS dst_port_cnt
         FROM http_log GROUP BY 1, 2, 3),
  lab AS (SELECT date_trunc('hour', logtime) AS lgtime, src_ip, dst_ip, hash AS label, count(*) AS n_req
          FROM http_log GROUP BY 1, 2, 3, 4)
SELECT lab.*, st.dst_port_cnt FROM lab JOIN st USING (lgtime, src_ip, dst_ip)"""))
def q_join_features(spark, sf):
    log = http_log(spark, sf)
    b = TU.time_bucket("logtime", "1 hour").alias("lgtime")
    st = log.groupBy(b, "src_ip", "dst_ip").agg(F.count_distinct("dst_port").alias("dst_port_cnt"))
    lab = log.groupBy(b, "src_ip", "dst_ip", F.col("hash").alias("label")).agg(F.count(F.lit(1)).alias("n_req"))
    return G.join_features(lab, st, ["lgtime", "src_ip", "dst_ip"])


@register("attach_keys", with_log("""
SELECT e.event_id, e.event_type AS pred, l.logtime, l.src_ip, l.dst_ip
FROM events e JOIN http_log l USING (event_id)"""))
def q_attach_keys(spark, sf):
    preds = load_table(spark, sf, "events").select("event_id", F.col("event_type").alias("pred"))
    return G.attach_keys(preds, http_log(spark, sf), "event_id")


def _heap_nodes(spark, sf):
    ev = load_table(spark, sf, "events")
    n = ev.select(F.count(F.lit(1))).scalar()
    i = F.col("event_id")
    return ev.select(i.alias("node_num"),
                     F.when(2 * i + 1 < n, 2 * i + 1).otherwise(-1).alias("node_to_left"),
                     F.when(2 * i + 2 < n, 2 * i + 2).otherwise(-1).alias("node_to_right"))


@register("tree_parent", """
WITH nodes AS (
  SELECT event_id AS node_num,
    CASE WHEN 2 * event_id + 1 < (SELECT count(*) FROM events) THEN 2 * event_id + 1 ELSE -1 END AS node_to_left,
    CASE WHEN 2 * event_id + 2 < (SELECT count(*) FROM events) THEN 2 * event_id + 2 ELSE -1 END AS node_to_right
  FROM events),
edges AS (SELECT node_num AS parent, unnest([node_to_left, node_to_right]) AS child FROM nodes)
SELECT n.node_num, n.node_to_left, n.node_to_right, e.parent AS node_from
FROM nodes n LEFT JOIN edges e ON e.child = n.node_num AND e.child >= 0""")
def q_tree_parent(spark, sf):
    return G.tree_parent(_heap_nodes(spark, sf))


@register("class_rows_join", with_log("""
, sc AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN hash ELSE 'XSS' END AS class,
                (event_id % 100) / 100.0 AS score FROM http_log WHERE hash <> 'normal')
SELECT l.event_id, l.hash AS pred, coalesce(sc.score, 0.0) AS score
FROM http_log l LEFT JOIN sc ON sc.event_id = l.event_id AND sc.class = l.hash""").replace(
    # the page a row shows is a column first: an equi-join, not a cross product
    "FROM events e JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)",
    "FROM (SELECT *, event_id % (SELECT count(*) FROM pages) AS _page FROM events) e JOIN pages p ON p.page_id = e._page"))
def q_class_rows_join(spark, sf):
    log = http_log(spark, sf)
    full = log.select("event_id", F.col("hash").alias("pred"))
    sc = (log.where(F.col("hash") != "normal")
          .select("event_id", F.when(F.col("event_id") % 2 == 0, F.col("hash")).otherwise(F.lit("XSS")).alias("class"),
                  ((F.col("event_id") % 100) / 100.0).alias("score")))
    return G.class_rows_join(full, sc, ["event_id"], pred_col="pred")


_KEY_OF_TYPE = {"error": "injection", "signup": "xss", "purchase": "beaconing", "view": "credential",
                "click": "normal"}


def _type_key(c):
    e = None
    for k, v in _KEY_OF_TYPE.items():
        e = F.when(c == k, F.lit(v)) if e is None else e.when(c == k, F.lit(v))
    return e.otherwise(F.lit("unknown_key"))


@register("lookup_class_code", """
WITH k AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'injection' WHEN 'signup' THEN 'xss'
  WHEN 'purchase' THEN 'beaconing' WHEN 'view' THEN 'credential' WHEN 'click' THEN 'normal'
  ELSE 'unknown_key' END AS class_key FROM events),
n AS (SELECT event_id, class_key, CASE class_key WHEN 'scanning' THEN 'HTTP_SCANNING'
  WHEN 'injection' THEN 'SQL_INJECTION' WHEN 'xss' THEN 'XSS' WHEN 'beaconing' THEN 'BEACONING'
  WHEN 'credential' THEN 'CREDENTIAL' WHEN 'normal' THEN 'NORMAL' WHEN 'anomaly' THEN 'ANOMALY' END AS att_name
  FROM k)
SELECT event_id, class_key, att_name, 250000 + CASE att_name WHEN 'NORMAL' THEN 0 WHEN 'SQL_INJECTION' THEN 1
  WHEN 'XSS' THEN 2 WHEN 'BEACONING' THEN 3 WHEN 'CREDENTIAL' THEN 4 WHEN 'HTTP_SCANNING' THEN 5
  WHEN 'ANOMALY' THEN 9 END AS result FROM n""")
def q_lookup_class_code(spark, sf):
    ev = load_table(spark, sf, "events").select("event_id", _type_key(F.col("event_type")).alias("class_key"))
    return G.lookup_class_code(ev, "class_key")


@register("row_numbering", with_log("""
SELECT event_id, hash, row_number() OVER (PARTITION BY hash ORDER BY logtime, event_id) AS row_id FROM http_log"""))
def q_row_numbering(spark, sf):
    return H.row_numbering(http_log(spark, sf).select("event_id", "hash", "logtime"), ["hash"],
                           ["logtime", "event_id"]).drop("logtime")


@register("epoch_number", """
SELECT event_type, day, round(avg_value, 6) AS loss,
  row_number() OVER (PARTITION BY event_type ORDER BY day) AS epochs
FROM (SELECT event_type, date_trunc('day', ts) AS day, avg(value) AS avg_value FROM events GROUP BY 1, 2)""")
def q_epoch_number(spark, sf):
    ev = load_table(spark, sf, "events")
    per = ev.groupBy("event_type", TU.time_bucket("ts", "1 day").alias("day")).agg(
        F.round(F.avg("value"), 6).alias("loss"))
    return H.epoch_number(per, ["event_type"], ["day"])


_EMB_LONG_SQL = """emb AS (
  SELECT vec_id, unnest(generate_series(0, len(embedding) - 1)) AS pos,
         CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings)"""


def _emb_long(spark, sf):
    emb = load_table(spark, sf, "embeddings")
    return emb.select("vec_id", F.posexplode_outer(F.col("embedding").cast("array<double>")).alias("pos", "value"))


@register("center_by_median", f"""WITH {_EMB_LONG_SQL}
SELECT vec_id, pos, round(value - median(value) OVER (PARTITION BY vec_id), 6) AS centered FROM emb""")
def q_center_by_median(spark, sf):
    out = H.center_by_median(_emb_long(spark, sf), ["vec_id"])
    return out.select("vec_id", "pos", F.round("centered", 6).alias("centered"))


@register("l2_norm", f"""WITH {_EMB_LONG_SQL}
SELECT vec_id, pos, round(CASE WHEN n > 0 THEN value / n ELSE 0 END, 6) AS value FROM (
  SELECT vec_id, pos, value, sqrt(sum(value * value) OVER (PARTITION BY vec_id)) AS n FROM emb)""")
def q_l2_norm(spark, sf):
    out = H.l2_norm(_emb_long(spark, sf), ["vec_id"])
    return out.select("vec_id", "pos", F.round("value", 6).alias("value"))


@register("vector_stats", f"""WITH {_EMB_LONG_SQL}
SELECT vec_id, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std,
       round(median(value), 6) AS median FROM emb GROUP BY vec_id""")
def q_vector_stats(spark, sf):
    emb = load_table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    out = AG.vector_stats(emb, ["vec_id"], "v")
    return out.select("vec_id", *[F.round(c, 6).alias(c) for c in ("mean", "std", "median")])


@register("boxplot_threshold", """
SELECT round(q3 + 1.5 * (q3 - q1), 6) AS threshold FROM (
  SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)""")
def q_boxplot(spark, sf):
    out = AG.boxplot_threshold(load_table(spark, sf, "events"), "value", "box")
    return out.select(F.round("threshold", 6).alias("threshold"))


@register("boxplot_threshold_mad", """
SELECT round(med + 1.5 * mad, 6) AS threshold FROM (
  SELECT median(value) AS med, median(abs(value - (SELECT median(value) FROM events))) AS mad FROM events)""")
def q_boxplot_mad(spark, sf):
    out = AG.boxplot_threshold(load_table(spark, sf, "events"), "value", "mad")
    return out.select(F.round("threshold", 6).alias("threshold"))


_SCORES_SQL = "sc AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) + 0.5) AS s FROM embeddings)"


def _scores(spark, sf):
    emb = load_table(spark, sf, "embeddings")
    return emb.select("vec_id", F.transform(F.col("embedding").cast("array<double>"), lambda x: x + 0.5).alias("s"))


@register("array_argmax", f"""WITH {_SCORES_SQL}
SELECT vec_id, coalesce(list_position(list_transform(s, lambda x: x > 0.5), true), 0) - 1 AS first_above,
  len(list_filter(s, lambda x: x > 0.5)) > 0 AS any_above, list_position(s, list_max(s)) - 1 AS argmax FROM sc""")
def q_array_argmax(spark, sf):
    s = _scores(spark, sf)
    return s.select("vec_id", A.array_first_above("s").alias("first_above"),
                    A.array_any_above("s").alias("any_above"), A.array_argmax("s").alias("argmax"))


@register("array_rescale", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS a FROM embeddings),
st AS (SELECT vec_id, a, list_max(a) AS m, list_avg(a) AS mu,
  sqrt(list_sum(list_transform(a, lambda x: (x - list_avg(a)) * (x - list_avg(a)))) / len(a)) + 1e-7 AS sd FROM v),
l AS (SELECT vec_id, m, mu, sd, unnest(generate_series(0, len(a) - 1)) AS pos, unnest(a) AS x FROM st)
SELECT vec_id, pos, round(CASE WHEN m > 0 THEN greatest(x, 0) / m ELSE 0 END, 6) AS relu,
  CAST(floor(least(greatest((x - mu) / sd * 0.25 + 0.5, 0), 1) * 255) AS INTEGER) AS byte FROM l""")
def q_array_rescale(spark, sf):
    emb = load_table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("a"))
    r = emb.select("vec_id", F.arrays_zip(A.relu_rescale("a").alias("relu"), A.zscore_to_byte("a").alias("byte"))
                   .alias("z"))
    # _outer: no inferred non-empty filter that would copy the array expression
    out = r.select("vec_id", F.posexplode_outer("z").alias("pos", "z"))
    return out.select("vec_id", "pos", F.round("z.relu", 6).alias("relu"), F.col("z.byte").alias("byte"))


_LI_BLOCK = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _li_long(spark, sf):
    li = load_table(spark, sf, "lineitem")
    vals, names = A.values_to_array(_LI_BLOCK)
    z = li.select("l_orderkey", "l_linenumber", F.arrays_zip(names.alias("name"), vals.alias("value")).alias("z"))
    return z.select("l_orderkey", "l_linenumber", F.explode("z").alias("z")).select(
        "l_orderkey", "l_linenumber", F.col("z.name").alias("feature"), F.col("z.value").alias("value"))


_LI_LONG_SQL = "\nUNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM lineitem"
    for c in _LI_BLOCK)


@register("values_to_array", _LI_LONG_SQL)
def q_values_to_array(spark, sf):
    return _li_long(spark, sf)


@register("nonzero_features", f"SELECT * FROM ({_LI_LONG_SQL}) WHERE value <> 0")
def q_nonzero(spark, sf):
    return C.nonzero_features(_li_long(spark, sf))


_CRON_SQL_EXPR = """CASE event_type WHEN 'click' THEN '*/5 * * * *' WHEN 'view' THEN '0 */1 * * *'
  WHEN 'purchase' THEN '0 0 */1 * *' WHEN 'signup' THEN 'bad cron' ELSE '* * * * *' END"""


def _cron_col():
    t = F.col("event_type")
    return (F.when(t == "click", "*/5 * * * *").when(t == "view", "0 */1 * * *")
            .when(t == "purchase", "0 0 */1 * *").when(t == "signup", "bad cron").otherwise("* * * * *"))


_CRON_CASE = """CASE WHEN len(p) <> 5 THEN 'hour' WHEN c = '* * * * *' THEN 'minute'
  WHEN p[1] = '*/1' THEN 'minute' WHEN p[1] = '*/5' THEN '5 minutes' WHEN p[1] = '*/15' THEN '15 minutes'
  WHEN p[2] = '*/1' THEN 'hour' WHEN p[3] = '*/1' THEN 'day' WHEN p[3] = '*/4' THEN 'quarter'
  WHEN p[4] = '*/1' THEN 'month' WHEN p[5] = '*/1' THEN 'year' ELSE 'hour' END"""


@register("cron_bucket", f"""
SELECT event_id, c AS crontab, {_CRON_CASE} AS unit
FROM (SELECT event_id, c, string_split(c, ' ') AS p FROM (SELECT event_id, {_CRON_SQL_EXPR} AS c FROM events))""")
def q_cron_bucket(spark, sf):
    ev = load_table(spark, sf, "events").select("event_id", _cron_col().alias("crontab"))
    return ev.select("event_id", "crontab", TU.cron_bucket("crontab").alias("unit"))


def _delta_col():
    t = F.col("event_type")
    unit = (F.when(t == "click", "minutes").when(t == "view", "hours").when(t == "purchase", "days")
            .when(t == "signup", "weeks").otherwise("fortnights"))
    return F.concat(unit, F.lit(" = "), (F.col("user_id") % 10).cast("string"))


@register("parse_delta", """
SELECT event_id, d AS delta, coalesce(CASE regexp_extract(t, '^([a-z]+)=(-?\\d+)$', 1)
    WHEN 'seconds' THEN 1 WHEN 'minutes' THEN 60 WHEN 'hours' THEN 3600 WHEN 'days' THEN 86400
    WHEN 'weeks' THEN 604800 END * TRY_CAST(regexp_extract(t, '^([a-z]+)=(-?\\d+)$', 2) AS BIGINT), 86400)
  AS seconds
FROM (SELECT event_id, d, regexp_replace(d, '\\s', '', 'g') AS t FROM (
  SELECT event_id, concat(CASE event_type WHEN 'click' THEN 'minutes' WHEN 'view' THEN 'hours'
    WHEN 'purchase' THEN 'days' WHEN 'signup' THEN 'weeks' ELSE 'fortnights' END, ' = ',
    CAST(user_id % 10 AS VARCHAR)) AS d FROM events))""")
def q_parse_delta(spark, sf):
    ev = load_table(spark, sf, "events").select("event_id", _delta_col().alias("delta"))
    return ev.select("event_id", "delta", TU.parse_delta_seconds("delta").alias("seconds"))


@register("version_of", """
SELECT event_id, strftime(ts, '%Y_%m_%d') AS version, isodow(ts) - 1 AS weekday, hour(ts) AS hour FROM events""")
def q_version_of(spark, sf):
    ev = load_table(spark, sf, "events")
    return ev.select("event_id", TU.version_of("ts").alias("version"), TU.weekday("ts").alias("weekday"),
                     F.hour("ts").alias("hour"))


@register("remove_punctuation", "SELECT doc_id, regexp_replace(text, '[!-/:-@\\[-`{-~]', '', 'g') AS text FROM documents")
def q_remove_punctuation(spark, sf):
    d = load_table(spark, sf, "documents")
    return d.select("doc_id", remove_punctuation("text").alias("text"))


@register("fill_nulls", with_log("""
SELECT event_id, coalesce(CAST(status AS VARCHAR), 'empty') AS status, coalesce(status_code, -1) AS status_code,
  coalesce(CASE WHEN event_id % 13 = 0 THEN NULL ELSE http_agent END, '-') AS http_agent FROM http_log"""))
def q_fill_nulls(spark, sf):
    log = http_log(spark, sf).withColumn(
        "http_agent", F.when(F.col("event_id") % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("http_agent")))
    out = fill_nulls(log, number=["status_code"], string=["http_agent"], category=["status"])
    return out.select("event_id", "status", "status_code", "http_agent")


@register("to_naive_timestamp", "SELECT event_id, ts AS naive FROM events")
def q_to_naive(spark, sf):
    ev = load_table(spark, sf, "events")
    return ev.select("event_id", TU.to_naive_timestamp(F.col("ts").cast("timestamp")).alias("naive"))


@register("cast_roles", """
SELECT l_orderkey, l_linenumber, CAST(trunc(l_quantity) AS INTEGER) AS l_quantity,
  CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem""")
def q_cast_roles(spark, sf):
    li = load_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_suppkey", "l_shipdate")
    return cast_roles(li, {"l_quantity": "int", "l_suppkey": "string", "l_shipdate": "date"})


@register("with_label", with_log("SELECT event_id, 'normal' AS label, '2024_01_31' AS version FROM http_log"))
def q_with_label(spark, sf):
    return C.with_label(http_log(spark, sf).select("event_id"), "normal", version="2024_01_31")


@register("project_rename", with_log(
    "SELECT event_id, http_query AS query_, http_agent AS agent_, src_ip FROM http_log"))
def q_project_rename(spark, sf):
    return C.project_rename(http_log(spark, sf), {"http_query": "query_", "http_agent": "agent_"},
                            keep=["event_id", "query_", "agent_", "src_ip"])


@register("class_isin", with_log("SELECT event_id, hash FROM http_log WHERE hash IN ('XSS', 'BEACONING')"))
def q_class_isin(spark, sf):
    return C.class_isin(http_log(spark, sf).select("event_id", "hash"), ["XSS", "BEACONING"], "hash")


@register("class_not_isin", with_log("SELECT event_id, hash FROM http_log WHERE hash NOT IN ('normal')"))
def q_class_not_isin(spark, sf):
    return C.class_isin(http_log(spark, sf).select("event_id", "hash"), ["normal"], "hash", keep=False)


# Keyword exceptions (a small configuration table, like the rule tables).
EXCEPTIONS = [("http_agent", "curl"), ("http_query", "passwd"), ("http_query", "script"),
              ("http_host", "zz-no-such-host")]
_EXC_TARGETS = ["http_agent", "http_query", "http_host", "http_path"]


@register("exclude_keywords", with_log(", exc(selectcolumn, keyword) AS (VALUES " + ", ".join(
    f"('{a}', '{b}')" for a, b in EXCEPTIONS) + """)
, pat AS (SELECT """ + ", ".join(
    f"nullif(coalesce(string_agg(keyword, '|') FILTER (WHERE selectcolumn = '{t}'), ''), '') AS p_{t}"
    for t in _EXC_TARGETS) + """ FROM exc)
SELECT l.event_id, l.http_agent, l.http_query FROM (SELECT *, CAST(NULL AS VARCHAR) AS http_path FROM http_log) l, pat
WHERE """ + " AND ".join(f"NOT coalesce(regexp_matches(l.{t}, pat.p_{t}), false)" for t in _EXC_TARGETS)))
def q_exclude_keywords(spark, sf):
    exc = spark.createDataFrame(EXCEPTIONS, "selectcolumn string, keyword string")
    log = http_log(spark, sf).withColumn("http_path", F.lit(None).cast("string"))
    return C.exclude_keywords(log, exc, _EXC_TARGETS).select("event_id", "http_agent", "http_query")


_WORDS_SQL = """kw AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{4,12}')) AS keyword FROM documents
  WHERE doc_id % 2 = 0 UNION SELECT CAST(doc_id AS VARCHAR) FROM documents WHERE doc_id % 2 = 0 AND doc_id >= 100)"""


@register("exclude_keywords_many", with_log(f"""
, {_WORDS_SQL},
v AS (SELECT DISTINCT http_query FROM http_log),
hit AS (SELECT DISTINCT http_query FROM v JOIN kw ON contains(v.http_query, kw.keyword))
SELECT event_id, http_agent, http_query FROM http_log WHERE http_query NOT IN (SELECT http_query FROM hit)"""))
def q_exclude_keywords_many(spark, sf):
    """C7 with a long keyword list: the words and numbers of the documents of even id."""
    docs = load_table(spark, sf, "documents", balance=True).where("doc_id % 2 = 0")
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{4,12})"), F.lit(1))).alias("keyword"))
    numbers = docs.where("doc_id >= 100").select(F.col("doc_id").cast("string").alias("keyword"))
    exc = words.unionByName(numbers).distinct().select(F.lit("http_query").alias("selectcolumn"), "keyword")
    return C.exclude_keywords_many(http_log(spark, sf), exc, _EXC_TARGETS[:3]).select("event_id", "http_agent", "http_query")


NOTE_MAPPING = [("error", "injection"), ("signup", "xss"), ("purchase", "beaconing"), ("view", "credential"),
                ("view", "scanning"), ("click", "unknown"), ("error", "injection")]


@register("map_to_class", "WITH m(note, mapping) AS (VALUES " + ", ".join(
    f"('{a}', '{b}')" for a, b in NOTE_MAPPING) + """)
SELECT e.event_id, e.event_type, m.mapped_class FROM events e JOIN (
  SELECT DISTINCT note, mapping AS mapped_class FROM m
  WHERE mapping IN ('beaconing', 'injection', 'scanning', 'credential', 'xss')) m ON e.event_type = m.note""")
def q_map_to_class(spark, sf):
    m = spark.createDataFrame(NOTE_MAPPING, "note string, mapping string")
    ev = load_table(spark, sf, "events").select("event_id", "event_type")
    return C.map_to_class(ev, m, "event_type")


@register("rule_latest", """
SELECT role AS rule_name, arg_max(text, conv_id * 1000 + turn) AS rule_body, max(conv_id * 1000 + turn) AS id
FROM conversations GROUP BY role""")
def q_rule_latest(spark, sf):
    cv = load_table(spark, sf, "conversations").select(
        F.col("role").alias("rule_name"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        F.col("text").alias("rule_body"))
    return C.rule_latest(cv)


@register("conditional_overwrite", with_log("""
SELECT event_id, CASE WHEN hash = 'BEACONING' AND dst_port = 443 THEN 'NORMAL' ELSE hash END AS hash FROM http_log"""))
def q_conditional_overwrite(spark, sf):
    log = http_log(spark, sf)
    out = C.conditional_overwrite(log, (F.col("hash") == "BEACONING") & (F.col("dst_port") == 443), "hash", "NORMAL")
    return out.select("event_id", "hash")

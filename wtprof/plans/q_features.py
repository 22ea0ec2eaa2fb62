"""Checked queries: tokens, TF-IDF, bag of words, one-hot, scalers."""

from __future__ import annotations

from pyspark.sql import functions as F

from wtprof.functions.text import STOP_WORDS, ngrams, remove_stop_words, tokenize
from wtprof.operators import encode as EN
from wtprof.operators import scaling as SC
from wtprof.operators import vectorize as V
from wtprof.operators.sessions import session_text_labeled
from wtprof.operators.topk import top_terms
from wtprof.plans.registry import register, with_log, clean_sql
from wtprof.sources.tables import http_log, load_table

_TOK = "regexp_extract_all(lower(coalesce({c}, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}')"
_STOP = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"


def tok_sql(c: str, stop: bool = True) -> str:
    t = _TOK.format(c=c)
    return f"list_filter({t}, lambda w: NOT list_contains({_STOP}, w))" if stop else t


def grams_sql(toks: str, hi: int) -> str:
    """Unigrams then bigrams … up to ``hi``, as in ngrams()."""
    parts = [toks]
    for n in range(2, hi + 1):
        parts.append(f"list_transform(range(1, len({toks}) - {n - 2}), lambda i: array_to_string({toks}[i:i + {n - 1}], ' '))")
    return "list_concat(" + ", ".join(parts) + ")" if len(parts) > 1 else parts[0]


@register("tokenize", f"""
SELECT doc_id, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens FROM (
  SELECT doc_id, {tok_sql('text', stop=False)} AS t FROM documents)""")
def q_tokenize(spark, sf):
    d = load_table(spark, sf, "documents", balance=True).select("doc_id", tokenize("text").alias("t"))
    return d.select("doc_id", F.size("t").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@register("remove_stop_words", f"""
SELECT doc_id, len(t) AS n_kept, array_to_string(t, ' ') AS tokens FROM (
  SELECT doc_id, {tok_sql('text')} AS t FROM documents)""")
def q_remove_stop_words(spark, sf):
    d = load_table(spark, sf, "documents", balance=True).select("doc_id", remove_stop_words(tokenize("text")).alias("t"))
    return d.select("doc_id", F.size("t").alias("n_kept"), F.array_join("t", " ").alias("tokens"))


@register("ngrams", f"""
SELECT conv_id, turn, array_to_string(g, '|') AS grams FROM (
  SELECT conv_id, turn, {grams_sql('t', 3)} AS g FROM (
    SELECT conv_id, turn, {tok_sql('text')} AS t FROM conversations))""")
def q_ngrams(spark, sf):
    c = load_table(spark, sf, "conversations", balance=True)
    g = ngrams(remove_stop_words(tokenize("text")), 1, 3)
    return c.select("conv_id", "turn", F.array_join(g, "|").alias("grams"))


def _tfidf_sql(table: str, key: str, col: str, max_features: int, hi: int, transform: bool) -> str:
    body = f"""
WITH docs AS (SELECT {key}, {grams_sql(tok_sql(col), hi)} AS g FROM {table}),
t AS (SELECT {key}, unnest(g) AS term FROM docs),
tc AS (SELECT {key}, term, count(*) AS cnt FROM t GROUP BY ALL),
pt AS (SELECT term, sum(cnt) AS tf, count(*) AS df FROM tc GROUP BY term),
top AS (SELECT * FROM pt QUALIFY row_number() OVER (ORDER BY tf DESC, term) <= {max_features}),
vocab AS (SELECT '{col}' AS feature, term, row_number() OVER (ORDER BY term) - 1 AS idx, df,
  ln((1.0 + (SELECT count(*) FROM {table})) / (1.0 + df)) + 1 AS idf FROM top)"""
    if not transform:
        return body + "\nSELECT feature, term, idx, df, round(idf, 6) AS idf FROM vocab"
    return body + f"""
, raw AS (SELECT tc.{key.replace(', ', ', tc.')}, v.feature, v.term, v.idx, tc.cnt * v.idf AS raw
          FROM tc JOIN vocab v USING (term))
SELECT {key}, feature, term, idx,
  round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY {key})), 6) AS value FROM raw"""


def _round(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@register("tfidf_fit", _tfidf_sql("documents", "doc_id", "text", 256, 1, False))
def q_tfidf_fit(spark, sf):
    d = load_table(spark, sf, "documents", balance=True)
    return _round(V.tfidf_fit(d, ["doc_id"], ["text"], 256), "idf")


@register("tfidf_transform", _tfidf_sql("documents", "doc_id", "text", 256, 1, True))
def q_tfidf_transform(spark, sf):
    d = load_table(spark, sf, "documents", balance=True)
    _, out, _ = V.tfidf_fit_transform(d, ["doc_id"], ["text"], 256)
    return _round(out, "value")


@register("tfidf_fit_ngrams", _tfidf_sql("conversations", "conv_id, turn", "text", 2000, 2, False))
def q_tfidf_fit_ngrams(spark, sf):
    c = load_table(spark, sf, "conversations", balance=True)
    return _round(V.tfidf_fit(c, ["conv_id", "turn"], ["text"], 2000, n_grams=(1, 2)), "idf")


@register("tfidf_transform_ngrams", _tfidf_sql("conversations", "conv_id, turn", "text", 2000, 2, True))
def q_tfidf_transform_ngrams(spark, sf):
    c = load_table(spark, sf, "conversations", balance=True)
    _, out, _ = V.tfidf_fit_transform(c, ["conv_id", "turn"], ["text"], 2000, n_grams=(1, 2))
    return _round(out, "value")


_SESS_KEY = ["lgtime", "src_ip", "dst_ip", "label"]


def sessions_ctes(max_features: int = 256) -> str:
    """DuckDB CTE chain: http_log → hour sessions ``s`` → TF-IDF ``tfv``
    (value rounded to 6 places), for extension by other checks."""
    return with_log(f"""
, c AS (SELECT date_trunc('hour', logtime) AS lgtime, src_ip, dst_ip, hash AS label,
          {clean_sql('http_agent')} AS agent, {clean_sql('http_query')} AS query FROM http_log),
s AS (SELECT lgtime, src_ip, dst_ip, label,
  coalesce(array_to_string(list_sort(list(DISTINCT agent) FILTER (WHERE agent IS NOT NULL)), ' '), '') AS agent,
  coalesce(array_to_string(list_sort(list(DISTINCT query) FILTER (WHERE query IS NOT NULL)), ' '), '') AS query
  FROM c GROUP BY ALL),
t AS (SELECT lgtime, src_ip, dst_ip, label, 'agent' AS feature, unnest({tok_sql('agent')}) AS term FROM s
      UNION ALL
      SELECT lgtime, src_ip, dst_ip, label, 'query', unnest({tok_sql('query')}) FROM s),
tc AS (SELECT lgtime, src_ip, dst_ip, label, feature, term, count(*) AS cnt FROM t GROUP BY ALL),
pt AS (SELECT feature, term, sum(cnt) AS tf, count(*) AS df FROM tc GROUP BY ALL),
top AS (SELECT * FROM pt QUALIFY row_number() OVER (PARTITION BY feature ORDER BY tf DESC, term) <= {max_features}),
vocab AS (SELECT feature, term, row_number() OVER (PARTITION BY feature ORDER BY term) - 1 AS idx,
  ln((1.0 + (SELECT count(*) FROM s)) / (1.0 + df)) + 1 AS idf FROM top),
raw AS (SELECT tc.lgtime, tc.src_ip, tc.dst_ip, tc.label, feature, term, v.idx, tc.cnt * v.idf AS raw
        FROM tc JOIN vocab v USING (feature, term)),
tfv AS (SELECT lgtime, src_ip, dst_ip, label, feature, term, idx,
  round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY lgtime, src_ip, dst_ip, label, feature)), 6) AS value
  FROM raw)""")


def _sessions_sql():
    return sessions_ctes() + "\nSELECT * FROM tfv"


def session_features(spark, sf, max_features=256):
    s = session_text_labeled(http_log(spark, sf), "1 hour")
    vocab, out, _ = V.tfidf_fit_transform(s, _SESS_KEY, ["agent", "query"], max_features)
    return s, vocab, out


@register("tfidf_sessions", _sessions_sql())
def q_tfidf_sessions(spark, sf):
    return _round(session_features(spark, sf)[2], "value")


@register("concat_feature_blocks", f"""
WITH docs AS (SELECT conv_id, turn, {tok_sql('text')} AS g FROM conversations),
t AS (SELECT conv_id, turn, unnest(g) AS term FROM docs),
tc AS (SELECT conv_id, turn, term, count(*) AS cnt FROM t GROUP BY ALL),
pt AS (SELECT term, sum(cnt) AS tf, count(*) AS df FROM tc GROUP BY term),
top AS (SELECT * FROM pt QUALIFY row_number() OVER (ORDER BY tf DESC, term) <= 256),
vocab AS (SELECT term, ln((1.0 + (SELECT count(*) FROM conversations)) / (1.0 + df)) + 1 AS idf FROM top),
raw AS (SELECT conv_id, turn, term, cnt * idf AS raw FROM tc JOIN vocab USING (term))
SELECT conv_id, turn, 'text' AS feature, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY conv_id, turn)), 6) AS value
FROM raw
UNION ALL
SELECT conv_id, turn, 'role' AS feature, role AS term, 1.0 AS value FROM conversations""")
def q_concat_feature_blocks(spark, sf):
    c = load_table(spark, sf, "conversations", balance=True)
    vocab = V.tfidf_fit(c, ["conv_id", "turn"], ["text"], 256)
    text = V.tfidf_transform(c, vocab, ["conv_id", "turn"], ["text"]).select(
        "conv_id", "turn", "feature", "term", F.round("value", 6).alias("value"))
    roles = EN.onehot_long(c, EN.onehot_fit(c, ["role"]), ["conv_id", "turn"], ["role"]).select(
        "conv_id", "turn", F.col("column").alias("feature"), F.col("category").alias("term"), "value")
    return text.unionByName(roles)


@register("top_terms", f"""
WITH t AS (SELECT lang, unnest({tok_sql('text')}) AS term FROM documents)
SELECT lang, term, count(*) AS cnt FROM t GROUP BY lang, term
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, term) <= 20""")
def q_top_terms(spark, sf):
    d = load_table(spark, sf, "documents", balance=True)
    tc = V.terms(d, ["lang"], ["text"]).groupBy("lang", "term").agg(F.count(F.lit(1)).alias("cnt"))
    return top_terms(tc, 20, group=["lang"])


@register("bow_fit", f"""
SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM (
  SELECT DISTINCT unnest({tok_sql('text', stop=False)}) AS term FROM documents)""")
def q_bow_fit(spark, sf):
    return V.bow_fit(load_table(spark, sf, "documents", balance=True), ["doc_id"], "text")


@register("bow_transform", f"""
SELECT doc_id, term, count(*) AS cnt FROM (
  SELECT doc_id, unnest({tok_sql('text', stop=False)}) AS term FROM documents) GROUP BY ALL""")
def q_bow_transform(spark, sf):
    return V.bow_transform(load_table(spark, sf, "documents", balance=True), ["doc_id"], "text")


@register("onehot_fit", """
SELECT "column", category, row_number() OVER (PARTITION BY "column" ORDER BY category) - 1 AS idx FROM (
  SELECT DISTINCT 'o_orderstatus' AS "column", o_orderstatus AS category FROM orders
  UNION ALL SELECT DISTINCT 'o_orderpriority', o_orderpriority FROM orders) WHERE category IS NOT NULL""")
def q_onehot_fit(spark, sf):
    return EN.onehot_fit(load_table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


_WIDE = [("o_orderpriority", v) for v in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")] + [
    ("o_orderstatus", v) for v in ("F", "O")]


@register("onehot_transform", "SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS \"{c}_{v}\"" for c, v in _WIDE) + " FROM orders")
def q_onehot_transform(spark, sf):
    """Fit on orders that are not 'P', transform all: 'P' encodes to zeros."""
    o = load_table(spark, sf, "orders")
    fitted = EN.onehot_fit(o.where(F.col("o_orderstatus") != "P"), ["o_orderstatus", "o_orderpriority"])
    return EN.onehot_transform(o, fitted, ["o_orderstatus", "o_orderpriority"], keep=["o_orderkey"])


@register("onehot_long", """
WITH f AS (SELECT "column", category, row_number() OVER (PARTITION BY "column" ORDER BY category) - 1 AS idx FROM (
  SELECT DISTINCT 'o_orderstatus' AS "column", o_orderstatus AS category FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT DISTINCT 'o_orderpriority', o_orderpriority FROM orders WHERE o_orderstatus <> 'P')),
v AS (SELECT o_orderkey, 'o_orderstatus' AS "column", o_orderstatus AS category FROM orders
      UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority FROM orders)
SELECT v.o_orderkey, "column", category, f.idx, 1.0 AS value FROM v JOIN f USING ("column", category)""")
def q_onehot_long(spark, sf):
    o = load_table(spark, sf, "orders")
    fitted = EN.onehot_fit(o.where(F.col("o_orderstatus") != "P"), ["o_orderstatus", "o_orderpriority"])
    return EN.onehot_long(o, fitted, ["o_orderkey"], ["o_orderstatus", "o_orderpriority"])


@register("onehot_inverse", """
SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderstatus END AS category FROM orders""")
def q_onehot_inverse(spark, sf):
    o = load_table(spark, sf, "orders")
    fitted = EN.onehot_fit(o.where(F.col("o_orderstatus") != "P"), ["o_orderstatus"])
    wide = EN.onehot_transform(o, fitted, ["o_orderstatus"], keep=["o_orderkey"])
    return EN.onehot_inverse(wide, fitted, "o_orderstatus", ["F", "O"]).select("o_orderkey", "category")


_SCALE_COLS = ["l_extendedprice", "l_quantity"]


def _scale_q(method):
    def fn(spark, sf):
        li = load_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_SCALE_COLS)
        out = SC.scale_transform(li, SC.scale_fit(li, _SCALE_COLS, method), _SCALE_COLS, method)
        return _round(out, *_SCALE_COLS)
    return fn


def _scale_sql(params: str, exprs: dict) -> str:
    sel = ", ".join(f"round({e}, 6) AS {c}" for c, e in exprs.items())
    return f"WITH p AS (SELECT {params} FROM lineitem)\nSELECT l_orderkey, l_linenumber, {sel} FROM lineitem, p"


register("scale_standard", _scale_sql(
    ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALE_COLS),
    {c: f"({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END" for c in _SCALE_COLS}))(_scale_q("standard"))
register("scale_minmax", _scale_sql(
    ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _SCALE_COLS),
    {c: f"({c} - lo_{c}) / CASE WHEN hi_{c} = lo_{c} THEN 1 ELSE hi_{c} - lo_{c} END" for c in _SCALE_COLS}))(
    _scale_q("minmax"))
register("scale_maxabs", _scale_sql(
    ", ".join(f"max(abs({c})) AS a_{c}" for c in _SCALE_COLS),
    {c: f"{c} / CASE WHEN a_{c} = 0 THEN 1 ELSE a_{c} END" for c in _SCALE_COLS}))(_scale_q("maxabs"))
register("scale_robust", _scale_sql(
    ", ".join(f"quantile_cont({c}, [0.25, 0.5, 0.75]) AS q_{c}" for c in _SCALE_COLS),
    {c: f"({c} - q_{c}[2]) / CASE WHEN q_{c}[3] = q_{c}[1] THEN 1 ELSE q_{c}[3] - q_{c}[1] END"
     for c in _SCALE_COLS}))(_scale_q("robust"))


@register("scale_quantile", """
WITH p AS (SELECT quantile_cont(value, list_transform(range(0, 1000), lambda i: i / 999.0)) AS q,
                  list_transform(range(0, 1000), lambda i: i / 999.0) AS refs FROM events),
c AS (SELECT event_id, value AS x, q, refs, len(q) AS n,
        len(list_filter(q, lambda v: v <= value)) AS le, len(list_filter(q, lambda v: v < value)) AS lt
      FROM events, p),
f AS (SELECT event_id,
  CASE WHEN le = 0 THEN refs[1] WHEN le >= n THEN refs[n]
       WHEN q[le + 1] = q[le] THEN refs[le]
       ELSE refs[le] + (x - q[le]) / (q[le + 1] - q[le]) * (refs[le + 1] - refs[le]) END AS fwd,
  CASE WHEN lt = 0 THEN refs[1] WHEN lt >= n THEN refs[n]
       WHEN q[lt + 1] = q[lt] THEN refs[lt + 1]
       ELSE refs[lt + 1] - (q[lt + 1] - x) / (q[lt + 1] - q[lt]) * (refs[lt + 1] - refs[lt]) END AS bwd
  FROM c)
SELECT event_id, round(least(greatest((fwd + bwd) / 2, 0), 1), 6) AS value FROM f""")
def q_scale_quantile(spark, sf):
    ev = load_table(spark, sf, "events").select("event_id", "value")
    return _round(SC.scale_transform(ev, SC.scale_fit(ev, ["value"], "quantile"), ["value"], "quantile"), "value")


_YJ = """CASE WHEN x >= 0 THEN (CASE WHEN abs(lam) < 1e-12 THEN ln(1 + x) ELSE (pow(x + 1, lam) - 1) / lam END)
  ELSE (CASE WHEN abs(lam - 2) < 1e-12 THEN -ln(1 - x) ELSE -(pow(1 - x, 2 - lam) - 1) / (2 - lam) END) END"""


def _power_sql(table: str, col: str, key: str) -> str:
    """Twin of the power scaler: three grids, coarse to fine, over [-32, 32]."""
    def level(k: int, lam: str, src: str) -> str:
        return f"""g{k} AS (SELECT {lam} AS lam FROM {src}),
l{k} AS (SELECT lam, -count(*) / 2 * ln(var_pop({_YJ})) + (lam - 1) * sum(sign(x) * ln(1 + abs(x))) AS llf
       FROM x, g{k} GROUP BY lam),
b{k} AS (SELECT arg_max(lam, llf) AS lam FROM l{k} WHERE isfinite(llf)),
"""
    return f"""
WITH x AS (SELECT {col} AS x FROM {table} WHERE {col} IS NOT NULL),
""" + level(1, "-32.0 + i * 0.5", "range(0, 129) t(i)") + level(
        2, "round(b1.lam + i * 0.01, 6)", "b1, range(-50, 51) t(i)") + level(
        3, "round(b2.lam + i * 0.0001, 8)", "b2, range(-100, 101) t(i)") + f"""
y AS (SELECT e.{key}, (SELECT lam FROM b3) AS lam, e.{col} AS x FROM {table} e),
yy AS (SELECT {key}, {_YJ} AS y FROM y),
st AS (SELECT avg(y) AS m, stddev_pop(y) AS s FROM yy)
SELECT {key}, round((y - m) / CASE WHEN s = 0 THEN 1 ELSE s END, 6) AS value FROM yy, st"""


_FAR_SQL = "(SELECT event_id, 5 + ln(1 + value) / 8 AS far FROM events) AS far_events"


@register("scale_power_far", _power_sql(_FAR_SQL, "far", "event_id").replace("AS far_events e", "AS e"))
def q_scale_power_far(spark, sf):
    """J6 where the best λ lies far outside [-4, 4]."""
    ev = load_table(spark, sf, "events").select("event_id", (5 + F.log(1 + F.col("value")) / 8).alias("value"))
    return _round(SC.scale_transform(ev, SC.scale_fit(ev, ["value"], "power"), ["value"], "power"), "value")


@register("scale_power", _power_sql("events", "value", "event_id"))
def q_scale_power(spark, sf):
    ev = load_table(spark, sf, "events").select("event_id", "value")
    return _round(SC.scale_transform(ev, SC.scale_fit(ev, ["value"], "power"), ["value"], "power"), "value")

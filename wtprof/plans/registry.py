"""Registry of checked queries: Spark builder + equivalent DuckDB SQL.

Every builder reads the given tables (or data Spark derives from them) over
their whole extent; the SQL twin is run by DuckDB on the same parquet files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Builder] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a builder under ``name``; ``sql`` is its DuckDB twin (None =
    not expressible in SQL, rows-only check)."""
    def deco(fn: Builder) -> Builder:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from wtprof.plans import (q_sessions, q_relational, q_features, q_models,  # noqa: F401
                              q_io, q_streaming)


def queries() -> dict[str, Builder]:
    _load_all()
    return dict(_QUERIES)


# Output types the SQL twins must carry to equal Spark's result schema
# (DuckDB gives BIGINT for row_number/len, HUGEINT for integer sums).
SQL_TYPES = {
    "row_numbering": {"row_id": "BIGINT"},
    "epoch_number": {"epochs": "INTEGER"},
    "center_by_median": {"pos": "INTEGER"},
    "l2_norm": {"pos": "INTEGER"},
    "array_rescale": {"pos": "INTEGER"},
    "version_of": {"weekday": "INTEGER", "hour": "INTEGER"},
    "tokenize": {"n_tokens": "INTEGER"},
    "remove_stop_words": {"n_kept": "INTEGER"},
    "tfidf_fit": {"idx": "INTEGER"},
    "tfidf_transform": {"idx": "INTEGER"},
    "tfidf_fit_ngrams": {"idx": "INTEGER"},
    "tfidf_transform_ngrams": {"idx": "INTEGER"},
    "tfidf_sessions": {"idx": "INTEGER"},
    "onehot_fit": {"idx": "INTEGER"},
    "onehot_long": {"idx": "INTEGER", "value": "DOUBLE"},
    "save_fit": {"idx": "INTEGER"},
    "binary_metrics": {"pred_pos": "BIGINT", "actual_pos": "BIGINT"},
    "binary_metrics_labels": {"pred_pos": "BIGINT", "actual_pos": "BIGINT"},
    "run_history": {"epochs": "INTEGER", "pred_pos": "BIGINT", "actual_pos": "BIGINT"},
    "explain_rows": {"rank": "INTEGER"},
    "assemble": {"pos": "INTEGER"},
    "assemble_uncapped": {"pos": "INTEGER"},
    "explain_confirmed": {"n_features": "INTEGER"},
    "rank_features": {"feature": "INTEGER", "rank": "INTEGER"},
    "rank_features_abs": {"feature": "INTEGER", "rank": "INTEGER"},
    "top_k_features": {"feature": "INTEGER", "rank": "INTEGER"},
    "load_model_config": {"model_id": "INTEGER", "now_delta_seconds": "BIGINT"},
}


def typed(sql: str, types: dict[str, str]) -> str:
    casts = ", ".join(f'CAST("{c}" AS {t}) AS "{c}"' for c, t in types.items())
    return f"SELECT * REPLACE ({casts}) FROM (\n{sql}\n) AS _typed"


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {n: typed(q, SQL_TYPES[n]) if n in SQL_TYPES else q for n, q in _SQL.items()}


# DuckDB twin of wtprof.sources.tables.http_log, used as a CTE.
HTTP_LOG_CTE = """
http_log AS (
  SELECT e.ts AS logtime,
    concat('10.0.0.', CAST(e.user_id % 256 AS VARCHAR)) AS src_ip,
    concat('192.168.0.', CAST(p.page_id % 8 AS VARCHAR)) AS dst_ip,
    regexp_extract(p.url, 'https?://([^/]+)', 1) AS http_host,
    CASE e.user_id % 3 WHEN 0 THEN 'Mozilla/5.0 (X11; Linux)' WHEN 1 THEN 'curl/7.68.0'
      ELSE 'python-requests/2.25' END AS http_agent,
    concat(regexp_extract(p.url, 'https?://[^/]+(.*)', 1),
      CASE e.event_type WHEN 'error' THEN '&id=1%27%20OR%201=1--'
        WHEN 'purchase' THEN '/..%2F../etc/passwd%zz'
        WHEN 'signup' THEN '&q=%3Cscript%3Ealert(1)%3C/script%3E'
        WHEN 'view' THEN '&user=admin+x' ELSE '' END) AS http_query,
    CASE e.event_type WHEN 'error' THEN 'SQL_INJECTION' WHEN 'signup' THEN 'XSS'
      WHEN 'purchase' THEN 'BEACONING' WHEN 'view' THEN 'CREDENTIAL' ELSE 'normal' END AS hash,
    CASE WHEN e.event_id % 17 = 0 THEN NULL ELSE CAST(e.event_id % 5 AS INTEGER) END AS status,
    e.event_id,
    CAST(CASE e.user_id % 4 WHEN 0 THEN 80 WHEN 1 THEN 443 WHEN 2 THEN 8080 ELSE 8443 END AS INTEGER) AS dst_port,
    CASE WHEN e.event_id % 17 = 0 THEN NULL ELSE CAST((e.event_id % 5 + 1) * 100 AS INTEGER) END AS status_code
  FROM events e JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)
)"""


def clean_sql(col: str) -> str:
    """DuckDB twin of wtprof.functions.text.clean_text (DuckDB's url_decode
    already keeps bad escapes and '+')."""
    return (f"regexp_replace(replace(url_decode({col}), '/..', ' pathsearcherdetected '), "
            f"'[\\-%./!@#$?,;:&*)(+=0-9_]', ' ', 'g')")


def with_log(body: str) -> str:
    return f"WITH {HTTP_LOG_CTE}\n{body}"

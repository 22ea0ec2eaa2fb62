"""Session text (D1, D2) and per-session status counts.

A session is (time bucket, src_ip, dst_ip[, label]). Text columns are
cleaned *before* the set is built, so the partial ``collect_set`` on the
map side already holds only distinct cleaned strings: the shuffle carries
one entry per distinct (session, text) per partition. A hot session's final
set is exactly its output row, so no task holds more than one result row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wtprof.functions.text import clean_text
from wtprof.functions.timeutil import time_bucket

from wtprof.sessions_common import DEFAULT_TEXT  # noqa: E402


def session_text(log: DataFrame, interval: str = "1 minute", label_value: str | None = None,
                 text_cols: Sequence[tuple[str, str]] = DEFAULT_TEXT,
                 keys: Sequence[str] = ("src_ip", "dst_ip"), time_col: str = "logtime",
                 label_col: str | None = None, pre_distinct: bool = False) -> DataFrame:
    """Group by (bucket, keys), distinct cleaned texts sorted and joined by ' '.

    With ``label_col`` the label is a fourth grouping key (D2); otherwise the
    constant ``label_value`` is attached as ``label``.

    ``pre_distinct`` is for skewed sessions: (session, column, text) rows are
    de-duplicated first, in a shuffle spread by the text, so the final task
    of a hot session receives each distinct text once instead of one partial
    set per map partition.
    """
    grp = [time_bucket(time_col, interval).alias("lgtime")] + [F.col(k) for k in keys]
    if label_col:
        grp.append(F.col(label_col).alias("label"))
    cleaned = log.select(*grp, *[clean_text(src).alias(out) for out, src in text_cols])
    gkeys = ["lgtime", *keys] + (["label"] if label_col else [])
    if pre_distinct:
        cells = F.array(*[F.struct(F.lit(o).alias("c"), F.col(o).alias("t")) for o, _ in text_cols])
        long = (cleaned.select(*gkeys, F.explode(cells).alias("_e"))
                .select(*gkeys, F.col("_e.c").alias("_c"), F.col("_e.t").alias("_t")).distinct())
        aggs = [F.array_join(F.sort_array(F.collect_list(F.when(F.col("_c") == o, F.col("_t")))), " ").alias(o)
                for o, _ in text_cols]
        out = long.groupBy(*gkeys).agg(*aggs)
    else:
        aggs = [F.array_join(F.sort_array(F.collect_set(out)), " ").alias(out) for out, _ in text_cols]
        out = cleaned.groupBy(*gkeys).agg(*aggs)
    if not label_col:
        out = out.withColumn("label", F.lit(label_value))
    return out


def session_text_labeled(log: DataFrame, interval: str = "1 minute", label_col: str = "hash",
                         **kw) -> DataFrame:
    """As D1 with the class column as a grouping key."""
    return session_text(log, interval=interval, label_col=label_col, **kw)


# Fixed output names of the status-class counts (1xx … 5xx, other).
STATUS_CLASSES = [("info_st", 1), ("succ_st", 2), ("redir_st", 3), ("cler_st", 4), ("serer_st", 5)]


def status_class_counts(log: DataFrame, interval: str = "1 minute", status_col: str = "status_code",
                        port_col: str = "dst_port", keys: Sequence[str] = ("src_ip", "dst_ip"),
                        time_col: str = "logtime") -> DataFrame:
    """D9 [inferred from column names]: per session, distinct destination
    ports and the number of requests per HTTP status class; null or out of
    range codes count as other."""
    cls = F.floor(F.col(status_col) / 100)
    aggs = [F.count_distinct(port_col).alias("dst_port_cnt")]
    aggs += [F.count_if(cls == k).alias(name) for name, k in STATUS_CLASSES]
    aggs.append(F.count_if(cls.isNull() | (cls < 1) | (cls > 5)).alias("oth_st"))
    return (log.groupBy(time_bucket(time_col, interval).alias("lgtime"), *keys).agg(*aggs))

"""Joins (G1-G6). Join strategy is left to Catalyst/AQE unless a side has a
size fixed by construction (a literal map, a one-row aggregate)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_features(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """G1: join two per-row tables on the row identity (never on position)."""
    return left.join(right, list(keys), how)


def attach_keys(preds: DataFrame, keyed: DataFrame, id_col: str,
                keys: Sequence[str] = ("logtime", "src_ip", "dst_ip")) -> DataFrame:
    """Bring the session keys back to predictions by row id."""
    return preds.join(keyed.select(id_col, *keys), id_col, "inner")


def tree_parent(nodes: DataFrame, node_col: str = "node_num", left_col: str = "node_to_left",
                right_col: str = "node_to_right", out: str = "node_from") -> DataFrame:
    """Parent of each node from the children ids (negative/null = leaf
    marker). Roots get null."""
    edges = (nodes.select(F.col(node_col).alias("_parent"),
                          F.explode(F.array(F.col(left_col), F.col(right_col))).alias("_child"))
             .where(F.col("_child").isNotNull() & (F.col("_child") >= 0)))
    j = nodes.join(edges, nodes[node_col] == edges["_child"], "left")
    return j.drop("_child").withColumnRenamed("_parent", out)


def class_rows_join(full: DataFrame, class_scores: DataFrame, key: Sequence[str],
                    pred_col: str = "pred", class_col: str = "class", score_col: str = "score") -> DataFrame:
    """Each row takes the score of the model of its predicted class;
    rows without one get 0 — one join instead of a split per class."""
    s = class_scores.select(*[F.col(k).alias(f"_k_{k}") for k in key],
                            F.col(class_col).alias("_cls"), F.col(score_col).alias("_score"))
    cond = [full[k] == s[f"_k_{k}"] for k in key] + [full[pred_col] == s["_cls"]]
    j = full.join(s, cond, "left")
    return j.select(*[full[c] for c in full.columns],
                    F.coalesce(F.col("_score"), F.lit(0.0)).alias(score_col))


# Fixed class keys → display names.
CLASS_DISPLAY = {
    "scanning": "HTTP_SCANNING",
    "injection": "SQL_INJECTION",
    "xss": "XSS",
    "beaconing": "BEACONING",
    "credential": "CREDENTIAL",
    "normal": "NORMAL",
    "anomaly": "ANOMALY",
}
# Fixed value: result codes are this base plus the class code (our own code table).
CODE_BASE = 250000
CLASS_CODES = {"NORMAL": 0, "SQL_INJECTION": 1, "XSS": 2, "BEACONING": 3, "CREDENTIAL": 4,
               "HTTP_SCANNING": 5, "ANOMALY": 9}


def display_name(c):
    """Class key → display name; a value that already is a display name
    passes through; anything else is null."""
    m = F.create_map(*[F.lit(x) for kv in CLASS_DISPLAY.items() for x in kv])
    return F.coalesce(F.try_element_at(m, c), F.when(c.isin(list(CLASS_DISPLAY.values())), c))


def class_code(c):
    m = F.create_map(*[F.lit(x) for kv in CLASS_CODES.items() for x in kv])
    return F.try_element_at(m, c) + F.lit(CODE_BASE)


def lookup_class_code(df: DataFrame, col: str, name_out: str = "att_name", code_out: str = "result") -> DataFrame:
    """Class key → display name → numeric code (+250000). Literal maps,
    so no join at all; unknown keys give null."""
    return df.withColumn(name_out, display_name(F.col(col))).withColumn(code_out, class_code(F.col(name_out)))

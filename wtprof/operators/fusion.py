"""Routing and score fusion (L6-L10): pure column expressions.

Scores arrive as one column per label model (``normal`` holds the outlier
score of rows the tree sent to normal). Labels are ordered as the tree's
sorted classes, then ``anomaly``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wtprof.functions.arrays import CUT
from wtprof.operators.joins import class_code, display_name

NORMAL, ANOMALY = "normal", "anomaly"


def route_by_class(df: DataFrame, pred_col: str, labels: Sequence[str]) -> DataFrame:
    """Keep each row's score only for the model of its predicted class;
    the others become 0 (what per-class subsets + fill 0 produce)."""
    return df.withColumns({c: F.when(F.col(pred_col) == c, F.col(c)).otherwise(F.lit(0.0)) for c in labels})


def confirm_attack(df: DataFrame, pred_col: str, score_col: str, out: str = "ai_label_pred") -> DataFrame:
    """L7 (model 335): tree says normal → NORMAL; else the specialist's
    attack probability > 0.5 → the class, otherwise NORMAL."""
    p = F.col(pred_col)
    return df.withColumn(out, F.when(p == NORMAL, F.lit("NORMAL"))
                         .when(F.col(score_col) > CUT, p).otherwise(F.lit("NORMAL")))


def fuse_scores(df: DataFrame, labels: Sequence[str], threshold=None, train: bool = False,
                anomaly_wins: bool = True) -> DataFrame:
    """Fused decision.

    ``anomaly`` flag: in training, normal score > threshold; at predict
    time 0. Rows with no attack (or anomaly) score above 0.5 get normal = 1.
    The label is the first score above 0.5 in ``labels + [anomaly]`` order
    (index 0 when none), ``probs`` whether any is above 0.5; then display
    name and numeric code. With ``anomaly_wins`` (default) a raised anomaly
    flag turns a NORMAL decision into ANOMALY; ``False`` keeps the
    first-in-order rule, where normal (sorted before anomaly) wins.
    """
    thr = threshold if isinstance(threshold, Column) else F.lit(threshold)
    anomaly = (F.when(F.col(NORMAL) > thr, F.lit(1.0)).otherwise(F.lit(0.0)) if train else F.lit(0.0))
    d = df.withColumn("anomaly_score", F.col(NORMAL)).withColumn(ANOMALY, anomaly)
    attacks = [c for c in labels if c != NORMAL] + [ANOMALY]
    all_low = F.lit(True)
    for c in attacks:
        all_low = all_low & (F.col(c) <= CUT)
    d = d.withColumn(NORMAL, F.when(all_low, F.lit(1.0)).otherwise(F.col(NORMAL)))
    order = list(labels) + [ANOMALY]
    hits = F.array(*[F.col(c) > CUT for c in order])
    first = F.array_position(hits, True)
    idx = F.when(first > 0, first - 1).otherwise(F.lit(0))
    names = F.array(*[F.lit(c) for c in order])
    d = d.withColumn("probs", F.exists(hits, lambda h: h).cast("double"))
    d = d.withColumn("att_key", F.get(names, idx.cast("int")))
    if anomaly_wins:
        d = d.withColumn("att_key", F.when((F.col("att_key") == NORMAL) & (F.col(ANOMALY) > CUT), F.lit(ANOMALY))
                         .otherwise(F.col("att_key")))
    d = d.withColumn("att_name", display_name(F.col("att_key"))).withColumn("result", class_code(F.col("att_name")))
    return d.drop(*order)


def apply_anomaly(df: DataFrame, threshold) -> DataFrame:
    """NORMAL rows carry the threshold as ``probs``; rows whose raw
    normal score exceeds it become ANOMALY, and the code follows the new
    name (the reference kept the stale code)."""
    thr = threshold if isinstance(threshold, Column) else F.lit(threshold)
    d = df.withColumn("probs", F.when(F.col("att_name") == "NORMAL", thr).otherwise(F.col("probs")))
    d = d.withColumn("att_name", F.when(F.col("anomaly_score") > thr, F.lit("ANOMALY")).otherwise(F.col("att_name")))
    return d.withColumn("result", class_code(F.col("att_name")))


# Fixed result layout: column order and constant fills of the result table.
RESULT_COLUMNS = ["model_id", "lgtime", "end", "rule", "src_ip", "dst_ip", "src_ip_country_code",
                  "dst_ip_country_code", "ast_ip", "related_ip", "direction_inout", "direction_inout_bin",
                  "related_country", "att_name", "result", "probs", "anomaly_score", "feedback", "packet",
                  "if_label", "if_score", "lof_label", "lof_score", "ai_label", "ai_score"]
RESULT_CONSTANTS = {"rule": "-", "packet": 0, "if_label": 0, "src_ip_country_code": "-",
                    "dst_ip_country_code": "-", "direction_inout": "-", "direction_inout_bin": 0,
                    "related_country": "-", "ast_ip": 0, "related_ip": 0, "if_score": 0, "lof_label": 0,
                    "lof_score": 0, "ai_label": 0, "ai_score": 0}


def result_record(df: DataFrame, model_id: int, version: str) -> DataFrame:
    """The 25-column result layout; ``feedback`` carries the version."""
    cols = []
    for c in RESULT_COLUMNS:
        if c == "model_id":
            cols.append(F.lit(model_id).alias(c))
        elif c == "feedback":
            cols.append(F.lit(version).alias(c))
        elif c in RESULT_CONSTANTS:
            cols.append(F.lit(RESULT_CONSTANTS[c]).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)

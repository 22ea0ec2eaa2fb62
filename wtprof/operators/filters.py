"""Projections, filters and predicates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wtprof.operators.vectorize import small_side
from wtprof.session import materialize


def time_range(df: DataFrame, start, end, col: str = "logtime") -> DataFrame:
    """Half-open ``[start, end)``; on a raw column it reaches the scan."""
    c = F.col(col)
    return df.where((c >= F.lit(start)) & (c < F.lit(end)))


def by_label(df: DataFrame, label: str, col: str = "hash") -> DataFrame:
    """Rows of one class."""
    return df.where(F.col(col) == F.lit(label))


# Fixed values of the predict-time filter: classes whose name contains this
# text, or equals the second value, are not scored.
PREDICT_SKIP_CONTAINS = "nourl"
PREDICT_SKIP_EQUALS = "anomaly_2"


def predict_filter(df: DataFrame, col: str = "hash") -> DataFrame:
    """``hash NOT LIKE '%nourl%' AND hash != 'anomaly_2'``; null drops."""
    c = F.col(col)
    return df.where(~c.contains(PREDICT_SKIP_CONTAINS) & (c != F.lit(PREDICT_SKIP_EQUALS)))


def with_label(df: DataFrame, value: str, name: str = "label", version: str | None = None) -> DataFrame:
    """C4: constant label column, and optionally a version column."""
    out = df.withColumn(name, F.lit(value))
    if version is not None:
        out = out.withColumn("version", F.lit(version))
    return out


def project_rename(df: DataFrame, rename: Mapping[str, str] | None = None,
                   keep: Iterable[str] | None = None, drop: Iterable[str] | None = None) -> DataFrame:
    """Rename, then keep a column list or drop some columns."""
    out = df.withColumnsRenamed(dict(rename or {}))
    if keep is not None:
        out = out.select(*keep)
    if drop:
        out = out.drop(*drop)
    return out


def class_isin(df: DataFrame, classes: Iterable[str], col: str = "label", keep: bool = True) -> DataFrame:
    """Keep (or drop) rows whose class is in a set; null class never kept."""
    cond = F.col(col).isin(list(classes))
    return df.where(cond if keep else ~cond)


def exclude_keywords(df: DataFrame, exceptions: DataFrame, targets: Iterable[str],
                     column_col: str = "selectcolumn", keyword_col: str = "keyword") -> DataFrame:
    """C7 [inferred]: drop rows whose target column matches any keyword listed
    for that column (keywords joined by ``|`` as one regex).

    The keyword table is folded into one pattern per target column, used as
    a scalar subquery (no join, nothing through the driver). A column with no
    keywords gets a null pattern and filters nothing (an empty pattern would
    match every row). A null value never matches.
    """
    out = df
    for t in targets:
        pat = exceptions.agg(
            F.nullif(F.concat_ws("|", F.collect_list(F.when(F.col(column_col) == t, F.col(keyword_col)))),
                     F.lit(""))).scalar()
        out = out.where(~F.coalesce(F.rlike(F.col(t), pat), F.lit(False)))
    return out


GRAM = 4             # symbols of an indexed gram; shorter keywords are looked up whole
REGEX_MARKS = r"[\\\[\](){}.*+?^$|]"


def _grams(c: Column) -> Column:
    """The distinct runs of 1 to GRAM symbols of a text, lengths apart."""
    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.lit(GRAM)), lambda n: F.when(
        F.length(c) >= n, F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(c, i, n))).otherwise(
        F.array().cast("array<string>")))))


def exclude_keywords_many(df: DataFrame, exceptions: DataFrame, targets: Iterable[str],
                          column_col: str = "selectcolumn", keyword_col: str = "keyword") -> DataFrame:
    """C7 for long keyword lists: the rows that :func:`exclude_keywords` keeps,
    without an alternation that grows with the list.

    A keyword without marks of regular expressions is a plain string. It is
    indexed by the rarest of its grams, as counted over the distinct values
    of the column; a value meets, by an equi-join on its grams, only the
    keywords filed under one of them, and ``contains`` decides. Keywords that
    are expressions stay in one alternation. Rows go by an anti join on the
    value. A null value never matches, a null keyword is none, an empty one is
    as in :func:`exclude_keywords`, a part of the alternation."""
    out = df
    for t in targets:
        words = exceptions.where((F.col(column_col) == t) & F.col(keyword_col).isNotNull()).select(F.col(keyword_col).alias("_k")).distinct()
        plain = words.where((F.length("_k") > 0) & ~F.rlike("_k", F.lit(REGEX_MARKS)))
        others = words.where((F.length("_k") == 0) | F.rlike("_k", F.lit(REGEX_MARKS)))
        others = others.unionByName(plain.orderBy("_k").limit(1))  # beside another keyword an empty one matches all
        out = exclude_keywords(out, others.select(F.lit(t).alias(column_col), F.col("_k").alias(keyword_col)), [t],
                               column_col, keyword_col)
        values = materialize(out.select(F.col(t).alias("_v")).where(F.col(t).isNotNull()).distinct())
        size = F.least(F.length("_k"), F.lit(GRAM))
        own = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("_k") - size + 1), lambda i: F.substring("_k", i, size)))
        filed = plain.select("_k", F.explode(own).alias("_g"))
        seen = values.select(F.explode(_grams(F.col("_v"))).alias("_g")).groupBy("_g").agg(F.count("*").alias("_n"))
        # a keyword with a gram that no value has matches none
        rare = filed.join(seen, "_g", "left").groupBy("_k").agg(
            F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_g")).alias("r")).where("r.n > 0").select("_k", F.col("r._g").alias("_g"))
        met = values.select("_v", F.explode(_grams(F.col("_v"))).alias("_g")).join(rare, "_g")
        hit = materialize(met.where(F.contains("_v", "_k")).select(F.col("_v").alias(t)).distinct())
        out = out.join(small_side(hit), t, "left_anti").select(*df.columns)
    return out


# Fixed class keys of the note / attack-name mapping files.
MAPPED_CLASSES = ["beaconing", "injection", "scanning", "credential", "xss"]


def map_to_class(df: DataFrame, mapping: DataFrame, on: str, map_key: str = "note",
                 map_class: str = "mapping", classes: Iterable[str] = MAPPED_CLASSES) -> DataFrame:
    """Rows whose ``on`` value is listed under a class in the mapping get
    that class (one output row per matching class). Unknown classes in the
    file are ignored; a class with no entries matches nothing.

    The mapping is de-duplicated first, then joined; the planner broadcasts
    it only when it is measured small.
    """
    m = (mapping.where(F.col(map_class).isin(list(classes)))
         .select(F.col(map_key).alias("_k"), F.col(map_class).alias("mapped_class")).distinct())
    return df.join(m, df[on] == m["_k"]).drop("_k")


def rule_latest(rules: DataFrame, name_col: str = "rule_name", id_col: str = "id",
                body_col: str = "rule_body") -> DataFrame:
    """Body of the highest id per rule name (no correlated subquery)."""
    return rules.groupBy(name_col).agg(F.max_by(body_col, id_col).alias(body_col),
                                       F.max(id_col).alias(id_col))


def conditional_overwrite(df: DataFrame, cond: Column, col: str, value) -> DataFrame:
    """Set ``col`` to ``value`` where ``cond`` holds."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(col, F.when(cond, v).otherwise(F.col(col)))


def nonzero_features(long_features: DataFrame, value_col: str = "value") -> DataFrame:
    """(key, feature, value) rows with a non-zero value."""
    return long_features.where(F.col(value_col) != 0)

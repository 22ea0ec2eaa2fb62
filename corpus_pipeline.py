"""Corpus pipeline: the stages that turn ``documents`` into packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as
Parquet and reread as the next stage's docs. All but the last return the
columns of ``docs``, whatever their names; a changed text has its ``n_chars``
renewed. All stages take null and empty texts, repeated rows, null ids and
empty tables; what becomes of them is said at each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wtprof.llm import packing, secret_grammar, simhash_vp, substring_dedup, toxicity
from wtprof.llm.common import table, written
from wtprof.llm.queries import WORD_BPE, tokenizer_path


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel model, fitted on ``docs`` and the
    table ``labels``, does not call toxic. A document scored exactly 0.5 is
    called toxic. Null and empty texts have no word and the model's lowest
    score: they stay, as do repeated rows that are clean. Without labelled
    rows, and for an empty table, nothing is dropped."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-equal SimHash fingerprints: that of
    the smallest id (null ids last), of rows that share it one. Null, empty
    and blank texts have the same fingerprint: one of them stays. An empty
    table stays empty."""
    return simhash_vp.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that smaller documents have; one that
    consisted of such passages only is dropped. Null and wordless texts stay
    as they are, a null id is larger than any other, and rows that share an id
    keep their passages. An empty table stays empty."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    carried = docs.select("doc_id", "text", F.struct(*rest).alias("rest"))
    cut = substring_dedup.remove_repeats(carried)
    left = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("rest.n_chars"))
    own = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": n_chars}
    return left.select(*(own.get(c, F.col("rest")[c]).alias(c) for c in docs.columns))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret found replaced by a mark. All rows stay;
    texts without secrets, null and empty ones among them, as they are. An
    empty table has no credentials to learn from and stays empty."""
    carried = docs.select("text", F.struct(*docs.columns).alias("row"))
    clean = secret_grammar.redact(carried, secret_grammar.learn(docs))
    same = F.col("text").eqNullSafe(F.col("row.text"))
    own = {"text": F.col("text"), "n_chars": F.when(same, F.col("row.n_chars")).otherwise(F.length("text").cast("long"))}
    return clean.select(*(own.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens over all documents kept. A
    null text counts as empty, which is the end token alone; repeated rows and
    null ids are packed like any other; an empty table gives no pieces."""
    return packing.pack(docs, tokenizer_path(WORD_BPE))


STAGES = [
    ("toxicity", without_toxic),
    ("simhash near-dedup", without_near_duplicates),
    ("substring dedup", without_repeats),
    ("secret scans", without_secrets),
    ("packing", packed),
]

ORACLE_SQL = None  # fitted models and tokenization are not expressible in SQL; tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

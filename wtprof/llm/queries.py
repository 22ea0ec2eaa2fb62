"""Registered queries of this subpackage and their DuckDB twins.

Each ``opN_`` query applies one operator with production parameters to its
whole table and derives the contract's columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wtprof.llm import (bpe, embedding_forest, multiset_hash, packing, secret_grammar, simhash_vp, spelling_variants, substring_dedup,
                        token_counts, topk_threshold, toxicity, url_reputation, whitening)
from wtprof.llm.common import table

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


# Fixed rules of the url filter (host, path).
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_grammar.digest(secret_grammar.scan(docs, secret_grammar.learn(docs)))


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.codec_digests(table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE))


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, good) of the labelled pages: a page shows the document whose id
    is the first number after a slash of its path, whatever follows it
    (``/en/4033.html``), and is good if that document's label is of good
    quality and not toxic."""
    path = url_reputation.url_parts(F.col("url"))[1]
    shown = (table(spark, sf_dir, "pages").select("url", F.regexp_extract(path, r"/(\d+)", 1).alias("number"))
             .select("url", F.expr("try_cast(number as bigint)").alias("doc_id")))
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int").alias("good"))
    return shown.join(labels, "doc_id").select("url", "good")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_reputation.filter_urls(table(spark, sf_dir, "pages"), page_outcomes(spark, sf_dir), URL_RULES)


def op4_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_forest.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs, digest=True)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(PIECE_BPE))


def op7_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_vp.digest(simhash_vp.near_duplicates(table(spark, sf_dir, "documents")))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op10_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.edit_likeness(table(spark, sf_dir, "documents"))


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_threshold.top_k(table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_bpe_codec, op3_url_filter, op4_embedding_near_dup, op5_substring_dedup, op6_token_counts,
    op7_simhash_near_dup, op8_packing, op9_toxicity, op10_multiset_fingerprints,
    op11_exact_top_k, op12_spelling_variants, op13_embedding_whitening)}
# DuckDB's levenshtein counts bytes: in the twin of op12 the Latin-1 letters
# stand as single bytes that no word has.
LATIN = "".join(map(chr, range(0xC0, 0x100)))
BYTES = "".join(map(chr, range(0x21, 0x61))).replace("'", "''")

SQL: dict[str, str] = {
    "op11_exact_top_k": """
WITH x AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda c: floor(64 * CAST(c AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM x q JOIN x c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
""",
    "op12_spelling_variants": r"""
WITH RECURSIVE
bits(b, k, c) AS (
  SELECT range, 0, CAST(range AS UBIGINT) FROM range(256)
  UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]{6,}')) AS run FROM documents),
lows AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, count(*) AS m
  FROM runs GROUP BY ALL),
bytes AS (
  SELECT low, m, regexp_extract_all(hex(encode(concat(CAST(doc_id AS VARCHAR), ':', low))), '..') AS hexes FROM lows),
hashed AS (
  SELECT low, m, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(hexes, lambda x: CAST('0x' || x AS UBIGINT))),
      lambda acc, b: xor(acc >> 8, t[CAST(xor(acc, b) & 255 AS INTEGER) + 1])), 4294967295::UBIGINT) AS h
  FROM bytes, crc_table),
changed AS (
  SELECT m, CASE WHEN h % 199 = 0
    THEN concat(substr(low, 1, CAST(h % length(low) AS INTEGER)), substr(low, CAST(h % length(low) AS INTEGER) + 2)) ELSE low END AS word
  FROM hashed),
words AS (
  SELECT word, CAST(sum(m) AS BIGINT) AS n FROM changed WHERE length(word) >= 6 GROUP BY word HAVING sum(m) >= 5),
plain AS (
  SELECT word, n, translate(word, '@LATIN', '@BYTES') AS p FROM words),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n
  FROM plain a JOIN plain b ON abs(length(a.p) - length(b.p)) <= 1 AND a.word <> b.word AND levenshtein(a.p, b.p) = 1),
best AS (
  SELECT word, n, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS top, max(other_n) AS top_n
  FROM near GROUP BY word, n),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 5 * w.n THEN top END AS form,
    CASE WHEN top_n >= 5 * w.n THEN top_n END AS form_n
  FROM words w LEFT JOIN best USING (word, n)),
chain(word, root) AS (
  SELECT word, word FROM formed
  UNION ALL
  SELECT c.word, f.form FROM chain c JOIN formed f ON c.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON f.word = c.word JOIN formed e ON e.word = c.root AND e.form IS NULL
""".replace("@LATIN", LATIN).replace("@BYTES", BYTES),
}

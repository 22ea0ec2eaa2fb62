"""Text vectorising: TF-IDF (J7, J8), bag of words (J9), assembly.

Semantics follow the reference's vectoriser settings: lower-case tokens of
≥2 word characters, stop words removed *before* n-grams, vocabulary = the
``max_features`` most frequent terms over the corpus (ties by term),
``idf = ln((1 + n) / (1 + df)) + 1``, ``tf · idf`` L2-normalised per document.

Layout is long and sparse: ``(key…, feature, term, value)``. The fitted
vocabulary is a small DataFrame (≤ max_features rows per text column, a
proven bound), so joining it is a broadcast.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wtprof.functions.text import STOP_WORDS, ngrams, remove_stop_words, tokenize
from wtprof.operators.topk import top_terms
from wtprof.session import materialize, scratch_path


def terms(df: DataFrame, key: Sequence[str], text_cols: Sequence[str], n_grams=(1, 1),
          stop_words: Sequence[str] | None = STOP_WORDS) -> DataFrame:
    """Explode documents into ``(key…, feature, term)`` rows, repeats kept.

    All text columns come out of one pass over ``df`` (an array of
    (feature, terms) structs exploded twice), so an expensive input such as
    the session aggregate is computed once, not once per text column.
    """
    return _terms_with_docs(df, key, text_cols, n_grams, stop_words, marker=False)


DOC_MARKER = "__doc__"
# A fitted table is broadcast only up to this many rows; larger ones join
# by shuffle (an uncapped vocabulary grows with the corpus).
BROADCAST_MAX_ROWS = 1_000_000
# A vocabulary up to this size is looked up within the row (each task holds it).
ROW_VOCABULARY = 50_000


def small_side(df: DataFrame, bounded: bool = False) -> DataFrame:
    """Broadcast hint for a fitted table whose size is proven (``bounded``)
    or checked now by a count (fitted tables are small, materialised
    parquet); otherwise leave the join strategy to the planner."""
    if bounded or df.count() <= BROADCAST_MAX_ROWS:
        return F.broadcast(df)
    return df


def _terms_with_docs(df: DataFrame, key: Sequence[str], text_cols: Sequence[str], n_grams=(1, 1),
                     stop_words: Sequence[str] | None = STOP_WORDS, marker: bool = True) -> DataFrame:
    """One pass over the documents: every text column's terms plus one
    marker row per document (feature ``__doc__``, null term), so the
    document count needs no second scan of an expensive input."""
    unigrams = tuple(n_grams) == (1, 1)
    blocks = []
    for c in text_cols:
        toks = tokenize(F.col(c))
        if stop_words and not unigrams:
            toks = remove_stop_words(toks, stop_words)
        blocks.append(F.struct(F.lit(c).alias("feature"), ngrams(toks, *n_grams).alias("terms")))
    if marker:
        blocks.append(F.struct(F.lit(DOC_MARKER).alias("feature"),
                               F.array(F.lit(None).cast("string")).alias("terms")))
    # explode_outer: no inferred size filter that would re-run the tokenizer
    t = df.select(*key, F.explode_outer(F.array(*blocks)).alias("_b"))
    t = t.select(*key, F.col("_b.feature").alias("feature"), F.explode_outer("_b.terms").alias("term"))
    keep = F.col("term").isNotNull() | (F.col("feature") == DOC_MARKER)
    if stop_words and unigrams:
        keep = keep & (F.col("term").isNull() | ~F.col("term").isin(list(stop_words)))
    return t.where(keep)


def term_counts(df: DataFrame, key: Sequence[str], text_cols: Sequence[str], **kw) -> DataFrame:
    """``(key…, feature, term, cnt)``: occurrences per document. Each
    document's tokens sit in one partition, so the partial aggregate already
    collapses repeats before the shuffle."""
    return terms(df, key, text_cols, **kw).groupBy(*key, "feature", "term").agg(F.count(F.lit(1)).alias("cnt"))


def _by_key(df: DataFrame, key: Sequence[str], unique: bool) -> tuple[DataFrame, DataFrame | None]:
    """(rows whose key no other row has, the other rows or None). A document
    that is one row is counted within the row; only documents spread over
    several rows (null keys count as equal) have to be grouped. The check
    reads and shuffles the keys alone; ``unique`` skips it."""
    if unique:
        return df, None
    shared = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    shared = materialize(shared.select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(key)]))
    if shared.isEmpty():
        return df, None
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_s{i}")) for i, k in enumerate(key)])
    side = small_side(shared)
    return df.join(side, same, "left_anti"), df.join(side, same, "left_semi")


def _row_terms(df: DataFrame, key: Sequence[str], text_cols: Sequence[str], n_grams, stop_words) -> DataFrame:
    """``key…`` and each row's terms as arrays ``_t0``, ``_t1`` … (one for
    each text column), repeats kept. Stop words of unigrams are still in."""
    found = []
    for i, c in enumerate(text_cols):
        toks = tokenize(F.col(c))
        if stop_words and tuple(n_grams) != (1, 1):
            toks = remove_stop_words(toks, stop_words)
        found.append(ngrams(toks, *n_grams).alias(f"_t{i}"))
    return df.select(*key, *found)


def _row_counts(rows: DataFrame, text_cols: Sequence[str], n_grams, stop_words) -> DataFrame:
    """``(feature, term, tf, df)`` of :func:`_row_terms` rows, each a document
    of its own. Nothing is grouped by document: a row emits its terms and its
    distinct terms, and the aggregate by term starts before the shuffle."""
    blocks = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_t{i}").alias("terms")) for i, c in enumerate(text_cols)])
    t = rows.select(F.explode_outer(blocks).alias("_b")).select("_b.feature", F.col("_b.terms").alias("_all"))
    sides = F.array(F.struct(F.lit(False).alias("once"), F.col("_all").alias("terms")),
                    F.struct(F.lit(True).alias("once"), F.array_distinct("_all").alias("terms")))
    t = t.select("feature", F.explode_outer(sides).alias("_b"))
    t = t.select("feature", F.col("_b.once").alias("_once"), F.explode_outer("_b.terms").alias("term"))
    keep = F.col("term").isNotNull()
    if stop_words and tuple(n_grams) == (1, 1):
        keep = keep & ~F.col("term").isin(list(stop_words))
    return t.where(keep).groupBy("feature", "term").agg(F.count_if(~F.col("_once")).alias("tf"), F.count_if(F.col("_once")).alias("df"))


def tfidf_fit(df: DataFrame, key: Sequence[str], text_cols: Sequence[str], max_features: int | None = 256,
              n_grams=(1, 1), stop_words: Sequence[str] | None = STOP_WORDS, unique: bool = False) -> DataFrame:
    """Vocabulary ``(feature, term, idx, df, idf)`` per text column.

    ``n`` (documents) is a scalar subquery; document frequency and corpus
    frequency come from one aggregate by term whose partial step runs
    map-side, so a term present in every document is not a hot key and what
    is shuffled is a row a term and task. Only documents spread over several
    rows are grouped by key first (``unique``: the caller knows of none).
    E3 keeps the top terms with a window group limit; ``idx`` is the
    alphabetical position.
    """
    once, many = _by_key(df, key, unique)
    per_term = _row_counts(_row_terms(once, key, text_cols, n_grams, stop_words), text_cols, n_grams, stop_words)
    if many is not None:
        per_term = _added_counts(per_term, term_counts(many, key, text_cols, n_grams=n_grams, stop_words=stop_words))
    return _vocab(per_term, df.select(F.count(F.lit(1))).scalar(), max_features)


def tfidf_fit_transform(df: DataFrame, key: Sequence[str], text_cols: Sequence[str], max_features: int | None = 256,
                        n_grams=(1, 1), stop_words: Sequence[str] | None = STOP_WORDS, unique: bool = False,
                        packed: bool = False):
    """J7 + J8 with one tokenisation: the rows' terms (for documents of
    several rows and for uncapped vocabularies: the counts by document) are
    persisted (memory and disk; recomputed from lineage if an executor is
    lost) and feed both the vocabulary and the transform. Returns
    ``(vocab, transformed, counts)``; unpersist ``counts`` when done.
    ``packed`` (unique keys, capped) gives the rows of :func:`tfidf_cells`."""
    from pyspark import StorageLevel

    if packed and not (unique and max_features):
        raise ValueError("packed rows need unique keys and a capped vocabulary")
    once, many = _by_key(df, key, unique) if max_features else (None, df)
    tc = rows = per_term = None
    if many is not None:
        tc = (_terms_with_docs(many, key, text_cols, n_grams=n_grams, stop_words=stop_words)
              .groupBy(*key, "feature", "term").agg(F.count(F.lit(1)).alias("cnt"))
              .persist(StorageLevel.MEMORY_AND_DISK))
        n_docs = tc.where(F.col("feature") == DOC_MARKER).select(F.count(F.lit(1))).scalar()
        tc = tc.where(F.col("feature") != DOC_MARKER)
        per_term = _term_sums(tc)
    if once is not None:
        rows = _row_terms(once, key, text_cols, n_grams, stop_words).persist(StorageLevel.MEMORY_AND_DISK)
        n_rows = rows.select(F.count(F.lit(1))).scalar()
        n_docs = n_rows if many is None else n_docs + n_rows
        own = _row_counts(rows, text_cols, n_grams, stop_words)
        per_term = own if many is None else _added_counts(own, tc)
    vocab = _vocab(per_term, n_docs, max_features)
    if not max_features:
        v = small_side(vocab.select("feature", "term", "idx", "idf"))
        return vocab, _l2(tc.join(v, ["feature", "term"]).withColumn("raw", F.col("cnt") * F.col("idf")), key), tc
    vocab = materialize(vocab)  # ≤ max_features rows per text column
    cells = _cells(rows, vocab, key, text_cols, n_grams, stop_words)
    if packed:
        return vocab, cells, rows
    out = cell_rows(cells, vocab, key, text_cols)
    if many is not None:
        v = F.broadcast(vocab.select("feature", "term", "idx", "idf"))
        out = out.unionByName(_l2(tc.join(v, ["feature", "term"]).withColumn("raw", F.col("cnt") * F.col("idf")), key))
    return vocab, out, rows


def _term_sums(tc: DataFrame) -> DataFrame:
    return tc.groupBy("feature", "term").agg(F.sum("cnt").alias("tf"), F.count(F.lit(1)).alias("df"))


def _added_counts(per_term: DataFrame, tc: DataFrame) -> DataFrame:
    return per_term.unionByName(_term_sums(tc)).groupBy("feature", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def _vocab(per_term: DataFrame, n_docs, max_features: int | None) -> DataFrame:
    if max_features:
        per_term = top_terms(per_term, max_features, group=["feature"], count_col="tf")
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    if max_features:
        # ≤ max_features rows per feature: a per-feature window is bounded
        w = Window.partitionBy("feature").orderBy("term")
        idx = per_term.withColumn("idx", F.row_number().over(w) - 1)
    else:
        # unbounded vocabulary: distributed numbering, then per-feature offsets
        g = global_index(per_term.withColumn("_o", F.concat_ws("\u0000", "feature", "term")), "_o", "_g")
        off = g.groupBy("feature").agg(F.min("_g").alias("_off"))  # one row per text column
        idx = g.join(F.broadcast(off), "feature").withColumn("idx", F.col("_g") - F.col("_off"))
    return idx.select("feature", "term", F.col("idx").cast("int").alias("idx"), "df", idf.alias("idf"))


CELLS = "array<struct<idx:int,value:double>>"


def _cells(rows: DataFrame, vocab: DataFrame, key: Sequence[str], text_cols: Sequence[str], n_grams, stop_words) -> DataFrame:
    """:func:`tfidf_cells` of :func:`_row_terms` rows."""
    fitted: dict[str, list] = {}
    for r in vocab.select("feature", "idx", "term", "idf").collect():  # ≤ ROW_VOCABULARY rows
        if not (stop_words and tuple(n_grams) == (1, 1) and r["term"] in stop_words):
            fitted.setdefault(r["feature"], []).append((r["idx"], r["term"], r["idf"]))
    out = rows
    for i, c in enumerate(text_cols):
        own = sorted(fitted.get(c, []))
        if not own:
            out = out.withColumn(c, F.array().cast(CELLS))
            continue
        idx, names, idf = zip(*own)
        counted = CountVectorizerModel.from_vocabulary(list(names), f"_t{i}", f"_c{i}")
        weighed = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol=f"_c{i}", outputCol=f"_w{i}")
        normed = Normalizer(p=2.0, inputCol=f"_w{i}", outputCol=f"_n{i}")
        out = normed.transform(weighed.transform(counted.transform(out)))
        out = out.withColumn(f"_u{i}", F.unwrap_udt(f"_n{i}"))
        gapless = idx == tuple(range(len(idx)))
        place = (lambda k: k) if gapless else (lambda k: F.get(F.array(*map(F.lit, idx)), k))  # noqa: B023
        out = out.withColumn(c, F.zip_with(f"_u{i}.indices", f"_u{i}.values", lambda k, v: F.struct(
            place(k).cast("int").alias("idx"), v.alias("value"))))  # noqa: B023
    return out.select(*key, *text_cols)


def tfidf_cells(df: DataFrame, vocab: DataFrame, key: Sequence[str], text_cols: Sequence[str], n_grams=(1, 1),
                stop_words: Sequence[str] | None = STOP_WORDS) -> DataFrame:
    """J8 within the row, for documents of one row each: ``key…`` and in place
    of each text column its non-zero entries (idx, value), by idx. Counting,
    weighing and the norm are Spark ML's transformers over the fitted
    vocabulary; nothing is exploded, joined or shuffled."""
    return _cells(_row_terms(df, key, text_cols, n_grams, stop_words), vocab, key, text_cols, n_grams, stop_words)


def cell_rows(cells: DataFrame, vocab: DataFrame, key: Sequence[str], text_cols: Sequence[str]) -> DataFrame:
    """The rows ``(key…, feature, term, idx, value)`` of :func:`tfidf_cells`."""
    blocks = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("cells")) for c in text_cols])
    t = cells.select(*key, F.explode_outer(blocks).alias("_b")).select(*key, "_b.feature", F.explode_outer("_b.cells").alias("_e"))
    t = t.select(*key, "feature", F.col("_e.idx").alias("idx"), F.col("_e.value").alias("value")).where(F.col("idx").isNotNull())
    t = t.join(F.broadcast(vocab.select("feature", "idx", "term")), ["feature", "idx"])
    return t.select(*key, "feature", "term", "idx", "value")


def _l2(raw: DataFrame, key: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*key, "feature")
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(w))
    return raw.select(*key, "feature", "term", "idx", (F.col("raw") / norm).alias("value"))


def tfidf_transform(df: DataFrame, vocab: DataFrame, key: Sequence[str], text_cols: Sequence[str],
                    n_grams=(1, 1), stop_words: Sequence[str] | None = STOP_WORDS, unique: bool = False) -> DataFrame:
    """``(key…, feature, term, idx, value)`` with value = L2-normalised
    tf·idf; only non-zero entries (missing = 0).

    Documents of one row are counted within the row (:func:`tfidf_cells`).
    Documents of several rows, and all with a vocabulary of more than
    ``ROW_VOCABULARY`` terms, are grouped: their tokens are filtered by a
    join against the vocabulary before counting, a broadcast after a check of
    its size. Counting groups by (key, term) and the norm is a window by key:
    when the input is already hash-partitioned by ``key`` (e.g. the session
    aggregate), neither step shuffles again.
    """
    if vocab.limit(ROW_VOCABULARY + 1).count() > ROW_VOCABULARY:
        return _transform_by_key(df, vocab, key, text_cols, n_grams, stop_words)
    once, many = _by_key(df, key, unique)
    out = cell_rows(tfidf_cells(once, vocab, key, text_cols, n_grams, stop_words), vocab, key, text_cols)
    return out if many is None else out.unionByName(_transform_by_key(many, vocab, key, text_cols, n_grams, stop_words))


def _transform_by_key(df: DataFrame, vocab: DataFrame, key: Sequence[str], text_cols: Sequence[str], n_grams, stop_words) -> DataFrame:
    t = terms(df, key, text_cols, n_grams=n_grams, stop_words=stop_words)
    v = small_side(vocab.select("feature", "term", "idx", "idf"))
    hit = t.join(v, ["feature", "term"])
    tf = hit.groupBy(*key, "feature", "term", "idx", "idf").agg(F.count(F.lit(1)).alias("cnt"))
    return _l2(tf.withColumn("raw", F.col("cnt") * F.col("idf")), key)


def feature_names(vocab: DataFrame) -> DataFrame:
    """Wide-layout names ``<column>_<term>`` of the vocabulary."""
    return vocab.select("feature", "term", "idx", F.concat_ws("_", "feature", "term").alias("feature_term"))


def bow_fit(df: DataFrame, key: Sequence[str], text_col: str) -> DataFrame:
    """Vocabulary of all terms (no stop words, unigrams) with the
    alphabetical index, computed without a single-partition window."""
    vocab = terms(df, key, [text_col], stop_words=None).select("term").distinct()
    return global_index(vocab, "term", "idx")


def bow_transform(df: DataFrame, key: Sequence[str], text_col: str) -> DataFrame:
    """Raw counts per document ``(key…, term, cnt)``."""
    return term_counts(df, key, [text_col], stop_words=None).drop("feature")


def global_index(df: DataFrame, order_col: str, out: str = "idx") -> DataFrame:
    """0-based position in a total order without funnelling rows into one task.

    A range-partitioned sort, then row numbers within each partition plus
    the row counts of the earlier partitions (one small row per partition).
    The sorted rows are written with their partition number first: counts and
    numbers must come from the same partitioning, whatever columns are read.
    """
    s = materialize(df.orderBy(order_col).withColumn("_pid", F.spark_partition_id()))
    local = s.withColumn("_rn", F.row_number().over(Window.partitionBy("_pid").orderBy(order_col)))
    sizes = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = sizes.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    return (local.join(F.broadcast(offs), "_pid")  # one row per partition
            .withColumn(out, F.col("_off") + F.col("_rn") - 1).drop("_pid", "_rn", "_off"))


def as_vectors(df: DataFrame, col: str) -> DataFrame:
    """``df`` with the struct ``col`` (type, size, indices, values: the stored
    form of an ML vector) as a vector column. Spark casts no struct to a
    vector, so the rows are written once to the shared folder and read back
    with the vector type; later plans start from these files."""
    from pyspark.ml.linalg import VectorUDT

    path = scratch_path(df.sparkSession, f"vectors-{uuid.uuid4().hex}")
    df.write.parquet(path)
    fields = [T.StructField(f.name, VectorUDT() if f.name == col else f.dataType) for f in df.schema.fields]
    return df.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def assemble(long: DataFrame, key: Sequence[str], size: int, index_col: str = "idx",
             value_col: str = "value", label_col: str | None = None, out: str = "features",
             rows: DataFrame | None = None, cells: str | None = None) -> DataFrame:
    """Long rows → one sparse ML vector per key, of ``size`` dimensions.

    A vector holds the sorted (index, value) pairs of its row that are not
    zero; nothing of vocabulary size is built, so the size costs nothing.
    With ``rows`` (a frame with the key) each of its rows gets a vector and
    keeps its columns, the zero vector where ``long`` has no entry. An index
    must occur once a key. ``cells`` names a column of ``long`` that has all
    entries of its row, sorted by index: then a row is a key, with its other
    columns, and nothing is grouped (a row with a null in its key has the
    zero vector, as the join with ``rows`` gives it)."""
    keep = [*key, *([label_col] if label_col else [])]
    if cells is not None:
        keep = [c for c in long.columns if c != cells]
        known = reduce(and_, [F.col(k).isNotNull() for k in key])
        entries = F.transform(cells, lambda x: F.struct(x[index_col].cast("int").alias("i"), x[value_col].cast("double").alias("v")))
        g = long.select(*keep, F.when(known, entries).alias("_e"))
    else:
        entry = F.struct(F.col(index_col).cast("int").alias("i"), F.col(value_col).cast("double").alias("v"))
        g = long.groupBy(*keep).agg(F.sort_array(F.collect_list(entry)).alias("_e"))
        if rows is not None:
            g, keep = rows.join(g, keep, "left"), rows.columns
    e = F.filter(F.coalesce("_e", F.array().cast("array<struct<i:int,v:double>>")), lambda x: x["v"] != 0)
    g = g.select(*keep, e.alias("_e"))
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).cast("int").alias("size"),
                      F.transform("_e", lambda x: x["i"]).alias("indices"), F.transform("_e", lambda x: x["v"]).alias("values"))
    return as_vectors(g.select(*keep, vector.alias(out)), out)

"""Document fingerprints by a homomorphic multiset hash, native Spark only.

A paragraph (line) is hashed to a wide vector, and a document's fingerprint
is the sum of its paragraphs' vectors, each lane modulo 2^32. So equal
multisets of paragraphs have equal fingerprints in any order, and a paragraph
is inserted or deleted by adding or subtracting its vector.

Lanes of a paragraph's vector:
- 8 lanes of 32 hash bits of the whole paragraph (for equality);
- the number of its pieces, a piece being at most four words of one line;
- 64 lanes that count the pieces whose hash has that bit set, kept two to a
  64-bit word. 2 x count - pieces is a sum of random signs, so the inner
  product of two fingerprints estimates how many pieces they share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wtprof.llm.common import shuffle_width, text_or_empty, written

MOD = 1 << 32
EQ_LANES, SIGN_WORDS = 8, 32
PIECE = r"\S++(?:[ \t]++\S++){0,3}+"
PAIR = (1 << 32) | 1


def _vector_sums(paragraph_hashes: list[Column], first: Column, piece: Column) -> list[Column]:
    """Aggregates of one row per piece (``first`` marks a paragraph's first
    row; a paragraph without words has one row with a null piece)."""
    eq = [lane for h in paragraph_hashes for lane in (h.bitwiseAND(MOD - 1), F.shiftrightunsigned(h, 32))]
    sums = [F.sum(F.when(first, lane).otherwise(0)) for lane in eq]
    h = F.when(piece.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(piece))
    sums.append(F.count(piece))
    sums += [F.sum(F.shiftrightunsigned(h, i).bitwiseAND(PAIR)) for i in range(SIGN_WORDS)]
    return sums


def vectors(df: DataFrame, keys: list[str], text: str, carry: list[str] = ()) -> DataFrame:
    """keys, the ``carry`` columns (longs, constant in a key) and ``vector``
    (array of 8 + 1 + 32 longs) of each text of ``df``."""
    lines = df.select(*keys, *carry, F.explode(F.split(F.col(text), "\n")).alias("_p"))
    hashed = lines.select(*keys, *carry, "_p", *(F.xxhash64(F.lit(s), "_p").alias(f"_h{s}") for s in range(EQ_LANES // 2)))
    pieces = hashed.select(*keys, *carry, *(f"_h{s}" for s in range(EQ_LANES // 2)),
                           F.posexplode_outer(F.regexp_extract_all("_p", F.lit(PIECE), F.lit(0))).alias("_i", "_piece"))
    sums = _vector_sums([F.col(f"_h{s}") for s in range(EQ_LANES // 2)], F.coalesce(F.col("_i"), F.lit(0)) == 0,
                        F.col("_piece"))
    out = pieces.groupBy(*keys).agg(*(F.max(c).alias(c) for c in carry), *(s.alias(f"_s{i}") for i, s in enumerate(sums)))
    words = [F.col(f"_s{i}") if i > EQ_LANES else F.pmod(F.col(f"_s{i}"), F.lit(MOD)) for i in range(len(sums))]
    return out.select(*keys, *carry, F.array(*words).alias("vector"))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Vector of the multiset union (sign 1) or difference (-1), lane by
    lane modulo 2^32."""
    def lane(x: Column, y: Column) -> Column:
        return F.pmod(x + y * F.lit(sign), F.lit(MOD))

    def word(k: int) -> Column:
        x, y = a[k], b[k]
        if k <= EQ_LANES:
            return lane(x, y)
        high = lane(F.shiftrightunsigned(x, 32), F.shiftrightunsigned(y, 32))
        return F.shiftleft(high, 32).bitwiseOR(lane(x.bitwiseAND(MOD - 1), y.bitwiseAND(MOD - 1)))

    return F.array(*(word(k) for k in range(EQ_LANES + 1 + SIGN_WORDS)))


def fingerprint(vector: Column) -> Column:
    """Hex string of a vector: 8 digits a lane."""
    digits = F.transform(vector, lambda w, i: F.lpad(F.lower(F.hex(w)), F.when(i <= EQ_LANES, 8).otherwise(16), F.lit("0")))
    return F.array_join(digits, "")


def signs(vector: Column) -> Column:
    """The 64 sums of random signs of a vector, as doubles."""
    words, n = F.slice(vector, EQ_LANES + 2, SIGN_WORDS), vector[EQ_LANES]
    low = F.transform(words, lambda w: (w.bitwiseAND(MOD - 1) * 2 - n).cast("double"))
    high = F.transform(words, lambda w: (F.shiftrightunsigned(w, 32) * 2 - n).cast("double"))
    return F.concat(low, high)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: twice the inner product of the sign lanes over the sum of their
    squares (1 for equal vectors, near 0 for texts that share no piece)."""
    def inner(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    x, y = signs(a), signs(b)
    norms = inner(x, x) + inner(y, y)
    return (F.when(a == b, 1.0).when(norms == 0, 0.0)
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * inner(x, y) / norms))))


KEY = ["id_null", "id"]  # a document's key: is its id null, and the id (zero or empty if null)


def _succession(ids: DataFrame) -> DataFrame:
    """Distinct keys with their columns and ``next`` and ``prev`` (structs of
    key and quarter), cyclically in ascending order, null first: range
    partitions are sorted on their own, and only their ends, one row for each
    range partition, are put together on the driver."""
    spark = ids.sparkSession
    by = [F.col("id_null").desc(), F.col("id").asc()]
    cut = ids.repartitionByRange(shuffle_width(spark), *by).withColumn("part", F.spark_partition_id())
    cut = written(cut, "succession")
    me = F.struct(*KEY, "quarter")
    rank = F.struct(~F.col("id_null"), F.col("id"))
    ends = cut.groupBy("part").agg(F.min_by(me, rank).alias("first"), F.max_by(me, rank).alias("last"))
    rows = sorted(ends.collect(), key=lambda r: r["part"])
    around = [(r["part"], rows[(k + 1) % len(rows)]["first"], rows[k - 1]["last"]) for k, r in enumerate(rows)]
    kind = cut.select(me.alias("x")).schema["x"].dataType.simpleString()
    edges = spark.createDataFrame(around, f"part int, after {kind}, before {kind}")
    order = Window.partitionBy("part").orderBy(*by)
    near = cut.select("*", F.lead(me).over(order).alias("next"), F.lag(me).over(order).alias("prev"))
    near = near.join(F.broadcast(edges), "part")  # as many rows as range partitions
    return near.select(*ids.columns, F.coalesce("next", "after").alias("next"), F.coalesce("prev", "before").alias("prev"))


def edit_likeness(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every whole text and its edited text.

    The edited text is the text with its last floor(n_chars/4) code points
    replaced by the first as many (or all) of the next document's, by
    ascending id_col (a number or string); after the last comes the first,
    and a lone document follows itself. Returns id_col, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    A null text counts as empty; null ids sort first. Rows that share an id
    each get a row; their next document is that of the next distinct id, and
    of several rows there the one with the smallest text hash (then text). An
    empty table gives an empty result; other columns are ignored. Texts are
    shuffled once by id (plus a quarter as prefixes); the order of ids is
    found on ids alone. The vectors need no further shuffle: they are summed
    where the texts already lie.
    """
    zero = F.lit("0").cast(df.schema[id_col].dataType)
    docs = df.select(F.col(id_col).isNull().alias("id_null"), F.coalesce(F.col(id_col), zero).alias("id"),
                     text_or_empty(text_col).alias("text"))
    quarter = F.floor(F.length("text") / 4).cast("int")
    ids = docs.groupBy(*KEY).agg(F.max(quarter).alias("quarter"), F.count("*").alias("rows"))
    chain = written(_succession(ids), "chain")
    repeated = (chain.agg(F.max("rows")).first()[0] or 0) > 1

    def one_each(frame: DataFrame, *order: str) -> DataFrame:
        if not repeated:
            return frame
        first = Window.partitionBy(*KEY).orderBy(*order)
        return frame.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")

    def renamed(to: str) -> list[Column]:
        return [F.col(f"{to}.{c}").alias(c) for c in KEY]

    prefixes = (one_each(docs.withColumn("h", F.xxhash64("text")), "h", "text")
                .join(chain.select(*KEY, "prev"), KEY)
                .select(*renamed("prev"), F.struct(*KEY).alias("next"),
                        F.expr("substring(text, 1, prev.quarter)").alias("prefix")))
    sha = F.sha2("edited", 256)
    carry = ["n_chars", "text_hash", *(f"sha{i}" for i in range(8))]
    both = (docs.join(prefixes, KEY)
            .select(*KEY, "next", "text", F.length("text").cast("long").alias("n_chars"), quarter.alias("q"), "prefix")
            .withColumn("edited", F.expr("concat(substring(text, 1, cast(n_chars - q as int)), substring(prefix, 1, q))"))
            .select(*KEY, F.monotonically_increasing_id().alias("row"), F.col("next.id_null").alias("next_null"),
                    F.col("next.id").alias("next_id"), "n_chars", F.xxhash64("text").alias("text_hash"),
                    *(F.conv(F.substring(sha, 8 * i + 1, 8), 16, 10).cast("long").alias(f"sha{i}") for i in range(8)),
                    "text", "edited"))
    keys = [*KEY, "row", "next_null", "next_id"]
    two = F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("body")),
                  F.struct(F.lit(1).alias("kind"), F.col("edited").alias("body")))
    each = both.select(*keys, *carry, F.explode(two).alias("t")).select(*keys, *carry, "t.kind", "t.body")
    vec = written(vectors(each, [*keys, "kind"], "body", carry), "vectors")
    own = vec.where("kind = 0").drop("kind")
    edited = vec.where("kind = 1").select(*KEY, "row", F.col("vector").alias("e_vector"))
    after = (one_each(own.select(*KEY, "text_hash", "vector"), "text_hash")
             .select(F.col("id_null").alias("next_null"), F.col("id").alias("next_id"), F.col("vector").alias("a_vector")))
    out = own.join(edited, [*KEY, "row"]).join(after, ["next_null", "next_id"])
    v, e, a = F.col("vector"), F.col("e_vector"), F.col("a_vector")
    return out.select(F.when(~F.col("id_null"), F.col("id")).alias(id_col), "n_chars",
                      F.concat(*(F.lpad(F.lower(F.hex(f"sha{i}")), 8, "0") for i in range(8))).alias("edited_sha256"),
                      fingerprint(v).alias("fingerprint"), fingerprint(e).alias("edited_fingerprint"),
                      likeness(v, e).alias("near_edited"), likeness(v, a).alias("near_next"))

"""Keyword exclusion with long lists equals the single alternation."""

import random
import time

from pyspark.sql import functions as F

from wtprof.operators import filters


def kept(f, df, exc, targets):
    return sorted(map(tuple, f(df, exc, targets).collect()), key=repr)


def test_many_equals_few(spark):
    rnd = random.Random(3)
    values = ["".join(rnd.choice("abc/.? é") for _ in range(rnd.randint(0, 14))) for _ in range(400)] + [None, "", "a+b", "x🙂y"] * 2
    df = spark.createDataFrame([(k, v, rnd.choice(values), f"v{k % 3}") for k, v in enumerate(values)], "k int, u string, w string, extra string")
    keywords = ["abca", "é", "cc", "a.c", "b+a", "🙂y", "abcabcabcabcabc", "not there", "/ab", None]
    for chosen in (keywords, ["abc"], ["", "abc"], [""], [None], [], ["(ab|ba)c$", "^c"]):
        exc = spark.createDataFrame([("u", x) for x in chosen] + [("w", x) for x in chosen[:4]] + [("other", "a")], "selectcolumn string, keyword string")
        many = kept(filters.exclude_keywords_many, df, exc, ["u", "w", "extra"])
        assert many == kept(filters.exclude_keywords, df, exc, ["u", "w", "extra"])
    out = filters.exclude_keywords_many(df, exc, ["u"])
    assert out.columns == df.columns
    assert filters.exclude_keywords_many(df.where("false"), exc, ["u"]).count() == 0


def test_a_hundred_thousand_keywords(spark):
    """One value in ten holds a keyword; all keywords share their common grams."""
    exc = spark.range(100_000).select(F.lit("q").alias("selectcolumn"), F.concat(F.lit("http-key-"), F.col("id") * 7, F.lit("z")).alias("keyword"))
    df = spark.range(20_000).select("id", F.when(F.col("id") % 10 == 0, F.concat(F.lit("/a?http-key-"), F.col("id") % 700 * 7, F.lit("z&b")))
                                    .otherwise(F.concat(F.lit("/a?http-key-"), F.col("id") * 7 + 1, F.lit("x"))).alias("q"))
    t = time.time()
    got = filters.exclude_keywords_many(df, exc, ["q"])
    assert got.count() == 18_000 and got.where("id % 10 = 0").count() == 0
    assert time.time() - t < 120

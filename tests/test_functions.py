"""Column functions on tiny hand-made frames: edge cases."""

import datetime as dt

from pyspark.sql import functions as F

from wtprof.functions import arrays as A
from wtprof.functions import text as T
from wtprof.functions import timeutil as TU
from wtprof.functions.nulls import cast_roles, fill_nulls


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_url_decode_keeps_bad_escapes_and_plus(spark):
    assert one(spark, T.url_decode_lenient("s"), "a+b%zz%") == "a+b%zz%"
    assert one(spark, T.url_decode_lenient("s"), "%3Cscript%3E%2F") == "<script>/"
    assert one(spark, T.url_decode_lenient("s"), "%2") == "%2"
    assert one(spark, T.url_decode_lenient("s"), None) is None


def test_clean_text_pipeline(spark):
    # decode, /.. marked, symbols and digits become spaces
    assert one(spark, T.clean_text("s"), "/..%2F../etc/passwd%zz") == \
        " pathsearcherdetected  pathsearcherdetected  etc passwd zz"
    assert one(spark, T.strip_symbols("s"), "a-b_c=1") == "a b c  "


def test_tokenize_and_stop_words(spark):
    toks = one(spark, T.remove_stop_words(T.tokenize("s")), "The board ID écrit x_y a Page naïve 42")
    assert toks == ["the", "écrit", "x_y", "naïve", "42"]
    assert one(spark, T.tokenize("s"), None) == []


def test_ngrams_short_inputs(spark):
    g = lambda v: one(spark, T.ngrams(F.col("a"), 1, 2), v, "a array<string>")
    assert g([]) == []
    assert g(["a"]) == ["a"]  # sequence(1, 0) trap: no bigram
    assert g(["a", "b", "c"]) == ["a", "b", "c", "a b", "b c"]


def test_remove_punctuation(spark):
    assert one(spark, T.remove_punctuation("s"), "a!b\"c#d$%&'()*+,-./:;<=>?@[\\]^_`{|}~é") == "abcdé"


def test_time_bucket(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 3, 10, 7, 59),), (None,)], "t timestamp_ntz")
    r = df.select(TU.time_bucket("t", "5 minutes").alias("a"), TU.time_bucket("t", "1 week").alias("w"),
                  TU.time_bucket("t", "1 month").alias("m"), TU.time_bucket("t", "2 days").alias("d")).collect()
    assert r[0]["a"] == dt.datetime(2024, 1, 3, 10, 5)
    assert r[0]["w"] == dt.datetime(2024, 1, 1)  # Monday
    assert r[0]["m"] == dt.datetime(2024, 1, 1)
    assert r[0]["d"] == dt.datetime(2024, 1, 2)  # day 19724 since the epoch: even
    assert r[1]["a"] is None  # null rows are kept, not dropped


def test_cron_and_delta(spark):
    assert one(spark, TU.cron_bucket("s"), "*/15 * * * *") == "15 minutes"
    assert one(spark, TU.cron_bucket("s"), "0 0 */4 * *") == "quarter"
    assert one(spark, TU.cron_bucket("s"), "not a cron") == "hour"
    assert one(spark, TU.cron_bucket("s"), None) == "hour"
    assert one(spark, TU.parse_delta_seconds("s"), " hours = 2 ") == 7200
    assert one(spark, TU.parse_delta_seconds("s"), "years=1") == 86400
    assert one(spark, TU.parse_delta_seconds("s"), "days=x") == 86400


def test_arrays(spark):
    sch = "a array<double>"
    assert one(spark, A.array_first_above("a"), [0.1, 0.2], sch) == -1
    assert one(spark, A.array_first_above("a"), [0.1, 0.7, 0.9], sch) == 1
    assert one(spark, A.array_argmax("a"), [0.3, 0.9, 0.9], sch) == 1  # first of ties
    assert one(spark, A.relu_rescale("a"), [-1.0, -2.0], sch) == [0.0, 0.0]
    assert one(spark, A.relu_rescale("a"), [-1.0, 2.0, 1.0], sch) == [0.0, 1.0, 0.5]
    assert one(spark, A.zscore_to_byte("a"), [1.0, 1.0], sch) == [127, 127]


def test_fill_nulls_and_casts(spark):
    df = spark.createDataFrame([(None, None, None, None)], "n int, s string, c int, f double")
    r = fill_nulls(df, number=["n"], string=["s"], category=["c"], feature=["f"]).first()
    assert (r["n"], r["s"], r["c"], r["f"]) == (-1, "-", "empty", 0.0)
    r = cast_roles(spark.createDataFrame([("12x", "3")], "a string, b string"), {"a": "int", "b": "int"}).first()
    assert r["a"] is None and r["b"] == 3

"""Table layout (B2): bucketed tables co-locate joins (no shuffle)."""

import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from wtprof.session import scratch_path
from wtprof.sources import ddl as B
from wtprof.sources.tables import http_log


def test_bucketed_tables_join_without_exchange(spark):
    log = http_log(spark, SF_SMALL)
    a = log.groupBy("src_ip", "dst_ip").agg(F.count(F.lit(1)).alias("n"))
    b = log.groupBy("src_ip", "dst_ip").agg(F.count_distinct("hash").alias("k"))
    tag = uuid.uuid4().hex[:8]
    ta = B.create_table(spark, a, f"wtprof_ba_{tag}", scratch_path(spark, f"ba_{tag}"),
                        order_by=["src_ip", "dst_ip"], bucket_by=(4, ["src_ip", "dst_ip"]))
    tb = B.create_table(spark, b, f"wtprof_bb_{tag}", scratch_path(spark, f"bb_{tag}"),
                        order_by=["src_ip", "dst_ip"], bucket_by=(4, ["src_ip", "dst_ip"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force a shuffle-based join
    try:
        j = ta.join(tb, ["src_ip", "dst_ip"])
        p = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in p and "Exchange" not in p
        assert j.count() == a.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_create_table_refuses_existing(spark):
    tag = uuid.uuid4().hex[:8]
    d = spark.range(3)
    B.create_table(spark, d, f"wtprof_t_{tag}", scratch_path(spark, f"t_{tag}"))
    try:
        B.create_table(spark, d, f"wtprof_t_{tag}", scratch_path(spark, f"t2_{tag}"))
        raise AssertionError("expected a refusal")
    except ValueError:
        pass


def test_type_map():
    assert B.spark_type("Nullable(UInt8)") == "smallint"
    assert B.spark_type("Array(LowCardinality(String))") == "array<string>"
    assert B.spark_type("Decimal(10, 2)") == "decimal(10,2)"
    assert B.spark_type("Map(String, Array(Int64))") == "map<string,array<bigint>>"
    assert B.check_columns([("ok_name1", "DateTime64(3)")])
    assert not B.check_columns([("bad-name", "String")])
    assert not B.check_columns([("x", "NoSuchType")])

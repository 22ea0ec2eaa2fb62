"""Physical-plan properties the scale design relies on."""

import __spark_entry__ as E
from conftest import SF_SMALL

Q = E.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_range_reaches_scan(spark):
    p = plan(Q["time_range"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(Q["session_text"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in p
    assert "ReadSchema: struct<page_id:bigint,url:string>" in p  # html pruned


def test_sessions_aggregate_partially_before_shuffle(spark):
    p = plan(Q["session_text_labeled"](spark, SF_SMALL))
    assert "partial_collect_set" in p


def test_per_class_cap_limits_before_shuffle(spark):
    assert "WindowGroupLimit" in plan(Q["limit_per_class"](spark, SF_SMALL))


def test_vocabulary_join_is_broadcast(spark):
    p = plan(Q["tfidf_sessions"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "BroadcastExchange" in p


def test_class_ranks_are_salted(spark):
    p = plan(Q["oversample_to_max"](spark, SF_SMALL))
    assert "windowspecdefinition(hash" in p and "_b" in p


def test_fixture_join_broadcasts_the_page_side(spark):
    p = plan(Q["session_text"](spark, SF_SMALL))
    assert "BuildRight" in p  # pages (right side) built, log streamed

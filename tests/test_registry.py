"""Every registered query with a SQL twin matches DuckDB on sf0.001."""

import pytest

import __spark_entry__ as E
from helpers import same_rows

SQL = E.oracle_sql()
QS = E.queries()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"lgtime", "src_ip", "dst_ip", "label", "agent", "query"} == set(df.columns)


def test_every_sql_has_builder():
    assert set(SQL) <= set(QS)


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def scalable_plan(df):
    """No pairs of all rows, no nested-loop join, no row-at-a-time Python."""
    qe = df._jdf.queryExecution()
    txt = qe.executedPlan().toString() + qe.optimizedPlan().toString()
    assert not [f for f in FORBIDDEN if f in txt], txt[:2000]
    return df


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, duck, name):
    from conftest import SF_SMALL
    same_rows(scalable_plan(QS[name](spark, SF_SMALL)), duck.sql(SQL[name]))


@pytest.mark.parametrize("name", sorted(n for n in set(QS) - set(SQL) if n != "pipeline" and not n.startswith("op")))
def test_rows_only_runs(spark, name):
    from conftest import SF_SMALL
    df = scalable_plan(QS[name](spark, SF_SMALL))
    assert len(set(df.columns)) == len(df.columns)
    df.write.format("noop").mode("overwrite").save()  # every column is computed

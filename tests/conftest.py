import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from wtprof.session import checkpoint_dir, get_spark
    s = get_spark("local[4]", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from wtprof.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con

import datetime as dt
import decimal
import math


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        return None if math.isnan(f) else (round(f, 6) or 0.0)
    if isinstance(v, int):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def same_rows(spark_df, duck_rel):
    """Order-insensitive equality of a Spark DataFrame and a DuckDB relation."""
    sn, dn = spark_df.columns, duck_rel.columns
    assert sorted(sn) == sorted(dn), (sn, dn)
    def rows(names, rs):
        idx = sorted(range(len(names)), key=lambda i: names[i])
        return sorted((tuple(norm(r[i]) for i in idx) for r in rs), key=repr)
    a, b = rows(sn, spark_df.collect()), rows(dn, duck_rel.fetchall())
    assert len(a) == len(b), (len(a), len(b))
    assert a == b
    return len(a)

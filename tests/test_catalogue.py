import math
from pathlib import Path

import duckdb
import pytest

from vanquarry.plans import catalogue, more  # noqa: F401


def norm(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)[:10]
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return v


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, sf, name):
    df = catalogue.queries()[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in columns) for r in df.collect()), key=repr)
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert len(set(columns)) == len(columns)
        return
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = con.sql(sql)
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert got == sorted((tuple(norm(r[i]) for i in at) for r in want.fetchall()), key=repr)

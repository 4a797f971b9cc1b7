"""Every query with SQL gives the rows of its SQL on the smallest tables."""

import glob
import math
import os

import pytest

DIR = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def names():
    from sporeline import catalog

    return sorted(set(catalog.queries()) & set(catalog.oracle_sql()))


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
@pytest.mark.parametrize("name", names())
def test_query_equals_sql(spark, name):
    from sporeline import catalog

    con = duckdb.connect()
    for p in glob.glob(f"{DIR}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    df = catalog.queries()[name](spark, DIR)
    cols = sorted(df.columns)
    rel = con.sql(catalog.oracle_sql()[name])
    assert cols == sorted(rel.columns)
    got = sorted(([plain(x) for x in r] for r in df.select(*cols).collect()), key=repr)
    want = sorted(([plain(x) for x in r] for r in rel.project(", ".join(f'"{c}"' for c in cols)).fetchall()), key=repr)
    assert got == want

"""Every registered query against its DuckDB SQL on the smallest tables."""

import datetime
import decimal
import glob
import os

import duckdb
import pytest

from graylane import catalog


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return float(f"{float(v):.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    return v


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf, con, name):
    got = catalog.QUERIES[name](spark, sf)
    rows = sorted((tuple(plain(v) for v in r) for r in got.select(*sorted(got.columns)).collect()), key=repr)
    assert rows or name == "ambiguous_winners"  # no ties in the smallest table
    if name in catalog.ORACLES:
        want = con.sql(catalog.ORACLES[name])
        assert sorted(want.columns) == sorted(got.columns)
        cols = ", ".join(f'"{c}"' for c in sorted(want.columns))
        assert sorted((tuple(plain(v) for v in r) for r in want.select(cols).fetchall()), key=repr) == rows


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["n_name", "status", "orders", "net"] and df.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

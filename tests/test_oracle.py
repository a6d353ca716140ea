"""Every registered query of the library against its SQL on DuckDB; those without SQL must run."""

import decimal
import math
import os

import duckdb
import pytest

from gridlens import registry
from gridlens.plans.views import BASE

NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in BASE:
        path = f"{sf_dir}/{t}.parquet"
        c.sql(f"create view {t} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return c


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float | decimal.Decimal):
        return "nan" if math.isnan(v) else float(f"{float(v):.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return tuple(map(norm, v)) if isinstance(v, list | tuple) else v


def rows(cursor):
    return sorted((tuple(map(norm, r)) for r in cursor), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, sf_dir, name):
    df = registry.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = rows(df.select(*cols).collect())
    if (sql := registry.oracle_sql().get(name)) is None:
        assert cols
        return
    want = con.sql(f"select * from ({sql}) q")
    assert sorted(want.columns) == cols
    assert got == rows(con.sql(f"select {', '.join(f'"{c}"' for c in cols)} from ({sql}) q").fetchall())


def test_registry_needs_no_session():
    assert set(registry.oracle_sql()) <= set(NAMES) and len(NAMES) > 240

"""Every registered query against its DuckDB SQL on the smallest tables; those without SQL must return rows."""

import datetime
import decimal
import math

import duckdb
import pytest
from conftest import SF
from siltstone import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in catalog.ORACLES:
        assert rows
        return
    want = duck.sql(catalog.ORACLES[name])
    columns = sorted(want.columns)
    assert columns == sorted(df.columns)
    at = [want.columns.index(c) for c in columns]
    got = sorted((tuple(plain(r[c]) for c in columns) for r in rows), key=repr)
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_every_function_has_a_docstring_or_a_plain_name():
    assert len(catalog.QUERIES) >= 120

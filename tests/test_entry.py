"""Every query of this side beside the SQL that expresses it, through the entry point."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from tidewatch.plans import catalog

DATA = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6g}"
    if isinstance(value, list | tuple):
        return str([plain(v) for v in value])
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())


def rows_by_sql(con, sql):
    got = con.execute(sql)
    names = [x[0] for x in got.description]
    cols = sorted(names)
    return cols, sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in got.fetchall())


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_its_sql():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(catalog.QUERIES) <= set(queries) and set(sql) <= set(queries)
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert rows_of(catalog.QUERIES[name](spark, DATA)) == rows_by_sql(con, catalog.ORACLE_SQL[name])


def test_flagship(spark):
    assert __spark_entry__.entry(spark).count() == 20

"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as contract
from wearline.plans.queries import ORACLES, QUERIES

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not TESTDATA.is_dir(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in TESTDATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def ordered(rows):
    return sorted((tuple(map(plain, row)) for row in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, str(TESTDATA))
    expected = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types), strict=True))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    found = df.select(*expected.columns).collect()
    assert ordered(found) == ordered(expected.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() == 1000


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()

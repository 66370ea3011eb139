"""Every registered query against its SQL, and no query may plan as a nested loop or a cross product."""

import datetime
import decimal
import os

import duckdb
import pytest

from listingflow.plans import all_queries
from listingflow.plans.catalog import TABLES

FOLDER = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = all_queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return int(value) if value == int(value) else value
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def _table(names, rows):
    order = [names.index(n) for n in sorted(names)]
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    expected = duck.execute(ORACLES[name])
    names = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(names)
    assert _table(df.columns, [tuple(r) for r in df.collect()]) == _table(names, expected.fetchall())

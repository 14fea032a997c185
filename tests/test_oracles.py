"""Every registered query against its SQL oracle on the smallest tables."""

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from terrace.oracles import ORACLES
from terrace.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}") + 0.0
    if isinstance(value, decimal.Decimal):
        return str(value.normalize() + 0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    got = df.collect()
    res = duck.execute(E.oracle_sql()[name])
    exp_cols = [d[0] for d in res.description]
    exp = res.fetchall()
    assert sorted(df.columns) == sorted(exp_cols)
    assert len(got) == len(exp)
    assert _bag(df.columns, [tuple(r) for r in got]) == _bag(exp_cols, exp)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "order_key"

"""Spark queries vs their DuckDB oracle text on sf0.001 (a representative subset)."""

import datetime as dt
import decimal
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF001

SUBSET = ["kw_token", "kw_token_large", "sql_text_payments", "legs_debit", "src_wholetext", "ledger_ids", "amt_food", "amt_cars_v1", "mart_payments", "mart_payments_v1",
          "mart_account_sql", "mart_info"]


def _norm(v):
    if isinstance(v, (decimal.Decimal, float)):
        return round(float(v), 2)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["customer", "orders", "lineitem", "part", "events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SUBSET)
def test_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF001)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    s = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    d = Counter(tuple(_norm(v) for v in (dict(zip(rel.columns, row))[c] for c in cols))
                for row in rel.fetchall())
    assert s == d


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["AccountId", "ClientId", "PaymentAmt", "EnrollmentAmt", "TaxAmt", "ClearAmt",
                          "CarsAmt", "FoodAmt", "FLAmt", "CutoffDt"]

"""One-pass plan vs the reference-shaped plan (kernel ⟕ seven measures)."""

import decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom import fixtures
from ledgerloom.operators import payments_mart
from naive import naive_payments_mart, naive_payments_mart_v1
from ledgerloom.operators.rates import latest_per_currency, latest_per_currency_ranked

# At sf0.001, from the DuckDB text: rows, rows with ClientId, sums.
EXPECTED = {
    "frame": (5881, 4669, ["19811567397.85", "19811567397.85", "3587386909.85", "3875787503.31",
                           "15102381207.75", "7443672196.85", "7322537742.25"]),
    "sql": (4669, 4669, ["7347465051.92", "5641179331.08", "1341466376.56", "1069208034.69",
                         "6336798772.00", "1301019278.51", "2762002010.11"]),
}
MEASURES = ["PaymentAmt", "EnrollmentAmt", "TaxAmt", "ClearAmt", "CarsAmt", "FoodAmt", "FLAmt"]


@pytest.mark.parametrize("dialect", ["frame", "sql"])
def test_expected_shape(sf001_tables, dialect):
    m = payments_mart(sf001_tables, dialect)
    r = m.agg(F.count(F.lit(1)), F.count("ClientId"), *[F.sum(c) for c in MEASURES]).first()
    rows, with_client, sums = EXPECTED[dialect]
    assert (r[0], r[1]) == (rows, with_client)
    assert [str(v) for v in r[2:]] == sums


@pytest.mark.parametrize("dialect", ["frame", "sql"])
def test_one_pass_equals_naive(sf001_tables, dialect):
    a = payments_mart(sf001_tables, dialect)
    b = naive_payments_mart(sf001_tables, dialect).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_one_pass_equals_naive_v1(sf001_tables):
    a = payments_mart(sf001_tables, "sql_v1")
    b = naive_payments_mart_v1(sf001_tables).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rank_and_aggregate_rate_reduction_agree(spark):
    r = fixtures.rates(spark)
    a, b = latest_per_currency(r), latest_per_currency_ranked(r).select(*r.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert {x["Currency"]: x["Rate"] for x in a.collect()} == {"USD": "82,75", "EU": "90,10", "RUB": "1"}


def test_partition_count_independence(spark, sf001_tables):
    base = payments_mart(sf001_tables, "frame")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        other = payments_mart(sf001_tables, "frame")
        assert base.exceptAll(other).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_sql_text_chain_equals_sql_dialect(spark, sf001_tables):
    from ledgerloom.operators import account_mart, info_mart
    from ledgerloom.plans.sql_chain import run_sql_marts

    marts = run_sql_marts(spark, sf001_tables)
    pay = payments_mart(sf001_tables, "sql")
    acc = account_mart(pay, sf001_tables, "sql")
    info = info_mart(acc, sf001_tables)
    for got, want in ((marts["payments"], pay), (marts["account"], acc), (marts["info"], info)):
        got = got.select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("dialect", ["frame", "sql_v1"])
def test_shuffle_joins_equal_broadcast_joins(spark, sf001_tables, dialect):
    want = sorted(map(tuple, payments_mart(sf001_tables, dialect).collect()), key=str)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sorted(map(tuple, payments_mart(sf001_tables, dialect).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == want


def test_sql_text_chain_with_a_distributed_dictionary(spark, sf001_tables, monkeypatch):
    from ledgerloom.operators import keyword_join
    from ledgerloom.plans.sql_chain import run_sql_marts

    want = run_sql_marts(spark, sf001_tables)["payments"].collect()
    monkeypatch.setattr(keyword_join, "COMPILE_MAX", 0)
    got = run_sql_marts(spark, sf001_tables)["payments"].collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)


def test_sql_text_chain_leaves_the_callers_views_alone(spark, sf001_tables):
    from ledgerloom.plans.sql_chain import run_sql_marts

    spark.range(3).createOrReplaceTempView("accounts")
    run_sql_marts(spark, sf001_tables)["payments"].collect()
    assert spark.table("accounts").columns == ["id"]
    spark.catalog.dropTempView("accounts")


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("dialect", ["frame", "sql", "text"])
def test_money_does_not_overflow(spark, ansi, dialect):
    """Sums beyond a long's cents are exact, with and without ANSI mode."""
    from ledger_builder import DAY, ledger, op

    from ledgerloom.plans.sql_chain import run_sql_marts

    ops = [op("A", "B", "99999999,99", f"x{i}") for i in range(18)]
    t = ledger(spark, ops, rates=[("RUB", "99999999,99", DAY)])
    want = decimal.Decimal("9999999998000000.00") * 18
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        mart = run_sql_marts(spark, t)["payments"] if dialect == "text" else payments_mart(t, dialect)
        rows = {r["AccountId"]: r for r in mart.collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert rows["A"]["PaymentAmt"] == rows["A"]["CarsAmt"] == rows["B"]["EnrollmentAmt"] == want

"""Invariants of the marts on the sf0.001 fixture."""

from pyspark.sql import functions as F

from ledgerloom.operators import account_mart, info_mart, payments_mart


def test_debits_equal_credits_when_orphans_kept(sf001_tables):
    m = payments_mart(sf001_tables, "frame")
    r = m.agg(F.sum("PaymentAmt"), F.sum("EnrollmentAmt")).first()
    assert r[0] == r[1]


def test_measure_bounds(sf001_tables):
    m = payments_mart(sf001_tables, "frame")
    bad = m.filter((F.col("TaxAmt") > F.col("PaymentAmt")) | (F.col("CarsAmt") > F.col("PaymentAmt"))
                   | (F.col("FLAmt") > F.col("PaymentAmt")) | (F.col("ClearAmt") > F.col("EnrollmentAmt"))
                   | (F.col("FoodAmt") > F.col("EnrollmentAmt")))
    assert bad.count() == 0


def test_info_total_equals_account_total_over_known_clients(sf001_tables):
    t = sf001_tables
    acc = account_mart(payments_mart(t, "frame"), t, "frame")
    info = info_mart(acc, t)
    known = acc.join(t.clients.select("ClientId"), "ClientId")
    assert info.agg(F.sum("TotalAmt")).first()[0] == known.agg(F.sum("TotalAmt")).first()[0]


def test_kernel_keys_unique(sf001_tables):
    for d in ("frame", "sql", "sql_v1"):
        m = payments_mart(sf001_tables, d)
        assert m.groupBy("AccountId", "CutoffDt").count().filter("count > 1").count() == 0

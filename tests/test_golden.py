"""Hand-made golden rows, one per edge case of SURVEY §2.12 / FIXTURES.md §3."""

from decimal import Decimal as Dec

import pytest
from ledger_builder import DAY, D, ledger, op, rows_by_key
from pyspark.sql import functions as F

from ledgerloom.functions.text import matches
from ledgerloom.operators import account_mart, payments_mart
from ledgerloom.schemas import DuplicateKeyError, amount_rejects, validate


def mart(spark, ops, dialect="frame", **kw):
    return rows_by_key(payments_mart(ledger(spark, ops, **kw), dialect))


def test_d1_newest_rate_used_even_for_older_operations(spark):
    m = mart(spark, [op("A", "B", "10,00", currency="USD", day=D(2019, 6, 1))])
    r = m[("A", D(2019, 6, 1))]
    assert r["PaymentAmt"] == Dec("30.00")
    assert r["TaxAmt"] == Dec("30.00")      # B is a 40702 account
    assert r["FLAmt"] == Dec("30.00")       # B belongs to a natural person


def test_d3_d19_duplicate_keys_raise(spark):
    t = ledger(spark, [op("A", "B", "1,00")],
               rates=[("USD", "2,00", D(2021, 1, 1)), ("USD", "2,50", D(2021, 1, 1))])
    with pytest.raises(DuplicateKeyError):
        validate(t)
    t = ledger(spark, [op("A", "B", "1,00")],
               accounts=[("A", "40817", "C1", D(2020, 1, 1)), ("A", "40702", "C2", D(2020, 1, 1))])
    with pytest.raises(DuplicateKeyError):
        validate(t)


def test_d4_orphans_kept_by_frame_dropped_by_sql(spark):
    ops = [op("A", "Z", "1,00")]
    frame = mart(spark, ops)
    assert frame[("Z", DAY)]["ClientId"] is None
    assert frame[("Z", DAY)]["EnrollmentAmt"] == Dec("1.00")
    assert ("Z", DAY) not in mart(spark, ops, "sql")


def test_d5_currency_without_rate_gives_zero_row(spark):
    m = mart(spark, [op("A", "B", "5,00", currency="GBP")])
    for key in [("A", DAY), ("B", DAY)]:
        assert all(m[key][c] == 0 for c in ["PaymentAmt", "EnrollmentAmt", "CarsAmt", "FLAmt"])


def test_d6_v1_keeps_nulls_frame_fills_zero(spark):
    ops = [op("A", "B", "1,00")]
    v1 = mart(spark, ops, "sql_v1")
    assert v1[("A", DAY)]["EnrollmentAmt"] is None
    assert mart(spark, ops)[("A", DAY)]["EnrollmentAmt"] == 0


def test_d7_v1_tests_own_account(spark):
    ops = [op("B", "A", "4,00")]             # B itself is the 40702 account
    assert mart(spark, ops, "sql_v1")[("B", DAY)]["TaxAmt"] == Dec("4.00")
    assert mart(spark, ops, "sql")[("B", DAY)]["TaxAmt"] == 0


def test_d8_regex_matches_stems_token_does_not(spark):
    df = spark.range(1).select(F.lit("покупка свинина, договор 5").alias("c"))
    regex, token = df.select(matches("c", ["вин"], "regex"), matches("c", ["вин"], "token")).first()
    assert regex is True and token is False
    ops = [op("A", "B", "3,00", comment="покупка свинина, договор 5")]
    assert mart(spark, ops)[("A", DAY)]["CarsAmt"] == 0
    assert mart(spark, ops, "sql")[("A", DAY)]["CarsAmt"] == Dec("3.00")


def test_d9_trailing_blank_word(spark):
    df = spark.range(1).select(F.lit("оплата автомобиль , договор").alias("c"),
                               F.lit("оплата автомобиль, договор").alias("d"))
    r = df.select(matches("c", ["автомобиль "], "token").alias("untrimmed_hit"),
                  matches("d", ["автомобиль "], "token").alias("untrimmed_miss"),
                  matches("d", ["автомобиль"], "regex").alias("trimmed")).first()
    assert r["untrimmed_hit"] and not r["untrimmed_miss"] and r["trimmed"]


def test_d10_double_backslash_word_matches_one_backslash(spark):
    word = "а\\\\м"                               # the file's two backslashes
    df = spark.range(1).select(F.lit("куплен а\\м, договор").alias("c"))
    r = df.select(matches("c", [word], "regex"), matches("c", [word], "contains")).first()
    assert r[0] is True and r[1] is True


def test_d12_null_comment_counts_as_vehicle_not_food(spark):
    m = mart(spark, [op("A", "P", "2,00", comment=None)])
    assert m[("A", DAY)]["CarsAmt"] == Dec("2.00")
    assert m[("P", DAY)]["FoodAmt"] == 0


def test_d13_empty_dictionary_matches_nothing(spark):
    m = mart(spark, [op("A", "B", "2,00", comment="купили хлеб, договор")],
             keywords=[(None, None)])
    assert m[("A", DAY)]["CarsAmt"] == Dec("2.00")
    assert m[("B", DAY)]["FoodAmt"] == 0


def test_d14_copies_double_payment_not_vehicles(spark):
    m = mart(spark, [op("A", "B", "10,00"), op("A", "B", "10,00")])
    r = m[("A", DAY)]
    assert r["PaymentAmt"] == Dec("20.00") and r["CarsAmt"] == Dec("10.00")
    assert r["TaxAmt"] == Dec("20.00") and r["FLAmt"] == Dec("20.00")


@pytest.mark.parametrize("dialect", ["frame", "sql"])
def test_d15_food_once_per_amount_whatever_the_comment(spark, dialect):
    m = mart(spark, [op("A", "P", "7,00", comment="купили хлеб, договор 1"),
                     op("A", "P", "7,00", comment="купили хлеб, договор 2")], dialect)
    assert m[("P", DAY)]["FoodAmt"] == Dec("7.00")
    assert m[("P", DAY)]["EnrollmentAmt"] == Dec("14.00")
    assert m[("A", DAY)]["CarsAmt"] == Dec("14.00")


def test_d17_v1_rounds_after_sum(spark):
    rates = [("USD", "1,55", D(2021, 1, 1)), ("RUB", "1", D(2021, 1, 1))]
    ops = [op("A", "B", "0,01", currency="USD", comment="x, 1"),
           op("A", "B", "0,01", currency="USD", comment="x, 2")]
    assert mart(spark, ops, rates=rates)[("A", DAY)]["PaymentAmt"] == Dec("0.04")
    assert mart(spark, ops, "sql_v1", rates=rates)[("A", DAY)]["PaymentAmt"] == Dec("0.03")


def test_d18_self_transfer_both_legs(spark):
    m = mart(spark, [op("A", "A", "10,00")])
    assert len(m) == 1
    assert m[("A", DAY)]["PaymentAmt"] == m[("A", DAY)]["EnrollmentAmt"] == Dec("10.00")


def test_d20_null_account_row_with_zero_measures(spark):
    m = mart(spark, [op(None, "B", "10,00")])
    r = m[(None, DAY)]
    assert r["ClientId"] is None and r["PaymentAmt"] == 0 and r["CarsAmt"] == 0
    assert m[("B", DAY)]["EnrollmentAmt"] == Dec("10.00")


def test_d21_bad_amounts_skipped_and_counted(spark):
    t = ledger(spark, [op("A", "B", "1,00"), op("A", "B", "1.234,56", comment="b"),
                       op("A", "B", "", comment="c"), op("A", "B", None, comment="d")])
    assert rows_by_key(payments_mart(t))[("A", DAY)]["PaymentAmt"] == Dec("1.00")
    r = amount_rejects(t.operations).first()
    assert (r["rejected_amounts"], r["operations"]) == (2, 4)


def test_d22_wide_totals_frame_keeps_sql_nulls(spark):
    t = ledger(spark, [op("A", "B", "99999999,99", comment="a, 1"),
                       op("A", "B", "99999999,99", comment="a, 2")])
    frame = rows_by_key(account_mart(payments_mart(t), t, "frame"))
    assert frame[("A", DAY)]["TotalAmt"] == Dec("199999999.98")
    sql = rows_by_key(account_mart(payments_mart(t, "sql"), t, "sql"))
    assert sql[("A", DAY)]["TotalAmt"] is None

"""As-of rates: newest rate not after the operation's date."""

import datetime as dt
import decimal
import random

from ledger_builder import RATES_SCHEMA, ledger, op

from ledgerloom.operators.rates import as_of_rates, convert_operations

D = dt.date


def brute(days, rates):
    out = {}
    for currency, day in days:
        known = [(d, decimal.Decimal(r.replace(",", ".")) if r and r.replace(",", "").isdigit() else None)
                 for c, r, d in rates if c == currency and c is not None and d is not None and day is not None and d <= day]
        if known:
            newest = max(d for d, _ in known)
            values = [r for d, r in known if d == newest and r is not None]
            out[(currency, day)] = (newest, max(values) if values else None)
    return out


def test_matches_brute_force(spark):
    rnd = random.Random(4)
    some = [D(2020, 1, 1) + dt.timedelta(rnd.randrange(900)) for _ in range(60)]
    days = [(c, d) for c in ("USD", "EU", "XX", None) for d in [*some, *some[:5], None, D(1990, 1, 1), D(2050, 6, 30)]]
    rates = [(rnd.choice(["USD", "EU", None]), rnd.choice(["1,50", "2,25", "10", "bad", None]), rnd.choice([*some, None]))
             for _ in range(150)] + [("USD", "9,00", D(2020, 5, 31)), ("USD", "8,00", D(2020, 6, 1))]
    got = as_of_rates(spark.createDataFrame(days, "Currency string, DateOp date"),
                      spark.createDataFrame(rates, RATES_SCHEMA)).collect()
    assert {(r[0], r[1]): (r[2], r[3]) for r in got} == brute(days, rates)
    assert len(got) == len(brute(days, rates))


def test_conversion_and_empty_tables(spark):
    rates = [("USD", "2,00", D(2021, 3, 1)), ("USD", "3,00", D(2021, 3, 2))]
    ops = [op("A", "B", "10,00", currency="USD", day=D(2021, 2, 28)), op("A", "B", "10,00", currency="USD"),
           op("A", "B", "10,00", currency="USD", day=D(2022, 1, 1)), op("A", "B", "1,00", currency="RUB"),
           op("A", "B", None, currency="USD"), op("A", "B", "1,00", currency=None), op("A", "B", "1,00", currency="USD", day=None)]
    t = ledger(spark, ops, rates=rates)
    got = sorted((str(r["DateOp"]), r["Amount"]) for r in convert_operations(t.operations, t.rates, "as_of").collect()
                 if r["Amount"] is not None)
    assert got == [("2021-03-01", decimal.Decimal("20.00")), ("2022-01-01", decimal.Decimal("30.00"))]
    none = spark.createDataFrame([], RATES_SCHEMA)
    assert convert_operations(t.operations, none, "as_of").count() == 0
    assert convert_operations(t.operations.limit(0), t.rates, "as_of").count() == 0


def test_no_range_join(spark):
    days = spark.createDataFrame([("USD", D(2021, 1, 1))], "Currency string, DateOp date")
    rates = spark.createDataFrame([("USD", "1", D(2020, 1, 1))], RATES_SCHEMA)
    plan = as_of_rates(days, rates)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Currency" in plan and "month" in plan

"""Random ledgers: the one-pass plan equals the reference-shaped plan.

Generated operations mix NULL keys, copies, self transfers, currencies
without a rate, malformed amounts and comments that hit or miss the
dictionaries in each matching mode.
"""

import datetime as dt

from hypothesis import HealthCheck, Phase, example, given, settings
from hypothesis import strategies as st
from ledger_builder import ledger

from ledgerloom.operators import payments_mart
from ledgerloom.plans.sql_chain import run_sql_marts
from naive import naive_payments_mart, naive_payments_mart_v1

ACCOUNTS = st.sampled_from(["A", "B", "P", "Z", None])
DAYS = st.sampled_from([dt.date(2021, 3, 1), dt.date(2021, 4, 1), None])
AMOUNTS = st.sampled_from(["1,00", "2,50", "10,00", "0,01", "1.234,56", "", None, "99999,99"])
CURRENCIES = st.sampled_from(["RUB", "USD", "GBP", None])
COMMENTS = st.sampled_from(["купили хлеб, договор 1", "купили хлеб, договор 2", "авто, 2",
                            "покупка свинина, 3", " сыр,", None, "x"])
OPS = st.lists(st.tuples(ACCOUNTS, ACCOUNTS, DAYS, AMOUNTS, CURRENCIES, COMMENTS), min_size=1, max_size=25)


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck),
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(ops=OPS)
@example(ops=[("A", "B", None, "1,00", "RUB", "x"), ("A", None, None, "1,00", "RUB", "x")])
def test_random_ledgers(spark, ops):
    t = ledger(spark, ops)
    for d in ("frame", "sql"):
        assert _same(payments_mart(t, d), naive_payments_mart(t, d)), d
    assert _same(run_sql_marts(spark, t)["payments"], naive_payments_mart(t, "sql"))
    assert _same(payments_mart(t, "sql_v1"), naive_payments_mart_v1(t))

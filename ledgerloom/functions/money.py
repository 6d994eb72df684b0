"""Amount parsing and currency conversion (FN1-FN6, PRJ5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import AMOUNT, MONEY, parse_decimal_comma


def converted(amount_text: Column | str, rate: Column | str) -> Column:
    """``round(amount * rate, 2)`` (HALF_UP) from a decimal-comma text and a parsed rate."""
    return F.round(product(amount_text, rate), 2)


def product(amount_text: Column | str, rate: Column | str) -> Column:
    """Unrounded ``amount * rate`` (rounded after summing in the first SQL query)."""
    rate = F.col(rate) if isinstance(rate, str) else rate
    return parse_decimal_comma(amount_text) * rate


def cents(c: Column | str) -> Column:
    """A converted amount as a long count of cents (below 10^18, so it fits)."""
    c = F.col(c) if isinstance(c, str) else c
    return (c * F.lit(100)).cast("long")


# Cents are summed as two longs, the multiples of SPLIT and the rest. Both sums stay in
# primitive arithmetic and hold for 9 * 10^10 rows of the largest amount in one group.
SPLIT = 10**8


def split_sums(condition: str, high: str, low: str, name: str) -> list[str]:
    """Aggregates ``name_h`` and ``name_l`` of the rows where the condition holds (SQL text)."""
    return [f"sum(CASE WHEN {condition} THEN {high} END) AS {name}_h",
            f"sum(CASE WHEN {condition} THEN {low} END) AS {name}_l"]


def joined_sum(name: str) -> str:
    """The exact decimal(38,2) of a split sum; NULL when it is (SQL text)."""
    return (f"CAST((CAST({name}_h AS decimal(20,0)) * CAST({SPLIT} AS decimal(9,0))"
            f" + CAST({name}_l AS decimal(20,0))) * 0.01BD AS decimal(38,2))")


def money(c: Column | str) -> Column:
    """Mart measure type: decimal(38,2)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(MONEY)


def narrow_money(c: Column | str) -> Column:
    """``cast(coalesce(x, 0) as decimal(10,2))`` with NULL on overflow (D22)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(0)).try_cast(AMOUNT)


def balance_code(account_num: Column | str) -> Column:
    """First five characters of an account number (balance-account code)."""
    c = F.col(account_num) if isinstance(account_num, str) else account_num
    return F.substring(c, 1, 5)


# Balance-account codes and the natural-person client type used by the marts
# (fixed values of the ledger's chart of accounts).
TAX_CODE = "40702"
CLEARING_CODE = "40802"
NATURAL_PERSON = "Ф"

"""Each payments measure on its own (AG1-AG7, AG11-AG13, JN5-JN10, SO3).

These are the measures as stand-alone operators, keyed by
(AccountId, CutoffDt); each runs only the jobs it needs. Operations and keys
with NULL account or date never match the kernel and are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import (CLEARING_CODE, NATURAL_PERSON, TAX_CODE, balance_code, money,
                               product)
from ..schemas import LedgerTables
from .dialects import Dialect, get_dialect
from .keyword_join import tag
from .rates import attach_rate, convert_operations


def _keyed(df: DataFrame, account: str) -> DataFrame:
    return df.filter(F.col(account).isNotNull() & F.col("DateOp").isNotNull())


def _sum_by(df: DataFrame, account: str, value: F.Column, name: str) -> DataFrame:
    return (_keyed(df, account)
            .groupBy(F.col(account).alias("AccountId"), F.col("DateOp").alias("CutoffDt"))
            .agg(money(F.sum(value)).alias(name)))


def converted_ops(tables: LedgerTables, dialect: str | Dialect = "frame") -> DataFrame:
    return convert_operations(tables.operations, tables.rates, get_dialect(dialect).rate_policy)


def _legs(conv: DataFrame, accounts: DataFrame, side: str) -> DataFrame:
    """Every operation with a key on that side has its kernel row, so the
    kernel is not joined back: operations ⟕ accounts gives the same rows."""
    own = accounts.select(F.col("AccountId").alias(side), "ClientId")
    return (_keyed(conv, side).join(own, side, "left")
            .select(F.col(side).alias("AccountId"), "ClientId", F.col("DateOp").alias("CutoffDt"),
                    "AccountDB", "AccountCR", "Amount", "Comment"))


def debit_legs(conv: DataFrame, accounts: DataFrame) -> DataFrame:
    """Kernel rows joined with the operations they pay from (JN5)."""
    return _legs(conv, accounts, "AccountDB")


def credit_legs(conv: DataFrame, accounts: DataFrame) -> DataFrame:
    """Kernel rows joined with the operations they receive (JN6)."""
    return _legs(conv, accounts, "AccountCR")


def payment(conv: DataFrame) -> DataFrame:
    return _sum_by(conv, "AccountDB", F.col("Amount"), "PaymentAmt")


def enrollment(conv: DataFrame) -> DataFrame:
    return _sum_by(conv, "AccountCR", F.col("Amount"), "EnrollmentAmt")


def _code_of(tables: LedgerTables, key: str) -> DataFrame:
    return tables.accounts.select(F.col("AccountId").alias(key),
                                  balance_code("AccountNum").alias(f"{key}_code"))


def _pair_sums(conv: DataFrame, own: str) -> DataFrame:
    """Amounts by (debit, credit, date) with a key on the ``own`` side: what meets a counterparty, in place of
    the operations. A hot account's operations are summed in the map tasks before the join."""
    return _keyed(conv, own).groupBy("AccountDB", "AccountCR", "DateOp").agg(F.sum("Amount").alias("Amount"))


def tax(conv: DataFrame, tables: LedgerTables) -> DataFrame:
    """Debit legs whose credit (counterparty) account is a 40702 account."""
    j = _pair_sums(conv, "AccountDB").join(_code_of(tables, "AccountCR").filter(F.col("AccountCR_code") == TAX_CODE), "AccountCR")
    return _sum_by(j, "AccountDB", F.col("Amount"), "TaxAmt")


def clear(conv: DataFrame, tables: LedgerTables) -> DataFrame:
    """Credit legs whose debit (counterparty) account is a 40802 account."""
    j = _pair_sums(conv, "AccountCR").join(_code_of(tables, "AccountDB").filter(F.col("AccountDB_code") == CLEARING_CODE), "AccountDB")
    return _sum_by(j, "AccountCR", F.col("Amount"), "ClearAmt")


def ops_not_matching(conv: DataFrame, tables: LedgerTables, d: Dialect) -> DataFrame:
    """``conv EXCEPT conv[vehicles]``: distinct rows whose comment does not match."""
    hit = tag(conv.distinct(), tables.keywords, {"List_1": d.cars_mode}, trim_comment=d.trim_comment,
              trim_words=d.trim_words)
    return hit.filter(~F.col("hit_List_1")).select(*conv.columns)


def cars(conv: DataFrame, tables: LedgerTables, d: Dialect) -> DataFrame:
    return _sum_by(ops_not_matching(conv, tables, d), "AccountDB", F.col("Amount"), "CarsAmt")


def food(conv: DataFrame, tables: LedgerTables, d: Dialect) -> DataFrame:
    hit = tag(conv, tables.keywords, {"List_2": d.food_mode}, trim_comment=d.trim_comment, trim_words=d.trim_words)
    rows = hit.filter("hit_List_2").select("AccountDB", "AccountCR", "DateOp", "Amount").distinct()
    return _sum_by(rows, "AccountCR", F.col("Amount"), "FoodAmt")


def natural_person(conv: DataFrame, tables: LedgerTables) -> DataFrame:
    """Debit legs whose counterparty account belongs to a natural person."""
    acc = tables.accounts.select(F.col("AccountId").alias("AccountCR"), F.col("ClientId").alias("cp_client"))
    persons = tables.clients.filter(F.col("Type") == NATURAL_PERSON).select(F.col("ClientId").alias("cp_client"))
    j = _pair_sums(conv, "AccountDB").join(acc.join(persons, "cp_client").select("AccountCR"), "AccountCR")
    return _sum_by(j, "AccountDB", F.col("Amount"), "FLAmt")


MEASURE = {
    "PaymentAmt": lambda conv, t, d: payment(conv),
    "EnrollmentAmt": lambda conv, t, d: enrollment(conv),
    "TaxAmt": lambda conv, t, d: tax(conv, t),
    "ClearAmt": lambda conv, t, d: clear(conv, t),
    "CarsAmt": cars,
    "FoodAmt": food,
    "FLAmt": lambda conv, t, d: natural_person(conv, t),
}


def measure(name: str, tables: LedgerTables, dialect: str | Dialect = "frame") -> DataFrame:
    """One measure by its mart column name."""
    d = get_dialect(dialect)
    return MEASURE[name](converted_ops(tables, d), tables, d)


# --- first SQL query (V1) -------------------------------------------------------------

def v1_ops(tables: LedgerTables) -> DataFrame:
    """Operations at the newest global rate with the unrounded converted amount."""
    return attach_rate(tables.operations, tables.rates, "latest_global").select(
        "AccountDB", "AccountCR", "DateOp", "Amount", "Comment",
        product("Amount", "Rate").alias("res"))


def _round_sum_by(df: DataFrame, account: str, name: str) -> DataFrame:
    return (_keyed(df, account)
            .groupBy(F.col(account).alias("AccountId"), F.col("DateOp").alias("CutoffDt"))
            .agg(money(F.round(F.sum("res"), 2)).alias(name)))


def payment_v1(tables: LedgerTables) -> DataFrame:
    """``round(sum(amount * rate), 2)`` of debit legs (AG12)."""
    return _round_sum_by(v1_ops(tables), "AccountDB", "PaymentAmt")


def tax_v1(tables: LedgerTables) -> DataFrame:
    """Debit legs of accounts whose *own* number is a 40702 account (AG13)."""
    j = v1_ops(tables).join(_code_of(tables, "AccountDB"), "AccountDB") \
        .filter(F.col("AccountDB_code") == TAX_CODE)
    return _round_sum_by(j, "AccountDB", "TaxAmt")


def clear_v1(tables: LedgerTables) -> DataFrame:
    """Credit legs of accounts whose *own* number is a 40802 account (AG13)."""
    j = v1_ops(tables).join(_code_of(tables, "AccountCR"), "AccountCR") \
        .filter(F.col("AccountCR_code") == CLEARING_CODE)
    return _round_sum_by(j, "AccountCR", "ClearAmt")


def cars_v1(tables: LedgerTables) -> DataFrame:
    """Distinct (amount, converted) of debit legs missing some vehicle word (AG11)."""
    hit = tag(v1_ops(tables), tables.keywords, {"List_1": "not_any"}).filter("hit_List_1")
    return _round_sum_by(hit.select("AccountDB", "DateOp", "Amount", "res").distinct(), "AccountDB", "CarsAmt")


def food_v1(tables: LedgerTables) -> DataFrame:
    """Distinct (amount, converted) of credit legs containing a food word (AG11)."""
    hit = tag(v1_ops(tables), tables.keywords, {"List_2": "contains"}).filter("hit_List_2")
    return _round_sum_by(hit.select("AccountCR", "DateOp", "Amount", "res").distinct(), "AccountCR", "FoodAmt")

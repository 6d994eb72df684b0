"""Account and client marts (CM5, CM6, JN13-JN15, AG8, PRJ4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import money, narrow_money
from ..schemas import LedgerTables
from .dialects import Dialect, get_dialect

ACCOUNT_COLUMNS = ["AccountId", "AccountNum", "DateOpen", "ClientId", "ClientName", "TotalAmt", "CutoffDt"]
INFO_COLUMNS = ["ClientId", "ClientName", "Type", "Form", "RegisterDate", "TotalAmt", "CutoffDt"]


def _total(d: Dialect) -> Column:
    if d.name == "frame":
        return money(F.col("PaymentAmt") + F.col("EnrollmentAmt"))
    return money(narrow_money("PaymentAmt") + narrow_money("EnrollmentAmt"))


def account_mart(payments: DataFrame, tables: LedgerTables, dialect: str | Dialect = "frame") -> DataFrame:
    """Payments mart + account number, open date and client name.

    ``frame``: left joins, ``TotalAmt = PaymentAmt + EnrollmentAmt``.
    ``sql``:   inner joins, each side cast to decimal(10,2) first (NULL on
               overflow, D22).
    """
    d = get_dialect(dialect)
    acc = tables.accounts.select("AccountId", "AccountNum", "DateOpen")
    cl = tables.clients.select("ClientId", "ClientName")
    how = "left" if d.name == "frame" else "inner"
    # Totals first: two measures would go through both joins for one.
    totals = payments.select("AccountId", "ClientId", _total(d).alias("TotalAmt"), "CutoffDt")
    return totals.join(acc, "AccountId", how).join(cl, "ClientId", how).select(*ACCOUNT_COLUMNS)


def info_mart(account: DataFrame, tables: LedgerTables) -> DataFrame:
    """Client totals per cutoff date; clients without activity are absent.

    Totals are pre-aggregated by (ClientId, CutoffDt) and only then joined
    with the client attributes (equivalent to grouping by all six columns
    because ClientId is unique in clients).
    """
    totals = (account.filter(F.col("ClientId").isNotNull())
              .groupBy("ClientId", "CutoffDt").agg(F.sum("TotalAmt").alias("TotalAmt")))
    cl = tables.clients.select("ClientId", "ClientName", "Type", "Form", "RegisterDate")
    return (totals.join(cl, "ClientId")
            .select("ClientId", "ClientName", "Type", "Form", "RegisterDate",
                    money("TotalAmt").alias("TotalAmt"), "CutoffDt"))


def info_from_payments(payments: DataFrame, dialect: str | Dialect = "frame") -> DataFrame:
    """(ClientId, CutoffDt, TotalAmt) rows for ``info_mart``, straight from payments.

    The account mart's attributes play no part in the rollup: accounts and clients are
    not joined for it. ``sql`` drops clients that are not known, which ``info_mart`` does too.
    """
    return payments.select("ClientId", "CutoffDt", _total(get_dialect(dialect)).alias("TotalAmt"))

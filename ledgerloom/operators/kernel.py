"""Ledger kernel: every (account, date) that has a leg (SO1-SO2, JN3-JN4, CM2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ledger_ids(operations: DataFrame) -> DataFrame:
    """Distinct (AccountId, CutoffDt) over debit and credit accounts.

    One scan: both accounts of an operation are exploded into two rows and
    de-duplicated with a map-side partial aggregate.
    """
    return (operations
            .select(F.explode(F.array("AccountDB", "AccountCR")).alias("AccountId"),
                    F.col("DateOp").alias("CutoffDt"))
            .distinct())


def ledger_kernel(operations: DataFrame, accounts: DataFrame,
                  keep_orphans: bool = True) -> DataFrame:
    """AccountId, ClientId, CutoffDt.

    ``keep_orphans`` (DataFrame dialect) keeps ids without an account with a
    NULL ClientId; the SQL dialects drop them (D4).
    """
    ids = ledger_ids(operations)
    acc = accounts.select("AccountId", "ClientId")
    return (ids.join(acc, "AccountId", "left" if keep_orphans else "inner")
            .select("AccountId", "ClientId", "CutoffDt"))

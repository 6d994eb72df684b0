"""ledgerloom: daily ledger data marts on PySpark DataFrames."""

from .operators import account_mart, info_mart, payments_mart
from .schemas import LedgerTables, validate

__all__ = ["LedgerTables", "account_mart", "info_mart", "payments_mart", "validate"]

from .dialects import DIALECTS, FRAME, SQL, SQL_V1, Dialect, get_dialect
from .kernel import ledger_ids, ledger_kernel
from .legs import MEASURES, PAYMENTS_COLUMNS, payments_mart, payments_mart_v1
from .marts import ACCOUNT_COLUMNS, INFO_COLUMNS, account_mart, info_from_payments, info_mart
from .rates import (attach_rate, convert_operations, latest_global, latest_per_currency,
                    latest_per_currency_ranked, reduce_rates)

__all__ = [
    "DIALECTS", "FRAME", "SQL", "SQL_V1", "Dialect", "get_dialect", "ledger_ids", "ledger_kernel",
    "MEASURES", "PAYMENTS_COLUMNS", "payments_mart", "payments_mart_v1",
    "ACCOUNT_COLUMNS", "INFO_COLUMNS", "account_mart", "info_from_payments", "info_mart", "attach_rate",
    "convert_operations", "latest_global", "latest_per_currency", "latest_per_currency_ranked",
    "reduce_rates",
]

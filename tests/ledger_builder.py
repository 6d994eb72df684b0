"""Small hand-made ledgers for golden tests."""

import datetime as dt

from pyspark.sql import types as T

from ledgerloom.fixtures import KEYWORDS_SCHEMA, RATES_SCHEMA
from ledgerloom.schemas import LedgerTables

D = dt.date
S = T.StringType()
OPS = T.StructType([T.StructField(c, S) for c in ["AccountDB", "AccountCR"]]
                   + [T.StructField("DateOp", T.DateType())]
                   + [T.StructField(c, S) for c in ["Amount", "Currency", "Comment"]])
ACCOUNTS = T.StructType([T.StructField(c, S) for c in ["AccountId", "AccountNum", "ClientId"]]
                        + [T.StructField("DateOpen", T.DateType())])
CLIENTS = T.StructType([T.StructField(c, S) for c in ["ClientId", "ClientName", "Type", "Form"]]
                       + [T.StructField("RegisterDate", T.DateType())])

DAY = D(2021, 3, 1)
DEFAULT_ACCOUNTS = [
    ("A", "40817000000000001", "C1", D(2020, 1, 1)),
    ("B", "40702000000000002", "C2", D(2020, 1, 1)),
    ("P", "40802000000000003", "C3", D(2020, 1, 1)),
]
DEFAULT_CLIENTS = [
    ("C1", "Alpha", "Ю", "LLC", D(2019, 1, 1)),
    ("C2", "Beta", "Ф", "IND", D(2019, 1, 1)),
    ("C3", "Gamma", "Ф", "IND", D(2019, 1, 1)),
]
DEFAULT_RATES = [("RUB", "1", D(2020, 1, 1)), ("RUB", "1", D(2021, 1, 1)),
                 ("USD", "2,00", D(2020, 1, 1)), ("USD", "3,00", D(2021, 1, 1))]
DEFAULT_KEYWORDS = [("авто", "хлеб"), ("вин", "сыр")]


def ledger(spark, ops, accounts=None, clients=None, rates=None, keywords=None) -> LedgerTables:
    return LedgerTables(
        clients=spark.createDataFrame(DEFAULT_CLIENTS if clients is None else clients, CLIENTS),
        accounts=spark.createDataFrame(DEFAULT_ACCOUNTS if accounts is None else accounts, ACCOUNTS),
        operations=spark.createDataFrame(ops, OPS),
        rates=spark.createDataFrame(DEFAULT_RATES if rates is None else rates, RATES_SCHEMA),
        keywords=spark.createDataFrame(DEFAULT_KEYWORDS if keywords is None else keywords, KEYWORDS_SCHEMA),
    )


def op(db, cr, amount, comment="оплата за товар, договор 1", currency="RUB", day=DAY):
    return (db, cr, day, amount, currency, comment)


def rows_by_key(df, key=("AccountId", "CutoffDt")):
    return {tuple(r[k] for k in key): r.asDict() for r in df.collect()}

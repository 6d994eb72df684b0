"""Input/output schemas of the ledger and the key checks the marts rely on."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column order of each raw CSV file. Every CSV column is read as a string;
# the date column of each table is its partition key once ingested.
RAW_COLUMNS = {
    "clients": ["ClientId", "ClientName", "Type", "Form", "RegisterDate"],
    "accounts": ["AccountId", "AccountNum", "ClientId", "DateOpen"],
    "operations": ["AccountDB", "AccountCR", "DateOp", "Amount", "Currency", "Comment"],
    "rates": ["Currency", "Rate", "RateDate"],
    "keywords": ["List_1", "List_2"],
}

# Partition key of each ingested table.
PARTITION_KEYS = {
    "clients": "RegisterDate",
    "accounts": "DateOpen",
    "operations": "DateOp",
    "rates": "RateDate",
}

# Money type of every mart measure: as wide as Spark's and DuckDB's decimals.
MONEY = T.DecimalType(38, 2)
# Parsed type of an amount or a rate.
AMOUNT = T.DecimalType(10, 2)


def string_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS[table]])


@dataclass(frozen=True)
class LedgerTables:
    """The five inputs of the marts (typed, see FIXTURES.md §1)."""

    clients: DataFrame
    accounts: DataFrame
    operations: DataFrame
    rates: DataFrame
    keywords: DataFrame

    def with_(self, **kw) -> "LedgerTables":
        return replace(self, **kw)


def parse_decimal_comma(c: Column | str, dtype: T.DecimalType = AMOUNT) -> Column:
    """``"1234,56"`` → 1234.56; malformed text → NULL (2.4 cast semantics)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.replace(c, F.lit(","), F.lit(".")).try_cast(dtype)


class DuplicateKeyError(ValueError):
    pass


def check_unique(df: DataFrame, keys: list[str], what: str) -> None:
    """Raise if ``keys`` repeat in ``df`` (D3 rates, D19 accounts).

    Distributed: only at most one offending key reaches the driver.
    """
    dup = (df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect())
    if dup:
        row = dup[0]
        raise DuplicateKeyError(
            f"{what}: key {tuple(row[k] for k in keys)} occurs {row['count']} times")


def amount_rejects(operations: DataFrame) -> DataFrame:
    """One row: number of operations whose Amount text does not parse (D21)."""
    bad = F.col("Amount").isNotNull() & parse_decimal_comma("Amount").isNull()
    return operations.agg(F.count_if(bad).alias("rejected_amounts"),
                          F.count(F.lit(1)).alias("operations"))


def validate(tables: LedgerTables) -> None:
    """Key checks every mart assumes (unique accounts, clients, rates)."""
    check_unique(tables.accounts, ["AccountId"], "accounts")
    check_unique(tables.clients, ["ClientId"], "clients")
    check_unique(tables.rates.filter(F.col("RateDate").isNotNull()), ["Currency", "RateDate"], "rates")

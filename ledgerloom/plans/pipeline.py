"""End-to-end flows (CM7 ingest, CM8 publish, CM10 mart chain).

Marts are chained through *written* tables: each mart is written, then the
next one reads it back. That cuts the lineage at every step, so a lost
executor never forces recomputing the earlier marts, and no mart is
evaluated twice (the reference's SQL chain re-ran payments for each
downstream mart and preview).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dialects import Dialect, get_dialect
from ..operators.legs import payments_mart
from ..operators.marts import account_mart, info_mart
from ..schemas import PARTITION_KEYS, LedgerTables, validate
from ..sinks.writers import write_jdbc, write_partitioned
from ..sources.readers import read_csv, read_partitioned

# Landing file and ingested directory of each table (file name minus "s.csv").
LANDING_FILES = {
    "clients": ("Clients.csv", "Client"),
    "accounts": ("Accounts.csv", "Account"),
    "operations": ("Operations.csv", "Operation"),
    "rates": ("Rates.csv", "Rate"),
}
# Database table of each mart.
JDBC_TABLES = {"payments": "CorporatePayments", "account": "CorporateAccount", "info": "CorporateInfo"}


def ingest_table(spark: SparkSession, csv_path: str, out_path: str, table: str) -> None:
    """One landing CSV → parquet partitioned by the table's date (overwrite)."""
    df = read_csv(spark, csv_path, table)
    write_partitioned(df, out_path, PARTITION_KEYS[table])


def ingest(spark: SparkSession, csv_dir: str, parquet_dir: str,
           tables: tuple[str, ...] = ("clients", "accounts", "operations", "rates")) -> dict[str, str]:
    """All landing files of ``csv_dir`` into ``parquet_dir``; returns the output paths."""
    out = {}
    for t in tables:
        src, dst = LANDING_FILES[t]
        path = f"{parquet_dir.rstrip('/')}/{dst}"
        ingest_table(spark, f"{csv_dir.rstrip('/')}/{src}", path, t)
        out[t] = path
    return out


def load_tables(spark: SparkSession, parquet_dir: str, keywords_csv: str,
                cutoff_from=None, cutoff_to=None) -> LedgerTables:
    """Ingested tables (dates restored from partitions) plus the keyword dictionary.

    ``cutoff_from``/``cutoff_to`` (inclusive) restrict the operations to those
    dates; they become partition filters, so only those ``DateOp=``
    directories are read. With ``build_and_write(dynamic_overwrite=True)``
    this reloads the chosen cutoff dates of existing marts.
    """
    def part(t: str, lo=None, hi=None) -> DataFrame:
        return read_partitioned(spark, f"{parquet_dir.rstrip('/')}/{LANDING_FILES[t][1]}", t, lo, hi)
    return LedgerTables(
        clients=part("clients"), accounts=part("accounts"),
        operations=part("operations", cutoff_from, cutoff_to),
        rates=part("rates"), keywords=read_csv(spark, keywords_csv, "keywords"),
    )


def build_and_write(spark: SparkSession, tables: LedgerTables, out_dir: str,
                    dialect: str | Dialect = "frame", check_keys: bool = True,
                    dynamic_overwrite: bool = False) -> dict[str, str]:
    """Payments → account → info, each written partitioned by CutoffDt.

    ``check_keys`` first verifies unique accounts, clients and rates (D3, D19).
    """
    d = get_dialect(dialect)
    if check_keys:
        validate(tables)
    base = out_dir.rstrip("/")
    paths = {k: f"{base}/corporate_{k}" for k in ("payments", "account", "info")}

    pay = payments_mart(tables, d, by_date=True)
    write_partitioned(pay, paths["payments"], "CutoffDt", dynamic_overwrite=dynamic_overwrite, dealt=True)
    # A reload reads back only its own dates: the other partitions are neither read nor rebuilt.
    dates = _dates(tables) if dynamic_overwrite else None
    pay = _read_back(spark, pay, paths["payments"], dates)

    if d.name == "sql_v1":
        return {"payments": paths["payments"]}

    acc = account_mart(pay, tables, d)
    write_partitioned(acc, paths["account"], "CutoffDt", dynamic_overwrite=dynamic_overwrite)
    acc = _read_back(spark, acc, paths["account"], dates)

    info = info_mart(acc, tables)
    write_partitioned(info, paths["info"], "CutoffDt", dynamic_overwrite=dynamic_overwrite)
    return paths


def _dates(tables: LedgerTables) -> list:
    """The cutoff dates being reloaded (one small row per date of the chosen range)."""
    return [r[0] for r in tables.operations.select("DateOp").distinct().collect()]


def _read_back(spark: SparkSession, df: DataFrame, path: str, dates: list | None) -> DataFrame:
    back = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    if dates is None:
        return back
    known = [d for d in dates if d is not None]
    cond = F.col("CutoffDt").isin(known)
    return back.filter(cond | F.col("CutoffDt").isNull() if None in dates else cond)


def stale_dates(spark: SparkSession, tables: LedgerTables, out_dir: str, cutoff_from=None, cutoff_to=None) -> list:
    """Dates of a reloaded range that the payments mart has and the operations no longer have.

    A dynamic overwrite replaces the partitions it writes; those of vanished
    dates stay until they are removed.
    """
    mart = spark.read.parquet(f"{out_dir.rstrip('/')}/corporate_payments").select("CutoffDt").distinct()
    if cutoff_from is not None:
        mart = mart.filter(F.col("CutoffDt") >= F.lit(cutoff_from).cast("date"))
    if cutoff_to is not None:
        mart = mart.filter(F.col("CutoffDt") <= F.lit(cutoff_to).cast("date"))
    gone = mart.join(tables.operations.select(F.col("DateOp").alias("CutoffDt")), "CutoffDt", "left_anti")
    return sorted(r[0] for r in gone.collect() if r[0] is not None)


def publish(spark: SparkSession, paths: dict[str, str], url: str, properties: dict[str, str],
            driver: str | None = None, num_partitions: int | None = None) -> None:
    """Written marts → database tables (overwrite), from explicit paths (D25)."""
    for name, path in paths.items():
        write_jdbc(spark.read.parquet(path), url, JDBC_TABLES[name], properties, driver,
                   num_partitions=num_partitions)

"""Ingest with a quarantine (D21, CM7, SNK1).

A landing file is read once. That pass tests every row against its table's rules, writes
the good rows to ``rejected=false/<date>=.../`` and the others with their faults to ``rejected=true/``
of the same directory, and counts the faults with an observation; nothing is read a second time.

A row may have several faults. An empty cell is no fault, as everywhere in the ledger (NULL);
a fault is text that its column's type does not take, or a line with other fields than the header's.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import AMOUNT, PARTITION_KEYS, RAW_COLUMNS, parse_decimal_comma
from ..sources.readers import CORRUPT, ingested_schema, read_csv

#: Columns that hold a decimal with a comma.
DECIMALS = {"operations": ["Amount"], "rates": ["Rate"]}
NOT_DECIMAL, NOT_DATE, NOT_FIELDS = f"not a {AMOUNT.simpleString()}", "not a date", "other fields than the header"
LINE = "(line)"


def rules(table: str) -> list[tuple[str, str, Column]]:
    """(column, reason, condition) of every fault a row of the table can have."""
    key = PARTITION_KEYS[table]
    out = [(c, NOT_DECIMAL, F.col(c).isNotNull() & parse_decimal_comma(c).isNull()) for c in DECIMALS.get(table, [])]
    out.append((key, NOT_DATE, F.col(key).isNotNull() & F.col(key).try_cast("date").isNull()))
    return [*out, (LINE, NOT_FIELDS, F.col(CORRUPT).isNotNull())]


def ingest_checked(spark: SparkSession, csv_path: str, out_path: str, table: str) -> dict[tuple[str, str], int]:
    """One landing CSV to good and rejected rows; returns the number of faults by (column, reason)."""
    found = rules(table)
    key, columns = PARTITION_KEYS[table], RAW_COLUMNS[table]
    fault = [F.when(cond, F.struct(F.lit(c).alias("column"), F.lit(r).alias("reason"))) for c, r, cond in found]
    seen = Observation(f"rejects-{table}")
    rows = read_csv(spark, csv_path, table, corrupt=True).observe(
        seen, F.count(F.lit(1)).alias("rows"), *(F.count_if(cond).alias(f"f{i}") for i, (_, _, cond) in enumerate(found)))
    rows = rows.withColumn("faults", F.array_compact(F.array(*fault))).withColumn("rejected", F.size("faults") > 0)
    rows = rows.select(*[c for c in columns if c != key], F.when(F.col("rejected"), F.col("faults")).alias("faults"),
                       F.when(F.col("rejected"), F.to_json(F.struct(*columns, CORRUPT))).alias("row"), "rejected",
                       F.when(~F.col("rejected"), F.col(key).try_cast("date")).alias(key))
    rows.hint("rebalance", "rejected", key).write.mode("overwrite").partitionBy("rejected", key).parquet(out_path)
    try:
        counts = seen.get
    except Py4JJavaError:  # adaptive execution drops the observation of an input without rows
        if not (read_good(spark, out_path, table).isEmpty() and read_rejects(spark, out_path, table).isEmpty()):
            raise
        counts = {"rows": 0} | {f"f{i}": 0 for i in range(len(found))}
    return {(c, r): counts[f"f{i}"] for i, (c, r, _) in enumerate(found)} | {("", "rows"): counts["rows"]}


def read_good(spark: SparkSession, out_path: str, table: str) -> DataFrame:
    """The rows that passed, as ``read_partitioned`` gives them."""
    schema = T.StructType([T.StructField("rejected", T.BooleanType()), *ingested_schema(table).fields])
    return spark.read.schema(schema).parquet(out_path).where("NOT rejected").select(*RAW_COLUMNS[table])


def read_rejects(spark: SparkSession, out_path: str, table: str) -> DataFrame:
    """``row`` (the cells as read, and the line where its fields are wrong, as JSON), ``column, reason``: a row per fault."""
    schema = T.StructType([T.StructField("rejected", T.BooleanType()), T.StructField("row", T.StringType()),
                           T.StructField("faults", T.ArrayType(T.StructType([
                               T.StructField("column", T.StringType()), T.StructField("reason", T.StringType())])))])
    return spark.read.schema(schema).parquet(out_path).where("rejected").select("row", F.inline("faults"))

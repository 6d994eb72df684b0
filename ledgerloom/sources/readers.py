"""Readers (SRC1-SRC7).

Every reader takes an explicit schema so nothing depends on inference:
CSV columns are text (header, comma, empty cell = NULL, blanks kept) and the
partition column of an ingested table is a ``date`` recovered from its
``key=value`` directories, which the parquet scan prunes on.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PARTITION_KEYS, RAW_COLUMNS


#: Column of a line that has other fields than its header (``read_csv(corrupt=True)``).
CORRUPT = "_corrupt_line"


def read_csv(spark: SparkSession, path: str, table: str | None = None,
             columns: list[str] | None = None, corrupt: bool = False) -> DataFrame:
    """Header CSV, all columns strings, resolved by header name (SRC1).

    The files' own header gives the columns; with a ``table`` (or ``columns``)
    its columns are selected by name, whatever their order and whatever other
    columns there are, and a missing one raises. Files of one path must share one
    header; Spark checks each file's header and fails otherwise. ``corrupt`` adds the text
    of lines with more or fewer fields than the header as ``CORRUPT`` (NULL for the others).
    """
    options = {"header": True, "delimiter": ",", "ignoreLeadingWhiteSpace": False,
               "ignoreTrailingWhiteSpace": False, "mode": "PERMISSIVE"}
    names = spark.read.options(**options).csv(path).columns  # reads one header line
    text = T.StructType([T.StructField(c, T.StringType(), True) for c in names])
    if corrupt:
        text = text.add(CORRUPT, T.StringType())
        options["columnNameOfCorruptRecord"] = CORRUPT
    df = spark.read.options(**options).option("enforceSchema", False).schema(text).csv(path)
    wanted = columns or (RAW_COLUMNS[table] if table is not None else None)
    if wanted is None:
        return df
    missing = [c for c in wanted if c.lower() not in {n.lower() for n in names}]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}; the header has {names}")
    return df.select(*[F.col(f"`{c}`").alias(c) for c in wanted], *([CORRUPT] if corrupt else []))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A whole parquet directory (SRC2)."""
    return spark.read.parquet(path)


def ingested_schema(table: str) -> T.StructType:
    """Data columns as text plus the date-typed partition column."""
    key = PARTITION_KEYS[table]
    fields = [T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS[table] if c != key]
    return T.StructType(fields + [T.StructField(key, T.DateType(), True)])


def read_partitioned(spark: SparkSession, path: str, table: str,
                     date_from: dt.date | str | None = None,
                     date_to: dt.date | str | None = None) -> DataFrame:
    """An ingested table with its partition date restored (SRC3).

    ``date_from``/``date_to`` (inclusive) become partition filters, so only
    the matching ``key=value`` directories are listed and read.
    """
    key = PARTITION_KEYS[table]
    df = spark.read.schema(ingested_schema(table)).parquet(path)
    cond: Column | None = None
    if date_from is not None:
        cond = F.col(key) >= F.lit(date_from).cast("date")
    if date_to is not None:
        c2 = F.col(key) <= F.lit(date_to).cast("date")
        cond = c2 if cond is None else cond & c2
    if cond is not None:
        df = df.filter(cond)
    return df.select(*RAW_COLUMNS[table])


def read_wholetext(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``path``, ``value`` (the file's whole text) (SRC5)."""
    return (spark.read.text(path, wholetext=True)
            .select(F.input_file_name().alias("path"), F.col("value")))


def json_value(column: Column | str, dotted_key: str) -> Column:
    """Value at a dotted key path inside a JSON text column, as text (SRC6)."""
    c = F.col(column) if isinstance(column, str) else column
    return F.get_json_object(c, "$." + dotted_key)

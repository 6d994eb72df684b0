"""Ledger tables derived from the driver's TPC-H-like tables (FIXTURES.md §2).

Each ledger table is a projection or join of the given parquet tables, so
its size grows with the scale factor. The rate table and the keyword
dictionary are small inline dimensions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import LedgerTables
from .sources.readers import read_parquet

# Fixed values of the test mapping (FIXTURES.md §2): rates per currency and
# date (decimal comma as in the shipped CSV) and the two keyword lists.
FIXTURE_RATES = [
    ("USD", "79,40", dt.date(1995, 1, 1)),
    ("EU", "88,15", dt.date(1995, 1, 1)),
    ("RUB", "1", dt.date(1995, 1, 1)),
    ("USD", "82,75", dt.date(2001, 1, 1)),
    ("EU", "90,10", dt.date(1998, 1, 1)),
    ("RUB", "1", dt.date(2001, 1, 1)),
]
FIXTURE_KEYWORDS = [
    ("widget", "ring"),
    ("giz", "rod"),
    (None, "anvi"),
]

RATES_SCHEMA = T.StructType([
    T.StructField("Currency", T.StringType(), True),
    T.StructField("Rate", T.StringType(), True),
    T.StructField("RateDate", T.DateType(), True),
])
KEYWORDS_SCHEMA = T.StructType([
    T.StructField("List_1", T.StringType(), True),
    T.StructField("List_2", T.StringType(), True),
])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _code(segment: F.Column) -> F.Column:
    return (F.when(segment == "BUILDING", "40702")
            .when(segment == "MACHINERY", "40802")
            .otherwise("40817"))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(
        key.cast("string").alias("AccountId"),
        F.concat(_code(F.col("c_mktsegment")), F.lpad(key.cast("string"), 15, "0")).alias("AccountNum"),
        F.expr("c_custkey div 3").cast("string").alias("ClientId"),
        F.date_add(F.lit(dt.date(1994, 1, 1)), (key % 365).cast("int")).alias("DateOpen"),
    )


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    return (
        c.filter((key % 3 == 0) & (F.col("c_nationkey") != 24))
        .select(
            F.expr("c_custkey div 3").cast("string").alias("ClientId"),
            F.col("c_name").alias("ClientName"),
            F.when(seg.isin("HOUSEHOLD", "FURNITURE"), "Ф")
            .when(seg == "AUTOMOBILE", "И").otherwise("Ю").alias("Type"),
            seg.alias("Form"),
            F.date_add(F.lit(dt.date(1990, 1, 1)), F.col("c_nationkey").cast("int")).alias("RegisterDate"),
        )
    )


def operations(spark: SparkSession, sf_dir: str, by_date: bool = False) -> DataFrame:
    """``by_date`` deals the rows out by DateOp for a partitioned write, while their texts are not yet made."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", (F.col("l_linenumber") % 3).alias("ln"), "l_extendedprice")
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("DateOp"))
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    # Orders and parts grow with the operations: a file's size hides their rows, and a broadcast would fill the driver.
    # Orders come last: the lines of an order then stand together and take less room in the shuffle by date.
    j = (li.join(p.hint("merge"), li.l_partkey == p.p_partkey)
         .join(o.hint("merge"), li.l_orderkey == o.o_orderkey))
    j = j.select("o_custkey", "l_partkey", "l_orderkey", "ln", "p_name", "DateOp",
                 F.col("l_extendedprice").cast("decimal(10,2)").alias("price"))
    if by_date:
        # In order of accounts and contracts, so that like values stand together in the files.
        j = j.hint("rebalance", "DateOp").sortWithinPartitions("DateOp", "o_custkey", "l_orderkey")
    ln = F.col("ln")
    return j.select(
        F.col("o_custkey").cast("string").alias("AccountDB"),
        F.col("l_partkey").cast("string").alias("AccountCR"),
        "DateOp",
        F.replace(F.col("price").cast("string"), F.lit("."), F.lit(",")).alias("Amount"),
        F.when(ln == 0, "USD").when(ln == 1, "EU").otherwise("RUB").alias("Currency"),
        F.concat(F.lit("оплата за "), F.col("p_name"), F.lit(", договор "),
                 F.col("l_orderkey").cast("string")).alias("Comment"),
    )


def _values(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small inline table built in the JVM (no Python-backed RDD)."""
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def rates(spark: SparkSession) -> DataFrame:
    return _values(spark, FIXTURE_RATES, RATES_SCHEMA)


def keywords(spark: SparkSession) -> DataFrame:
    return _values(spark, FIXTURE_KEYWORDS, KEYWORDS_SCHEMA)


def rate_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long rate history derived from ``orders`` (one rate per order).

    Many rates share a (Currency, RateDate), so the newest date of a currency
    usually carries several rates (ties), which the policies must keep.
    """
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.when(k % 3 == 0, "USD").when(k % 3 == 1, "EU").otherwise("RUB").alias("Currency"),
        F.concat((F.col("o_custkey") % 100).cast("string"), F.lit(","),
                 F.lpad((k % 100).cast("string"), 2, "0")).alias("Rate"),
        F.col("o_orderdate").cast("date").alias("RateDate"),
    )


def part_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A two-column keyword file derived from ``part`` names, padded with NULLs."""
    p = read_table(spark, sf_dir, "part")
    words = F.split(F.col("p_name"), " ")
    return p.select(
        F.when(F.col("p_partkey") % 2 == 0, F.get(words, 0)).alias("List_1"),
        F.get(words, 1).alias("List_2"),
    )


def large_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyword file that grows with the tables: names of all parts and contract numbers of all orders.

    Colours, sizes and numbers are shifted, so that the words match part of the comments.
    """
    name = F.col("p_name")
    names = read_table(spark, sf_dir, "part").select(
        F.replace(name, F.lit("red"), F.lit("hot")).alias("List_1"),
        F.replace(F.replace(name, F.lit("small"), F.lit("old")), F.lit("ring"), F.lit("rod")).alias("List_2"))
    contracts = read_table(spark, sf_dir, "orders").select(
        F.concat(F.lit("договор "), (F.col("o_orderkey") * 3).cast("string")).alias("List_1"),
        F.concat(F.lit("ring, договор "), F.col("o_orderkey").cast("string")).alias("List_2"))
    return names.unionByName(contracts)


def mixed_letters(keywords: DataFrame) -> DataFrame:
    """A dictionary in capitals, its Latin A, O and T replaced by the Cyrillic letters that look like them."""
    return keywords.select(*[F.translate(F.upper(c), "AOT", "АОТ").alias(c) for c in keywords.columns])


def large_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as regular expressions: one for every part and every order, and one without a literal."""
    name = F.replace("p_name", F.lit("red"), F.lit("hot"))
    names = read_table(spark, sf_dir, "part").select(
        F.concat(F.lit("(за|для) "), name, F.lit(",")).alias("List_1"),
        F.concat(F.lit("(?iu:ЗА) +"), name, F.lit(".*[13579]$")).alias("List_2"))
    contracts = read_table(spark, sf_dir, "orders").select(
        F.concat(F.lit("договор "), (F.col("o_orderkey") * 3).cast("string"), F.lit("$")).alias("List_1"),
        F.concat(F.lit("r[io][nd]g?, (?:договор|счёт) "), F.col("o_orderkey").cast("string"), F.lit("$"))
        .alias("List_2"))
    bare = spark.range(1).select(F.lit(r"\d{4}7$").alias("List_1"), F.lit(None).cast("string").alias("List_2"))
    return names.unionByName(contracts).unionByName(bare)


def faulty_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operations as a landing file has them, with amounts and dates that do not parse among them."""
    ops = operations(spark, sf_dir)
    day, debit, credit = F.col("DateOp").cast("string"), F.col("AccountDB").cast("long"), F.col("AccountCR").cast("long")
    return ops.withColumn("Amount", F.when(credit % 97 == 0, F.concat(F.lit("1."), "Amount")).otherwise(F.col("Amount"))) \
        .withColumn("DateOp", F.when(debit % 101 == 0, F.concat(day, F.lit("/"))).otherwise(day))


def ledger_tables(spark: SparkSession, sf_dir: str) -> LedgerTables:
    return LedgerTables(
        clients=clients(spark, sf_dir),
        accounts=accounts(spark, sf_dir),
        operations=operations(spark, sf_dir),
        rates=rates(spark),
        keywords=keywords(spark),
    )


# The same mapping in DuckDB SQL, used as a prefix by the oracle queries.
ORACLE_PRELUDE = """
WITH accounts AS (
  SELECT CAST(c_custkey AS VARCHAR) AS AccountId,
         CASE c_mktsegment WHEN 'BUILDING' THEN '40702' WHEN 'MACHINERY' THEN '40802' ELSE '40817' END
           || lpad(CAST(c_custkey AS VARCHAR), 15, '0') AS AccountNum,
         CAST(c_custkey // 3 AS VARCHAR) AS ClientId,
         DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DateOpen
  FROM customer
), clients AS (
  SELECT CAST(c_custkey // 3 AS VARCHAR) AS ClientId, c_name AS ClientName,
         CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'Ф'
              WHEN c_mktsegment = 'AUTOMOBILE' THEN 'И' ELSE 'Ю' END AS Type,
         c_mktsegment AS Form,
         DATE '1990-01-01' + CAST(c_nationkey AS INTEGER) AS RegisterDate
  FROM customer WHERE c_custkey % 3 = 0 AND c_nationkey <> 24
), operations AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS AccountDB,
         CAST(l.l_partkey AS VARCHAR) AS AccountCR,
         CAST(date_trunc('month', o.o_orderdate) AS DATE) AS DateOp,
         replace(CAST(CAST(l.l_extendedprice AS DECIMAL(10,2)) AS VARCHAR), '.', ',') AS Amount,
         CASE l.l_linenumber % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EU' ELSE 'RUB' END AS Currency,
         'оплата за ' || p.p_name || ', договор ' || CAST(l.l_orderkey AS VARCHAR) AS Comment
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN part p ON l.l_partkey = p.p_partkey
), rates(Currency, Rate, RateDate) AS (
  VALUES ('USD', '79,40', DATE '1995-01-01'), ('EU', '88,15', DATE '1995-01-01'),
         ('RUB', '1', DATE '1995-01-01'), ('USD', '82,75', DATE '2001-01-01'),
         ('EU', '90,10', DATE '1998-01-01'), ('RUB', '1', DATE '2001-01-01')
), keywords(List_1, List_2) AS (
  VALUES ('widget', 'ring'), ('giz', 'rod'), (NULL, 'anvi')
), rate_history AS (
  SELECT CASE o_orderkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EU' ELSE 'RUB' END AS Currency,
         CAST(o_custkey % 100 AS VARCHAR) || ',' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') AS Rate,
         CAST(o_orderdate AS DATE) AS RateDate
  FROM orders
), large_dictionary AS (
  SELECT DISTINCT replace(p_name, 'red', 'hot') AS List_1,
         replace(replace(p_name, 'small', 'old'), 'ring', 'rod') AS List_2 FROM part
  UNION ALL
  SELECT 'договор ' || CAST(o_orderkey * 3 AS VARCHAR), 'ring, договор ' || CAST(o_orderkey AS VARCHAR)
  FROM orders
), part_dictionary AS (
  SELECT CASE WHEN p_partkey % 2 = 0 THEN NULLIF(split_part(p_name, ' ', 1), '') END AS List_1,
         NULLIF(split_part(p_name, ' ', 2), '') AS List_2
  FROM part
)
"""

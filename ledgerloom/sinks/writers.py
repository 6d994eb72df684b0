"""Writers (SNK1-SNK6).

Partitioned writes use the ``rebalance`` hint on the partition key: rows of
one date go to the same tasks (few files per directory) while AQE splits a
date that is too big for one task and merges tiny ones - no ``coalesce(n)``
that funnels the whole mart through n tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffles_freed, stored


def write_partitioned(df: DataFrame, path: str, key: str = "CutoffDt", mode: str = "overwrite",
                      dynamic_overwrite: bool = False, max_records_per_file: int | None = None,
                      dealt: bool = False, compression: str | None = None) -> None:
    """``partitionBy(key)`` parquet (SNK1, SNK2).

    ``dynamic_overwrite`` replaces only the dates present in ``df`` (reload
    of chosen cutoff dates) instead of the whole directory. ``dealt``: the
    frame's rows were dealt out by ``key`` already.
    """
    w = (df if dealt else df.hint("rebalance", key)).write.mode(mode).partitionBy(key)
    if dynamic_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if compression:
        w = w.option("compression", compression)
    with shuffles_freed(df.sparkSession):
        w.parquet(path)


def write_flat(df: DataFrame, path: str, num_files: int | None = None, mode: str = "overwrite") -> None:
    """One flat parquet directory (SNK3): ``num_files`` files, or as many as the data's size asks for."""
    df = df.hint("rebalance") if num_files is None else df.repartition(num_files)
    with shuffles_freed(df.sparkSession):
        df.write.mode(mode).parquet(path)


def write_sorted_csv(df: DataFrame, path: str, order_by: str = "AccountId",
                     numeric: bool = True, mode: str = "overwrite", compression: str | None = None) -> None:
    """Header CSV in global order of ``order_by`` (SNK4, ST1).

    A range-partitioned sort: part files are in order, no single task holds
    the whole output. ``numeric`` orders a text id by its number. ``compression``
    (gzip): each part file is packed as a whole.
    """
    w = df.orderBy(*id_order(order_by, numeric)).write.mode(mode).option("header", True)
    if compression:
        w = w.option("compression", compression)
    with shuffles_freed(df.sparkSession):
        w.csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               driver: str | None = None, mode: str = "overwrite", batch_size: int = 10_000,
               num_partitions: int | None = None) -> None:
    """One mart to a database table (SNK5).

    ``num_partitions`` caps the parallel connections (Spark coalesces to it).
    """
    props = dict(properties or {})
    if driver:
        props["driver"] = driver
    w = df.write.mode(mode).option("batchsize", batch_size)
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    w.jdbc(url, table, properties=props)


def id_order(order_by: str, numeric: bool = True) -> list:
    """Sort keys of an id column; ``numeric`` orders a text id by its number, others after them."""
    if not numeric:
        return [F.col(order_by).asc_nulls_last()]
    return [F.col(order_by).try_cast("long").asc_nulls_last(), F.col(order_by).asc_nulls_last()]


def preview(df: DataFrame, n: int = 20, order_by: str | None = None, numeric: bool = True,
            then: tuple[str, ...] = ("CutoffDt",)) -> DataFrame:
    """First ``n`` rows in the order of an id (ST3, SNK6), without one that of a mart's AccountId; other frames as read.

    Every task keeps its own first n rows and one task merges these: nothing is sorted as a whole.
    """
    if order_by is None:
        if "AccountId" not in df.columns:
            return df.limit(n)
        order_by = "AccountId"
    return df.orderBy(*id_order(order_by, numeric), *(F.col(c).asc_nulls_last() for c in then)).limit(n)


def ranked(df: DataFrame, order_by: str = "AccountId", numeric: bool = True, then: tuple[str, ...] = ("CutoffDt",),
           name: str = "RowNumber") -> DataFrame:
    """``df`` with its row numbers from 1 on in global order (ST1), without a window over all rows.

    The rows are range-partitioned and sorted once and stored with their place in their task;
    the tasks' sizes, one row each, give the numbers before each task. Rows that tie in every
    key are numbered in the order in which they were read, so that a hot key is split like any other.
    """
    part, place, tie = "_part", "_place", "_tie"
    keys = [*id_order(order_by, numeric), *(F.col(c).asc_nulls_last() for c in then), F.col(tie)]
    rows = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    rows = stored(rows.select(*df.columns, F.spark_partition_id().alias(part), row.alias(place)), "ranked")
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(part).agg(F.count(F.lit(1)).alias("n")).select(  # one row per task
        part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(sizes), part).select(
        *df.columns, (F.col("before") + F.col(place) + 1).alias(name))

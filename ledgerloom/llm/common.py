"""Helpers shared by the corpus operators: tables, stored intermediates, row keys,
connected components."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import checkpoint_root, scratch_path
from ledgerloom.session import ship_package as ship

#: Words of a text: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: Bits of the filter of ``without`` (8 MB), and bits set for a key.
FILTER_BITS, FILTER_HASHES = 1 << 26, 4


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared checkpoint folder and read it back.

    Cuts the lineage with a table that every executor can read, so a lost
    executor costs only the tasks it was running.
    """
    ship(df.sparkSession)
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the session's shared folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that the frame does not use (Spark compares without case)."""
    used = {c.lower() for c in df.columns}
    name = base
    while name.lower() in used:
        name += "_"
    return name


def keyed(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, str]:
    """The frame and the name of a column that is unique and not null in it.

    Normally the id itself. Where ids repeat or are null, the frame is stored
    with a row number of its own, so that every row can be addressed.
    """
    n = docs.select(id_col).groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    bad = n.where((F.col("n") > 1) | F.col(id_col).isNull()).limit(1)
    if bad.isEmpty():
        return docs, id_col
    key = fresh(docs, "_row_key")
    return stored(docs.withColumn(key, F.monotonically_increasing_id()), "keyed"), key


def _hashes(column: str) -> tuple[Column, Column]:
    """Start and step of a key's bits."""
    return (F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)), F.pmod(F.xxhash64(column, F.lit(1)), F.lit(FILTER_BITS)))


def key_filter(keys: DataFrame, column: str) -> np.ndarray:
    """A Bloom filter of the keys as 64-bit words: ``FILTER_BITS`` bits whatever their number."""
    h, step = _hashes(column)
    spots = F.explode(F.array(*((h + step * i) % FILTER_BITS for i in range(FILTER_HASHES))))
    words = keys.select(spots.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out


def without(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose key is not in ``gone`` (one column, unique keys).

    Rows that a filter of the gone keys shows to stay are passed on where they lie. Only
    the others, those that go and a few more, meet the gone keys in a shuffle; a filter that is too
    small for very many keys makes more rows move, not another result.
    """
    k, may = fresh(docs, "_gone_key"), fresh(docs, "_may_go")
    gone = stored(gone.toDF(k), "gone")
    shared = docs.sparkSession.sparkContext.broadcast(key_filter(gone, k))

    @F.pandas_udf("boolean")
    def known(h, step):
        h, step = h.to_numpy(), step.to_numpy()
        hit = np.ones(len(h), bool)
        for i in range(FILTER_HASHES):
            at = (h + step * i) % FILTER_BITS
            hit &= (shared.value[at >> 6] >> (at & 63)) & 1 == 1
        return pd.Series(hit)

    marked = docs.withColumn(may, known(*_hashes(key)))
    kept = marked.where(F.col(may)).join(gone, F.col(key) == F.col(k), "left_anti")
    return marked.where(~F.col(may)).unionByName(kept).drop(may)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (two long columns).

    Returns ``node, root`` for every node that is not its own root; the root
    is the smallest node of the component. Alternates the large-star and
    small-star steps of Kiveris et al. until the edges no longer change: each
    step is an aggregate with map-side combine and an equi join, no node's
    neighbours are ever collected in one row, and every step's edges are
    checkpointed in the shared folder. The number of rounds grows with the
    logarithm of the number of nodes.
    """
    a, b = edges.columns
    e = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = checkpointed(e)
    mark = None
    while True:
        now = e.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now["n"] == 0 or (now["n"], now["h"]) == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = (now["n"], now["h"])
        # large star: every larger neighbour of a node moves to the least of them all
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        e = both.where(F.col("v") > F.col("u")).join(low, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours move to the least of them
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.toDF("u", "v"))
        e = checkpointed(e.where(F.col("u") != F.col("v")).select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

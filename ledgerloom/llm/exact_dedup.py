"""Exact dedup with a heavy-hitter split.

1. Every text becomes a SHA-256 digest of its normalised form (A-Z lowered);
   the digests are stored once, so the texts are read a single time.
2. Each task runs Misra-Gries over its digests. The summed counters miss at
   most N/(k+1) of a digest's N rows, so those above that line (at most k)
   include every digest with more than 2N/(k+1) rows.
3. The candidates are verified by an exact count of their rows. The winners,
   at most k rows, are broadcast: all copies of a frequent text are resolved
   where they lie and never shuffled.
4. The other digests are aggregated by an ordinary shuffle.

Results for odd input: a null text counts as empty; null ids are smaller than
all others and get a null ``keep_id`` only if the whole group has null ids; of
repeated ids in one group exactly one row is kept; an empty table gives no
rows. Other columns are never looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import checkpointed, fresh, keyed, stored, without

#: Counters of a Misra-Gries summary; also the bound on the rows broadcast.
COUNTERS = 1023

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: str | Column) -> Column:
    return F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")),
                       UPPER, UPPER.lower())


def digest(text: str | Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def merge_counts(counts: dict, more: dict, k: int) -> dict:
    """Add ``more`` to a Misra-Gries summary and cut it back to k counters."""
    for x, n in more.items():
        counts[x] = counts.get(x, 0) + n
    if len(counts) > k:
        cut = heapq.nlargest(k + 1, counts.values())[-1]
        counts = {x: n - cut for x, n in counts.items() if n > cut}
    return counts


def summaries(digests: DataFrame, k: int = COUNTERS) -> DataFrame:
    """One Misra-Gries summary per task: ``digest, n``, at most k rows each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = {}
        for b in batches:
            seen = b.column(0).value_counts()
            counts = merge_counts(counts, dict(zip(seen.field(0).to_pylist(),
                                                   seen.field(1).to_pylist(), strict=True)), k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            ["digest", "n"])

    return digests.select("digest").mapInArrow(run, "digest binary, n long")


def candidates(digests: DataFrame, k: int = COUNTERS) -> DataFrame:
    """At most k digests, among them all with more than 2N/(k+1) rows."""
    n = digests.count()
    return (summaries(digests, k).groupBy("digest").agg(F.sum("n").alias("n"))
            .where(F.col("n") * (k + 1) > F.lit(n)).select("digest"))


def heavy_hitters(digests: DataFrame, k: int = COUNTERS, least: bool = False) -> DataFrame:
    """Verified winners ``digest, keep (doc_id, key), group_size``: at most k rows."""
    first = F.min if least else F.max
    exact = (digests.join(F.broadcast(candidates(digests, k)), "digest", "left_semi")
             .groupBy("digest").agg(first(F.struct("doc_id", "key")).alias("keep"),
                                    F.count(F.lit(1)).alias("group_size")))
    return checkpointed(exact.where(F.col("group_size") > 1))


def groups(docs: DataFrame, key: str, k: int = COUNTERS) -> DataFrame:
    """``doc_id, key, digest, keep, group_size`` for every row of ``docs``."""
    digests = stored(docs.select(F.col("doc_id").alias("doc_id"), F.col(key).alias("key"),
                                 digest("text").alias("digest")), "digests")
    heavy = heavy_hitters(digests, k)
    frequent = digests.join(F.broadcast(heavy), "digest")
    rest = digests.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    few = rest.groupBy("digest").agg(F.max(F.struct("doc_id", "key")).alias("keep"),
                                     F.count(F.lit(1)).alias("group_size"))
    return frequent.unionByName(rest.join(few, "digest"))


def flags(docs: DataFrame, k: int = COUNTERS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    docs = docs.select("doc_id", "text")
    row = "_row"
    g = groups(docs.withColumn(row, F.monotonically_increasing_id()), row, k)
    return g.select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
                    (F.col("key") == F.col("keep.key")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256"))


def dedup(docs: DataFrame, k: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: the largest doc_id of each group.

    Copies of frequent texts go by a map-side lookup in the broadcast winners,
    the others by an anti join on the row's key.
    """
    docs, key = keyed(docs)
    digests = stored(docs.select(F.col("doc_id").alias("doc_id"), F.col(key).alias("key"),
                                 digest("text").alias("digest")), "digests")
    heavy = heavy_hitters(digests, k)
    rest = digests.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    few = rest.groupBy("digest").agg(F.max(F.struct("doc_id", "key")).alias("keep"),
                                     F.count(F.lit(1)).alias("n")).where("n > 1")
    gone = rest.join(few, "digest").where(F.col("key") != F.col("keep.key")).select("key")
    left = without(docs, key, gone)
    d, w, win = (fresh(docs, x) for x in ("_digest", "_wdigest", "_winner"))
    winners = F.broadcast(heavy.select(F.col("digest").alias(w), F.col("keep.key").alias(win)))
    out = (left.withColumn(d, digest("text")).join(winners, F.col(d) == F.col(w), "left")
           .where(F.col(win).isNull() | (F.col(win) == F.col(key))).select(*docs.columns))
    return out if key == "doc_id" else out.drop(key)

"""SimHash near-dedup by multi-index hashing.

Fingerprint: 64 bits over the XXH64 values of 3-word shingles. Two
fingerprints link at ``MAX_BITS`` = 2 or fewer differing bits.

The distinct fingerprints are indexed by two 32-bit segments. By the
pigeonhole principle two fingerprints within 2 bits agree in the second
segment or differ in at most one bit of the first, so each probes the ball of
radius 1 around its first segment (33 keys) and the ball of radius 0 of its
second; table matches are verified by the full distance.

A bucket of more than ``BUCKET`` distinct fingerprints is not paired up.
Instead each fingerprint that meets one enumerates the radius-1 balls of both
segments at once, as whole fingerprints (64 one-bit flips and itself). Two
fingerprints share such a point exactly if they are within 2 bits, and at most
65 distinct fingerprints share one, so its least is linked to the others: the
same components, with work linear in the number of fingerprints.

Results for odd input: a null or empty text has fingerprint zero, linked like
any other; a component whose ids are all null has a null component_id; repeated
ids and rows give one output row each; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from ledgerloom.llm.common import components, keyed, stored, without

SHINGLE = 3
MAX_BITS = 2
BUCKET = 64
SEED = 42
#: Shingles turned into bits at a time.
CHUNK = 1 << 15


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text."""
    words = text.lower().split()  # bytes: A-Z, and ASCII white space
    if not words:
        return 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    joined = b" ".join(words)
    if len(words) <= width:
        return xxh64_intdigest(joined, SEED)
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1].tolist()
    stops = ends[width - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), CHUNK):
        h = np.array([xxh64_intdigest(joined[a:b], SEED)
                      for a, b in zip(starts[i:i + CHUNK], stops[i:i + CHUNK], strict=True)], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``doc_id, key, fp`` (signed long with the fingerprint's bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py() or b"") for t in b.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["doc_id", "key", "fp"])

    kinds = dict(docs.dtypes)
    return docs.select(F.col("doc_id").alias("doc_id"), F.col(key).alias("key"),
                       F.col("text").cast("binary").alias("text")).mapInArrow(
        run, f"doc_id {kinds['doc_id']}, key {kinds[key]}, fp long")


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges ``a, b`` that connect all distinct fingerprints within MAX_BITS.

    ``fps`` has one column of distinct signed longs.
    """
    low = F.lit((1 << 32) - 1)
    x = fps.toDF("fp").select("fp", F.shiftrightunsigned("fp", 32).alias("s1"),
                              F.col("fp").bitwiseAND(low).alias("s2"))
    index = x.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("seg"), F.col("s1").alias("val")),
        F.struct(F.lit(1).alias("seg"), F.col("s2").alias("val")))).alias("k")).select("k.seg", "k.val", "fp")
    ball = F.array(F.lit(0).cast("long"), *(F.lit(1 << i).cast("long") for i in range(32)))
    probes = x.select("fp", F.lit(0).alias("seg"),
                      F.explode(F.transform(ball, lambda m: F.col("s1").bitwiseXOR(m))).alias("val"))
    probes = probes.unionByName(x.select("fp", F.lit(1).alias("seg"), F.col("s2").alias("val")))
    sizes = index.groupBy("seg", "val").agg(F.count(F.lit(1)).alias("n"))
    hot = stored(sizes.where(F.col("n") > bucket).select("seg", "val"), "simhash-hot")
    cool = index.join(hot, ["seg", "val"], "left_anti").withColumnRenamed("fp", "other")
    found = probes.join(cool, ["seg", "val"]).where(
        (F.col("fp") > F.col("other"))
        & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= MAX_BITS)).select(
        F.col("fp").alias("a"), F.col("other").alias("b"))
    crowded = probes.join(hot, ["seg", "val"], "left_semi").select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *(F.lit(np.uint64(1 << i).astype(np.int64).item()).cast("long")
                                             for i in range(64)))
    points = crowded.select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("at"))
    stars = points.groupBy("at").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1).select(
        F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where(
        (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS))
    return found.unionByName(stars).distinct()


def clusters(docs: DataFrame, key: str = "doc_id", bucket: int = BUCKET) -> DataFrame:
    """``doc_id, key, fp, root, component_id`` for every row."""
    fps = stored(fingerprints(docs, key), "simhash")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct.select("fp"), bucket))
    of = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = of.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps.join(of.select("fp", "root").join(least, "root"), "fp")


def near_duplicates(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``."""
    return clusters(docs, "doc_id", bucket).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def dedup(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """The rows that stay, all columns: the smallest doc_id of each component.

    Where ids repeat or are null, exactly one row of each component stays:
    the one with the smallest non-null id, then the smallest row key.
    """
    docs, key = keyed(docs)
    rows = clusters(docs, key, bucket)
    if key == "doc_id":
        return without(docs, key, rows.where(F.col("key") != F.col("component_id")).select("key"))
    rank = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "key")
    win = rows.groupBy("root").agg(F.min(rank).alias("win"))
    gone = rows.join(win, "root").where(F.col("key") != F.col("win.key")).select("key")
    return without(docs, key, gone).drop(key)

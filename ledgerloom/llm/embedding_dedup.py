"""Embedding near-dedup: an exact metric range join within each label.

Vectors of one label and length are scaled to unit length, where cosine >=
``COSINE`` means a Euclidean distance of at most r = sqrt(2 - 2 * COSINE).
Equal vectors are first collapsed to one representative with its number of
copies. Representatives are then dealt to cells around pivots: each has a home,
the nearest pivot's cell, and is a guest of every other cell that may hold a
vector within r of it. By the triangle inequality that needs
d(x, p_c) <= d(x, p_home) + 2 r; the distance to the bisecting hyperplane,
(d(x, p_c)^2 - d(x, p_home)^2) / (2 d(p_c, p_home)) <= r, sharpens it. A home
vector then meets all its partners in its own cell, so cells join independently
and no pair counts twice. Cells beyond ``TILE`` members are joined tile by
tile, so that no task holds an unbounded cell; a tile returns counts and at most
one edge per member, never pairs.

Results for odd input: vectors that are null, empty, zero, or hold null or
non-finite components, and vectors without a label, link with nothing and are
kept; vectors of different length never link; rows with a null vec_id count as
links, and have the smallest non-null id of their component; repeated ids give
one row each; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import components, ship, stored

COSINE = 0.98
#: Home vectors of a cell aimed at, and the pivots broadcast at most.
CELL = 8_192
PIVOTS = 16_384
#: Cell members on either side of a tile.
TILE = 4_096
#: Vector-pivot pairs that a task holds at a time.
CELLS = 1 << 21
#: Slack for rounding in the cell tests; the link test itself is exact.
SLACK = 1e-6


def units(flat: np.ndarray, n: int) -> np.ndarray:
    x = flat.astype(np.float64).reshape(n, -1)
    scale = np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    x = x / scale
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def valid(vectors: DataFrame) -> DataFrame:
    """Rows that can link: ``vec_id, label, embedding`` (array of doubles)."""
    e = F.col("embedding").cast("array<double>")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    return vectors.where(F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
                         & F.exists(e, lambda x: x != 0)).select("vec_id", "label", e.alias("embedding"))


def pivots_of(reps: DataFrame, cell: int) -> dict:
    """Pivot unit vectors by (label, length): at most ``PIVOTS`` in all.

    A group of more than ``cell`` representatives gets one pivot for each
    ``cell`` of them, those of the smallest hash; if that made too many, cells
    grow in proportion.
    """
    sizes = reps.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.where(F.col("n") > cell).agg(F.sum(F.ceil(F.col("n") / cell)).alias("p")).first()["p"] or 0
    if not total:
        return {}
    cell = cell * max(1, math.ceil(2 * total / PIVOTS))
    big = sizes.where(F.col("n") > cell).withColumn("p", F.ceil(F.col("n") / cell))
    rare = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < F.lit(float(1 << 30)) * F.col("p") / F.col("n")
    out: dict = {}
    for r in reps.join(F.broadcast(big), ["label", "dim"]).where(rare).select("label", "embedding").limit(PIVOTS).collect():
        out.setdefault((r["label"], len(r["embedding"])), []).append(r["embedding"])
    return {k: units(np.array(v).ravel(), len(v)) for k, v in out.items()}


def cells_of(x: np.ndarray, pivots: np.ndarray, r: float) -> tuple[np.ndarray, np.ndarray]:
    """Home of each unit vector, and for each vector and pivot whether it belongs to the cell."""
    cos = np.clip(x @ pivots.T, -1, 1)
    home = cos.argmax(axis=1)
    near = cos[np.arange(len(x)), home][:, None]
    homes, row = np.unique(home, return_inverse=True)  # only these pivots' distances to the others
    gap = np.sqrt(np.maximum(0, 2 - 2 * np.clip(pivots[homes] @ pivots.T, -1, 1)))[row]
    triangle = np.sqrt(2 - 2 * cos) <= np.sqrt(np.maximum(0, 2 - 2 * near)) + 2 * r + SLACK
    plane = near - cos <= (r + SLACK) * gap + SLACK
    member = triangle & plane
    member[np.arange(len(x)), home] = True
    return home, member


def link_tile(homes: np.ndarray, others: np.ndarray, home_nodes: np.ndarray, other_nodes: np.ndarray,
              copies: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of each home vector, and for homes and others the least node they are connected to."""
    linked = np.empty((len(homes), len(others)), bool)
    n = np.zeros(len(homes), np.int64)
    for i in range(0, len(homes), 512):
        linked[i:i + 512] = homes[i:i + 512] @ others.T >= cosine
        linked[i:i + 512] &= home_nodes[i:i + 512, None] != other_nodes[None]
        n[i:i + 512] = linked[i:i + 512] @ copies
    a, b = home_nodes.copy(), other_nodes.copy()
    rows, cols = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    if len(rows):
        linked, far = linked[np.ix_(rows, cols)], np.iinfo(np.int64).max
        while True:
            p, q = a[rows], b[cols]
            for i in range(0, len(rows), 512):
                p[i:i + 512] = np.minimum(p[i:i + 512], np.where(linked[i:i + 512], q, far).min(axis=1))
            for i in range(0, len(cols), 512):
                q[i:i + 512] = np.minimum(q[i:i + 512], np.where(linked[:, i:i + 512], p[:, None], far).min(axis=0))
            if (p == a[rows]).all() and (q == b[cols]).all():
                break
            a[rows], b[cols] = p, q
    return n, a, b


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, cell: int = CELL, tile: int = TILE) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    spark = vectors.sparkSession
    ship(spark)
    vectors = vectors.select("vec_id", "label", "embedding")
    good = valid(vectors)
    kind = good.schema["label"].dataType.simpleString()
    reps = good.groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    reps = stored(reps.select(F.monotonically_increasing_id().alias("node"), "label",
                              F.size("embedding").alias("dim"), "copies", "least", "embedding"), "vectors")
    r = math.sqrt(max(0.0, 2 - 2 * cosine))
    shared = spark.sparkContext.broadcast(pivots_of(reps, cell))

    def deal(batches):
        for b in batches:
            vec = b.column(4)
            at, cells, home = [], [], []
            labels = b.column(1).to_pylist()
            dims = b.column(2).to_pylist()
            by: dict = {}
            for i, k in enumerate(zip(labels, dims, strict=True)):
                by.setdefault(k, []).append(i)
            for k, rows in by.items():
                p = shared.value.get(k)
                if p is None or not len(p):
                    at += rows
                    cells += [0] * len(rows)
                    home += [True] * len(rows)
                    continue
                step = max(1, CELLS // len(p))
                for j in range(0, len(rows), step):
                    part = rows[j:j + step]
                    x = units(vec.take(pa.array(part)).flatten().to_numpy(zero_copy_only=False), len(part))
                    h, member = cells_of(x, p, r)
                    who, where = np.nonzero(member)
                    at += np.array(part)[who].tolist()
                    cells += where.tolist()
                    home += (h[who] == where).tolist()
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(c.take(take) for c in b.columns), pa.array(cells, pa.int32()), pa.array(home, pa.bool_())],
                ["node", "label", "dim", "copies", "embedding", "cell", "home"])

    members = reps.select("node", "label", "dim", "copies", "embedding").mapInArrow(
        deal, f"node long, label {kind}, dim int, copies long, embedding array<double>, cell int, home boolean")
    keys = ["label", "dim", "cell"]
    sizes = members.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    dealt = members.join(sizes, keys).withColumn("mine", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    tiles = dealt.where("home").select("*", every.alias("other")).select(
        *keys, F.col("mine").alias("i"), F.col("other").alias("j"), F.lit(True).alias("left"),
        "node", "copies", "embedding")
    tiles = tiles.unionByName(dealt.select("*", every.alias("other")).select(
        *keys, F.col("other").alias("i"), F.col("mine").alias("j"), F.lit(False).alias("left"),
        "node", "copies", "embedding"))

    def join(table: pa.Table) -> pa.Table:
        left = table.column("left").to_numpy()
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        if not left.any() or left.all():
            return pa.table({"node": pa.array([], pa.int64()), "n": pa.array([], pa.int64()),
                             "root": pa.array([], pa.int64())})
        x = units(table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False), len(table))
        n, a, b = link_tile(x[left], x[~left], node[left], node[~left], copies[~left], cosine)
        moved = b != node[~left]
        return pa.table({"node": np.concatenate((node[left], node[~left][moved])),
                         "n": np.concatenate((n, np.zeros(moved.sum(), np.int64))),
                         "root": np.concatenate((a, b[moved]))})

    found = stored(tiles.groupBy(*keys, "i", "j").applyInArrow(join, "node long, n long, root long")
                   .where("n > 0 or root != node"), "vector-links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(found.select("node", "root"))
    of = (reps.select("node", "label", "embedding", "copies", "least").join(counts, "node", "left")
          .join(roots.toDF("node", "root"), "node", "left")
          .withColumn("root", F.coalesce("root", "node")))
    least = of.groupBy("root").agg(F.min("least").alias("component_id"))
    of = of.join(least, "root").select(
        F.col("label").alias("l"), F.col("embedding").alias("e"), "component_id",
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    e = F.col("embedding").cast("array<double>")
    out = vectors.select("vec_id", "label", e.alias("embedding")).join(
        of, (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e")), "left")
    own = F.when(F.col("l").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      own.alias("component_id"), F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"))

"""Prefix trie of conversations by Spark SQL's ROLLUP.

1. Every turn becomes an id (128 bits of SHA-256 over role and text) with its text's size, stored
   once; texts are never shuffled. Turns get positions from bounded ranges of ``turn``, and
   ``rebuild`` gives every conversation its rebuilt turns.
2. A conversation is cut into blocks of ``WIDTH`` turn-id columns. A block is keyed by the
   node where the previous one ends: a digest of all turns before it. Prefixes are hashed in groups of
   ``FAN`` blocks, then groups of groups, so no whole conversation is ever in one row.
3. ``GROUP BY block, key, ROLLUP(t1, .., t8)`` aggregates all prefixes of all blocks in one
   pass; ``grouping_id`` gives the depth inside the block. A node is (its smallest member, its depth).
4. A conversation owns the nodes of which it is the smallest member: the end of its path from some depth on.
   A second ROLLUP sums over each node's members the bytes of their paths that are not their own
   and the leaves they own; this gives the subtree sums without a walk over the tree.
5. The ids of conversations that end at a node are sorted and joined in ranges of ``RANGE`` ids, which stream
   through the node's hash in order.

Results for odd input: rows without conv_id belong to no conversation; null role or text is empty; turns
with equal numbers, null among them, follow the order of their ids' digests; repeated rows are turns of
their own; a rebuilt conversation without turns is a member of the root only; an empty table
gives no rows; other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

#: Turn-id columns of a block.
WIDTH = 8
#: Blocks (and groups of them) that are hashed together.
FAN = 64
#: Turn numbers that are ranked together, and conversation ids that are joined together: 2 to this power.
RANGE = 10
#: Largest number of turns taken from the first conversation of a group of ``GROUP``.
HEADS, GROUP = 8, 5

T = [f"t{i + 1}" for i in range(WIDTH)]


def _short(digest: Column) -> Column:
    return F.substring(F.sha2(digest, 256), 1, 32)


def positions(conversations: DataFrame) -> DataFrame:
    """``c, pos, d, s``: every turn's position from 1 on, its id (hex) and its text's bytes."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    size = F.octet_length(role).cast("string")
    turns = stored(conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").alias("turn"),
        _short(F.concat(size, F.lit(":"), role, text).cast("binary")).alias("d"),
        F.octet_length(text).cast("long").alias("s")), "trie-turns")
    turns = turns.withColumn("range", F.coalesce(F.shiftright(F.col("turn").cast("long"), RANGE),
                                                 F.lit(-(1 << 62))))
    earlier = Window.partitionBy("c").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = turns.groupBy("c", "range").agg(F.count(F.lit(1)).alias("n")).select(
        "c", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("c", "range").orderBy(F.col("turn").asc_nulls_first(), "d"))
    return (turns.select("c", "range", "d", "s", rank.alias("rank")).join(counts, ["c", "range"])
            .select("c", (F.col("rank") + F.col("before")).alias("pos"), "d", "s"))


def rebuild(turns: DataFrame) -> DataFrame:
    """``c, len, depth, d, s``: the rebuilt conversations; one without turns has a row of depth 0."""
    turns = stored(turns, "trie-positions")
    c = F.col("c")
    own = turns.groupBy("c").agg(F.max("pos").alias("own")).select(
        "c", "own", (c - c % GROUP).alias("base"),
        (F.crc32(c.cast("string").cast("binary")) % (HEADS + 1)).alias("h"))
    have = own.select(c.alias("base"), F.least("own", F.lit(HEADS)).alias("have"))
    convs = own.join(have, "base", "left").withColumn(
        "shared", F.least("h", F.coalesce("have", F.lit(0)))).withColumn(
        "len", F.col("shared") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = stored(convs.select("c", "base", "h", "shared", "len"), "trie-conversations")
    tail = turns.join(convs, "c").where("pos > h").select(
        "c", "len", (F.col("shared") + F.col("pos") - F.col("h")).alias("depth"), "d", "s")
    heads = turns.where(F.col("pos") <= HEADS).withColumnRenamed("c", "base").join(convs, "base").where(
        "pos <= h").select("c", "len", F.col("pos").alias("depth"), "d", "s")
    none = convs.where("len = 0").select("c", "len", F.lit(0).cast("long").alias("depth"),
                                         F.lit("").alias("d"), F.lit(0).cast("long").alias("s"))
    return heads.unionByName(tail).unionByName(none)


def _prefixes(items: DataFrame, top: int) -> DataFrame:
    """``c, i, key, before``: digest and size of all earlier items of c, for items ``c, i, dig, size``."""
    if top == 0:
        return items.select("c", "i", F.lit("").alias("key"), F.lit(0).cast("long").alias("before"))
    packed = items.groupBy("c", F.expr(f"i div {FAN}").alias("g")).agg(
        F.sort_array(F.collect_list(F.struct("i", "dig", "size"))).alias("xs"))
    upper = _prefixes(packed.select("c", F.col("g").alias("i"), _short(F.array_join("xs.dig", "")).alias("dig"),
                                    F.aggregate("xs.size", F.lit(0).cast("long"), lambda a, b: a + b).alias("size")),
                      top // FAN).withColumnRenamed("i", "g")
    return packed.join(upper, ["c", "g"]).select("c", F.inline(F.expr("""
        transform(sequence(0, size(xs) - 1), x -> named_struct(
            'i', xs[x].i,
            'key', substring(sha2(concat(key, array_join(slice(xs.dig, 1, x), '')), 256), 1, 32),
            'before', before + aggregate(slice(xs.size, 1, x), 0L, (a, b) -> a + b)))""")))


def blocks(rebuilt: DataFrame) -> DataFrame:
    """``c, len, j, key, before, t1 .. t8``: block j of c, keyed by all turns before it.

    A turn column is (id, bytes of the text), null past the conversation's end; ``before`` is
    the number of bytes before the block.
    """
    wide = WIDTH * FAN
    group = F.expr(f"greatest(depth - 1, 0) div {wide}")
    packed = stored(rebuilt.groupBy("c", "len", group.alias("g")).agg(F.sort_array(F.collect_list(
        F.when(F.col("depth") > 0, F.struct("depth", "d", "s")))).alias("xs")), "trie-groups")
    top = packed.agg(F.max("g")).first()[0] or 0
    upper = _prefixes(packed.select("c", F.col("g").alias("i"), _short(F.array_join("xs.d", "")).alias("dig"),
                                    F.aggregate("xs.s", F.lit(0).cast("long"), lambda a, b: a + b).alias("size")),
                      top).withColumnRenamed("i", "g")
    each = packed.join(upper, ["c", "g"]).select("c", "len", F.inline(F.expr(f"""
        transform(sequence(0, greatest((size(xs) - 1) div {WIDTH}, 0L)), x -> named_struct(
            'j', g * {FAN} + x,
            'key', unhex(substring(sha2(concat(key, array_join(slice(xs.d, 1, int(x) * {WIDTH}), '')), 256), 1, 32)),
            'before', before + aggregate(slice(xs.s, 1, int(x) * {WIDTH}), 0L, (a, b) -> a + b),
            'ts', slice(xs, int(x) * {WIDTH} + 1, {WIDTH})))""")))
    return each.select("c", "len", "j", "key", "before", *(
        F.when(F.size("ts") > i, F.struct(F.unhex(F.col("ts")[i]["d"]).alias("d"), F.col("ts")[i]["s"].alias("s")))
        .alias(t) for i, t in enumerate(T)))


def _name(first: Column | int = WIDTH) -> Column:
    """The name of the node that a block's key and its first turns lead to."""
    ids = [F.when(F.lit(i) < first, F.col(t)["d"]) for i, t in enumerate(T)]
    return F.unhex(_short(F.concat("key", *(F.coalesce(x, F.lit(b"")) for x in ids))))


def _bytes(turns: Column | int) -> Column:
    """The bytes up to the first ``turns`` turns of a block."""
    return sum((F.when(F.lit(i) < turns, F.coalesce(F.col(t)["s"], F.lit(0))).otherwise(0)
                for i, t in enumerate(T)), F.col("before"))


def rollup(table: DataFrame, *sums: str) -> DataFrame:
    """All prefixes: ``c`` (smallest member), ``depth, n`` (members), ``parent_bytes, name`` and sums over members."""
    columns = ", ".join(T)
    found = table.sparkSession.sql(
        f"SELECT j, key, {columns}, {WIDTH} - bit_count(grouping_id()) AS level, min(c) AS c, min(before) AS before, "
        + "count(*) AS n" + "".join(f", sum({x}) AS {x}" for x in sums)
        + f" FROM {{blocks}} GROUP BY j, key, ROLLUP({columns})", blocks=table)
    last = F.when(F.col("level") > 0, F.get(F.array(*T), F.col("level").cast("int") - 1))
    real = F.when(F.col("level") == 0, F.col("j") == 0).otherwise(last.isNotNull())
    return found.where(real).select(
        "c", (F.col("j") * WIDTH + F.col("level")).alias("depth"), "n", _bytes(F.col("level") - 1).alias("parent_bytes"),
        _name().alias("name"), *sums)


def ends_sha(ends: DataFrame) -> DataFrame:
    """``end_name, ends_sha256`` of ``name, c`` rows: the hash of each name's ids in order, joined by commas."""
    part = F.shiftright("c", RANGE)
    ids = F.transform(F.sort_array(F.collect_list("c")), lambda x: x.cast("string"))
    parts = ends.groupBy("name", part.alias("part")).agg(F.array_join(ids, ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, None

        def out(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in rows], pa.binary()), pa.array([b for _, b in rows], pa.string())],
                ["end_name", "ends_sha256"])

        for batch in batches:
            done = []
            for x, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held is not None and x == name:
                    held.update(b"," + ids.encode())
                    continue
                if held is not None:
                    done.append((name, held.hexdigest()))
                name, held = x, hashlib.sha256(ids.encode())
            yield out(done)
        if held is not None:
            yield out([(name, held.hexdigest())])

    return (parts.repartition("name").sortWithinPartitions("name", "part").select("name", "ids")
            .mapInArrow(run, "end_name binary, ends_sha256 string"))


def trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of a ``conv_id, turn, role, text`` table: see ``trie_of``."""
    return trie_of(rebuild(positions(conversations)))


def trie_of(sequences: DataFrame) -> DataFrame:
    """One row per node of the trie over ``c, len, depth, d, s`` rows (see ``rebuild``).

    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens``
    and ``ends_sha256``.
    """
    table = stored(blocks(sequences), "trie-blocks")
    found = stored(rollup(table), "trie-prefixes")
    # Conversations that own nodes: from which depth on, and the bytes before it.
    owners = found.groupBy("c").agg(F.min("depth").alias("from"), F.min("parent_bytes").alias("shared"))
    ends = table.where(F.col("j") == F.expr(f"greatest(len - 1, 0L) div {WIDTH}")).select(
        "c", "len", _name().alias("name"), _bytes(WIDTH).alias("bytes"))
    # The node above an owner's first one: found in the block that holds it.
    up = F.col("from") - 2
    above = (owners.where(F.col("from") >= 2).withColumn("j", F.expr(f"(from - 2) div {WIDTH}"))
             .join(table.drop("len"), ["c", "j"]).select("c", _name(up % WIDTH + 1).alias("name"))
             .join(found.select("name", F.col("c").alias("parent")), "name").select("c", "parent"))
    root = found.where("depth = 0").select(F.col("c").alias("root"))
    first = root.first()
    owners = stored(owners.join(above, "c", "left").join(ends.select("c", "len"), "c").withColumn(
        "parent", F.when(F.col("from") == 1, F.lit(first["root"] if first else None)).otherwise(F.col("parent"))),
        "trie-owners")
    joins = stored(owners.where("from > 0").groupBy(F.col("parent").alias("at"), (F.col("from") - 1).alias("at_depth"))
                   .agg(F.count(F.lit(1)).alias("branches")), "trie-branches")
    leaves = owners.join(joins, (F.col("c") == F.col("at")) & (F.col("len") == F.col("at_depth")), "left_anti").select(
        "c", F.lit(1).alias("leaf"))
    members = (ends.join(owners.select("c", "shared"), "c", "left").join(leaves, "c", "left")
               .select("c", F.coalesce("shared", "bytes").alias("shared"),
                       F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf")))
    nodes = rollup(table.join(members, "c"), "shared", "leaf")
    o = owners.select(F.col("c").alias("owner"), "from", "parent", "len", F.col("shared").alias("own_shared"))
    hashes = ends_sha(ends.select("name", "c"))
    return (nodes.join(o, F.col("c") == F.col("owner"))
            .join(joins, (F.col("c") == F.col("at")) & (F.col("depth") == F.col("at_depth")), "left")
            .join(hashes, F.col("name") == F.col("end_name"), "left")
            .select(F.col("c").alias("conv_id"), F.col("depth").cast("long").alias("depth"),
                    F.when(F.col("depth") > 0, F.when(F.col("depth") > F.col("from"), F.col("c"))
                           .otherwise(F.col("parent"))).alias("parent_conv_id"),
                    F.col("n").alias("n_convs"),
                    (F.coalesce("branches", F.lit(0)) + (F.col("depth") < F.col("len")).cast("long")).alias("n_children"),
                    F.col("leaf").alias("n_leaves"),
                    (F.col("shared") - F.col("own_shared") - (F.col("n") - 1) * F.col("parent_bytes")).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))

"""Substring dedup by recompression.

A window is ``WINDOW`` consecutive words. Each word covered by a window that
also starts in a document with a smaller id goes.

Naming. Word names are hashes; ``ROUNDS`` times a run round names maximal runs
of equal symbols and a pair round names pairs (a, b) with a in the left and b
in the right half of the alphabet (a bit of the name). A name is a hash of its
parts, so all tasks of a Spark stage give equal parts the same name without an
exchange. Whether a symbol forms depends on a few words around it only: its
context. Equal windows therefore hold equal symbols wherever the context lies
within the window.

Anchors. Each window picks, of its consistent symbols, the one of the least
priority (a hash of the name): equal windows pick equal anchors. The anchor's
key is a hash of its context (``MARGIN`` words on either side at least), and the
windows that share an anchor form one row (key, span, id, at, n) with ``span`` a hash
of all their words: about one row for five words. Windows without a
consistent symbol, such as those inside a long run, have themselves as key.

Reveal. Rows are shuffled by key; keys of one document are dropped. A row whose span
occurs in a document with a smaller id is wholly covered. Frequent
keys (Misra-Gries) are aggregated by (key, span) with map-side combine instead, so no
key's rows meet in one task: the first ids of their most frequent spans are looked up
where the rows lie, those of the others joined back. Texts with many equal copies
are resolved before by their digest, from broadcast winners.

Verify. Where one key has several spans (around edits), the first
rows of each span are compared window by window: by two 64-bit hashes of the
window's words, each from word names of its own, as key and span are. Documents that need this are stored
with their state; no other text is shuffled a second time.

Results for odd input: null texts have no words; texts of fewer than WINDOW
words lose none; a null id counts as larger than all others; rows with equal
ids do not cover one another; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm import exact_dedup
from ledgerloom.llm.common import checkpointed, keyed, stored

WINDOW = 13
ROUNDS = 1
MARGIN = 2
#: Bytes of text parsed at a time.
CHUNK = 1 << 20
FAR = 1 << 40

# Odd multipliers of the hashes of word sequences.
KEY_BASE, SPAN_BASE = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # the first k bytes of eight


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit finaliser: every bit of the result depends on every bit of x."""
    x = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sums:
    """Hashes of any range of a sequence, from prefix sums of a polynomial modulo 2^64."""

    powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, values: np.ndarray, base: int):
        n = len(values) + 1
        if base not in self.powers or len(self.powers[base][0]) < n:
            size = 1 << max(16, (n - 1).bit_length())
            up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            self.powers[base] = np.cumprod(up), np.cumprod(down)
        up, self.down = self.powers[base]
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(values * up[:n - 1], out=self.sums[1:])

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mix((self.sums[stops] - self.sums[starts]) * self.down[starts]
                   + (stops - starts).astype(np.uint64))


def word_names(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two independent names of every word, and the number of words of every text.

    A name mixes eight bytes of the word at a time into 64 bits; unlike a sum of powers, no pattern
    of letters makes two words cancel out. The size is mixed in first.
    """
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    white = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate(([1], white.astype(np.int8))))
    starts, stops = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    size = stops - starts
    padded = np.concatenate((raw, np.zeros(8, np.uint8)))
    first, second = mix(size, 11), mix(size, 12)
    rows, at = np.arange(len(starts)), 0
    while len(rows):
        here = starts[rows] + at
        x = np.zeros(len(rows), np.uint64)
        for k in range(8):
            x |= padded[here + k].astype(np.uint64) << np.uint64(8 * k)
        x &= _FIRST[np.minimum(size[rows] - at, 8)]
        first[rows] = mix(first[rows] ^ x, 13)
        second[rows] = mix(second[rows] + mix(x, 14), 15)
        at += 8
        rows = rows[size[rows] > at]
    ends = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(starts, ends)
    return first, second, np.diff(np.concatenate(([0], upto)))


def symbols(names: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, ...]:
    """Symbols after the rounds: name, first word, end, and the context's start and end.

    A context that reaches beyond a document's edge ends ``FAR`` away.
    """
    n = len(names)
    name, lo = names, np.arange(n)
    hi, c0, c1 = lo + 1, lo.copy(), lo + 1
    for _ in range(rounds):
        # Runs: maximal, so they depend on the symbols beside them.
        d = doc[lo]
        first = np.ones(len(name), bool)
        first[1:] = (name[1:] != name[:-1]) | (d[1:] != d[:-1])
        at = np.flatnonzero(first)
        last = np.concatenate((at[1:], [len(name)])) - 1
        long = last > at
        prev, nxt = at - 1, last + 1
        here = d[at]
        ok0 = (prev >= 0) & (d[np.maximum(prev, 0)] == here)
        ok1 = (nxt < len(name)) & (d[np.minimum(nxt, len(name) - 1)] == here)
        r0 = np.where(ok0, c0[np.maximum(prev, 0)], -FAR)
        r1 = np.where(ok1, c1[np.minimum(nxt, len(name) - 1)], FAR)
        name = np.where(long, mix(name[at] * np.uint64(3) + (last - at).astype(np.uint64), 1), name[at])
        lo, hi, c0, c1 = lo[at], hi[last], r0, r1
        # Pairs: a left symbol followed by a right one.
        d = doc[lo]
        right = (mix(name, 2) >> np.uint64(40) & np.uint64(1)).astype(bool)
        joins = np.zeros(len(name), bool)
        joins[:-1] = ~right[:-1] & right[1:] & (d[1:] == d[:-1])
        second = np.concatenate(([False], joins[:-1]))
        same_next = np.concatenate((d[1:] == d[:-1], [False]))
        same_prev = np.concatenate(([False], same_next[:-1]))
        next1 = np.where(same_next, np.concatenate((c1[1:], [FAR])), FAR)
        prev0 = np.where(same_prev, np.concatenate(([-FAR], c0[:-1])), -FAR)
        p0 = np.where(right & ~second, np.minimum(c0, prev0), c0)
        p1 = np.where(joins, next1, np.where(~right, np.maximum(c1, next1), c1))
        pair = mix(name + np.roll(mix(name, 3), -1), 4)
        hi = np.where(joins, np.concatenate((hi[1:], [0])), hi)
        name = np.where(joins, pair, name)
        keep = ~second
        name, lo, hi, c0, c1 = name[keep], lo[keep], hi[keep], p0[keep], p1[keep]
    return name, lo, hi, c0, c1


class Parsed:
    """Word hashes of a few texts, and their windows by anchor."""

    def __init__(self, texts: list[bytes]):
        self.names, second, self.counts = word_names(texts)
        self.firsts = np.cumsum(self.counts) - self.counts
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        self.by_key, self.by_span = Sums(self.names, KEY_BASE), Sums(second, SPAN_BASE)

    def anchors(self) -> tuple[np.ndarray, ...]:
        """``doc, key, span, at, n`` of every group of windows that share an anchor."""
        n = len(self.names)
        if not n:
            none = np.zeros(0, np.int64)
            return none, none.astype(np.uint64), none.astype(np.uint64), none, none
        ends = (self.firsts + self.counts)[self.doc]
        fits = np.arange(n) + WINDOW <= ends  # words that start a window
        name, lo, hi, c0, c1 = symbols(self.names, self.doc)
        a0, a1 = np.minimum(c0, lo - MARGIN), np.maximum(c1, hi + MARGIN)
        use = (a0 >= 0) & (a1 <= n) & (a1 - a0 <= WINDOW)
        a0, a1, rank = a0[use], a1[use], mix(name[use], 6)
        best = np.full(n, np.iinfo(np.uint64).max, np.uint64)
        who = np.full(n, len(a0))
        steps = []
        for t in range(WINDOW):  # windows that start t words before the anchor's context
            at = np.flatnonzero((a1 - a0 + t <= WINDOW) & (a0 >= t))
            at = at[fits[a0[at] - t]]
            steps.append((at, a0[at] - t))
            np.minimum.at(best, steps[-1][1], rank[at])
        for at, s in steps:
            won = rank[at] == best[s]
            np.minimum.at(who, s[won], at[won])
        starts = np.flatnonzero(fits)
        anchor = who[starts]
        own = anchor == len(a0)  # windows without a consistent symbol
        key = np.empty(len(starts), np.uint64)
        key[~own] = self.by_key.of(a0[anchor[~own]], a1[anchor[~own]])
        key[own] = mix(self.by_key.of(starts[own], starts[own] + WINDOW), 7)
        new = np.ones(len(starts), bool)
        new[1:] = ((np.diff(starts) != 1) | (np.diff(anchor) != 0) | (self.doc[starts[1:]] != self.doc[starts[:-1]])
                   | (own[1:] & (key[1:] != key[:-1])))
        at = np.flatnonzero(new)
        count = np.diff(np.concatenate((at, [len(starts)])))
        s = starts[at]
        shift = np.where(own[at], 0, s - a0[np.minimum(anchor[at], len(a0) - 1)] if len(a0) else 0)
        span = self.by_span.of(s, np.where(own[at], s, s + count - 1) + WINDOW)
        span = mix(span + np.where(own[at], 0, shift * 64 + count).astype(np.int64).astype(np.uint64), 8)
        return self.doc[s], key[at], span, s - self.firsts[self.doc[s]], count


def chunks(texts: Iterator[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in groups of about CHUNK bytes, with the number of the first."""
    first, group, size = 0, [], 0
    for i, t in enumerate(texts):
        group.append(t)
        size += len(t) + 1
        if size >= CHUNK:
            yield first, group
            first, group, size = i + 1, [], 0
    if group:
        yield first, group


def covered(words: int, at: list[int], n: list[int]) -> np.ndarray:
    """Which words the windows starting at ``at .. at + n - 1`` cover."""
    edge = np.zeros(words + 1, np.int64)
    a = np.array(at, np.int64)
    np.add.at(edge, a, 1)
    np.add.at(edge, a + np.array(n, np.int64) - 1 + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def word_digests(docs: DataFrame, key: str, kind: str) -> DataFrame:
    """``key, doc_id, id, n_words, digest`` (SHA-256 of the words joined by one space)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, digest = [], []
            for t in b.column(2):  # one text's words at a time
                words = (t.as_py() or b"").split()
                n.append(len(words))
                digest.append(hashlib.sha256(b" ".join(words)).digest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(digest, pa.binary())],
                ["key", "doc_id", "n_words", "digest"])

    return docs.select(F.col(key).alias("key"), "doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, f"key long, doc_id {kind}, n_words long, digest binary")


def anchor_rows(docs: DataFrame, key: str, gone: dict[bytes, int]) -> DataFrame:
    """Anchor rows ``akey, span, key, id, at, n`` of all texts but the copies of ``gone``."""
    shared = docs.sparkSession.sparkContext.broadcast(gone)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False)
            ids = b.column(1).to_numpy(zero_copy_only=False)

            def text(i: int, t, ids=ids) -> bytes:
                t = t.as_py() or b""
                if known and known.get(hashlib.sha256(b" ".join(t.split())).digest(), ids[i]) < ids[i]:
                    return b""
                return t

            for first, group in chunks(text(i, t) for i, t in enumerate(b.column(2))):
                doc, akey, span, at, n = Parsed(group).anchors()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(akey.view(np.int64)), pa.array(span.view(np.int64)), pa.array(keys[first + doc]),
                     pa.array(ids[first + doc]), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))],
                    ["akey", "span", "key", "id", "at", "n"])

    return docs.select(F.col(key).alias("key"), order_id().alias("id"),
                       F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "akey long, span long, key long, id long, at int, n int")


def order_id():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))


def frequent_keys(rows: DataFrame, k: int) -> DataFrame:
    """At most k keys, among them all of more than 2N/(k+1) rows: a Misra-Gries summary per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, total = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for b in batches:
            x, n = np.unique(b.column(0).to_numpy(), return_counts=True)
            total += int(n.sum())
            both, at = np.unique(np.concatenate((keys, x)), return_inverse=True)
            sums = np.bincount(at, np.concatenate((counts, n)), len(both)).astype(np.int64)
            cut = np.partition(sums, -k - 1)[-k - 1] if len(sums) > k else 0
            keys, counts = both[sums > cut], (sums - cut)[sums > cut]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(counts), pa.array(np.zeros(len(keys), np.int64))], ["akey", "n", "total"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([0]), pa.array([total])],
                                         ["akey", "n", "total"])

    found = checkpointed(rows.select("akey").mapInArrow(run, "akey long, n long, total long").groupBy("akey").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")))
    total = found.where("akey is null").agg(F.sum("total").alias("t")).first()["t"] or 0
    return found.where("akey is not null").where(F.col("n") * (k + 1) > F.lit(total)).select("akey")


def reveal(rows: DataFrame, counters: int) -> DataFrame:
    """Rows that matter: ``key, id, at, n, sure`` (covered, or to compare by window)."""
    frequent = [r["akey"] for r in frequent_keys(rows, counters).collect()]  # at most ``counters`` numbers
    some, is_hot = bool(frequent), F.col("akey").isin(frequent)
    rest = rows.where(~is_hot) if some else rows
    one, many = W.partitionBy("akey"), W.partitionBy("akey", "span")
    rest = (rest.repartition("akey").withColumn("lo", F.min("id").over(one)).withColumn("hi", F.max("id").over(one))
            .where("lo < hi").withColumn("s0", F.min("span").over(one)).withColumn("s1", F.max("span").over(one))
            .withColumn("first", F.min("id").over(many)))
    both = rest.select("key", "id", "at", "n", "first", "s0", "s1")
    if some:
        hot = stored(rows.where(is_hot), "substring-hot")
        by_span = stored(hot.groupBy("akey", "span").agg(
            F.min("id").alias("first"), F.max("id").alias("top"), F.count(F.lit(1)).alias("rows")), "substring-spans")
        by_key = by_span.groupBy("akey").agg(F.min("first").alias("lo"), F.max("top").alias("hi"),
                                             F.min("span").alias("s0"), F.max("span").alias("s1")).where("lo < hi")
        # The most frequent spans, at most ``counters``, are looked up where the rows lie.
        most = by_span.where(F.col("rows") * (counters + 1) > F.lit(hot.count())).select("span", "first").collect()
        known = (F.create_map(*(F.lit(x) for r in most for x in (r["span"], r["first"]))) if most
                 else F.lit(None).cast("map<bigint,bigint>"))
        hot = hot.withColumn("known", F.try_element_at(known, F.col("span")))
        zero = F.lit(0).cast("long")
        both = both.unionByName(hot.where("id > known").select(
            "key", "id", "at", "n", F.col("known").alias("first"), zero.alias("s0"), zero.alias("s1")))
        hot = hot.where("known is null or id <= known").drop("known").join(
            by_span.select("akey", "span", "first").join(F.broadcast(by_key), "akey"), ["akey", "span"])
        both = both.unionByName(hot.select("key", "id", "at", "n", "first", "s0", "s1"))
    return both.withColumn("sure", F.col("id") > F.col("first")).where("sure or s0 != s1").select(
        "key", "id", "at", "n", "sure")


def dedup(docs: DataFrame, counters: int = exact_dedup.COUNTERS) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs, key = keyed(docs.select("doc_id", "text"))
    base = stored(word_digests(docs, key, kind), "substring-words")
    ids = base.select("digest", order_id().alias("doc_id"), F.col("key"), "n_words")
    copies = exact_dedup.heavy_hitters(ids.where(F.col("n_words") >= WINDOW), counters, least=True)
    gone = {bytes(r["digest"]): r["keep"]["doc_id"] for r in copies.collect()}  # at most ``counters`` rows
    rows = reveal(anchor_rows(docs, key, gone), counters)
    of = rows.groupBy("key").agg(
        F.collect_list(F.when(F.col("sure"), F.struct("at", "n"))).alias("sure"),
        F.collect_list(F.when(~F.col("sure"), F.struct("at", "n"))).alias("maybe")).withColumnRenamed("key", "rkey")
    text = docs.select(F.col(key).alias("key"), order_id().alias("id"), F.col("text").cast("binary").alias("text"))
    met = text.join(of, F.col("key") == F.col("rkey")).drop("rkey")
    state = stored(met.mapInArrow(apply_sure, "key long, id long, n_removed long, kept binary, text binary, "
                                              "covers array<int>, maybe array<struct<at: int, n: int>>"),
                   "substring-state")
    done = state.where("maybe is null").select("key", "n_removed", "kept")
    open_ = state.where("maybe is not null")
    windows = open_.select("key", "id", "text", "maybe").mapInArrow(
        window_rows, "key long, id long, h1 long, h2 long, at int")
    least = windows.groupBy("h1", "h2").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    hits = (windows.join(least, ["h1", "h2"]).where("id > lo").groupBy("key")
            .agg(F.collect_set("at").alias("more")).withColumnRenamed("key", "mkey"))
    late = open_.select("key", "text", "covers").join(hits, F.col("key") == F.col("mkey"), "left").drop("mkey")
    late = late.mapInArrow(apply_more, "key long, n_removed long, kept binary")
    got = done.unionByName(late).toDF("gkey", "n_removed", "kept")
    whole = F.broadcast(copies.select(F.col("digest").alias("wdigest"), F.col("keep.doc_id").alias("wid")))
    out = base.join(got, F.col("key") == F.col("gkey"), "left").join(
        whole, (F.col("digest") == F.col("wdigest")) & (F.col("wid") < order_id()), "left")
    all_gone = F.col("wid").isNotNull()
    return out.select("doc_id", "n_words",
                      F.when(all_gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long")
                      .alias("n_removed"),
                      F.when(all_gone, F.sha2(F.lit("").cast("binary"), 256))
                      .otherwise(F.lower(F.hex(F.coalesce("kept", "digest")))).alias("kept_sha256"))


def kept_digest(words: list[bytes], mask: np.ndarray) -> bytes:
    return hashlib.sha256(b" ".join([w for w, m in zip(words, mask, strict=True) if not m])).digest()


def apply_sure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cover what is sure; documents with rows to compare keep their text and cover."""
    for b in batches:
        out = []
        for t, sure, maybe in zip(b.column(2), b.column(3), b.column(4), strict=True):
            t, sure, maybe = t.as_py() or b"", sure.as_py(), maybe.as_py()
            words = t.split()
            mask = covered(len(words), [x["at"] for x in sure], [x["n"] for x in sure])
            if maybe:
                edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
                out.append((0, b"", t, edge.tolist(), maybe))
            else:
                out.append((int(mask.sum()), kept_digest(words, mask), None, None, None))
        cols = list(zip(*out, strict=True)) if out else [[]] * 5
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()),
                 pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())]))]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), *(pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True))],
            ["key", "id", "n_removed", "kept", "text", "covers", "maybe"])


def window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two hashes of every window to compare."""
    for b in batches:
        keys, ids = b.column(0).to_numpy(), b.column(1).to_numpy()
        for first, group in chunks(t.as_py() or b"" for t in b.column(2)):
            parsed = Parsed(group)
            doc, at = [], []
            for i in range(len(group)):
                for x in b.column(3)[first + i].as_py():
                    at += range(x["at"], x["at"] + x["n"])
                    doc += [i] * x["n"]
            d, a = np.array(doc, np.int64), np.array(at, np.int64)
            s = parsed.firsts[d] + a
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[first + d]), pa.array(ids[first + d]),
                 pa.array(parsed.by_key.of(s, s + WINDOW).view(np.int64)),
                 pa.array(parsed.by_span.of(s, s + WINDOW).view(np.int64)), pa.array(a.astype(np.int32))],
                ["key", "id", "h1", "h2", "at"])


def apply_more(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the windows found by comparison to the cover."""
    for b in batches:
        removed, kept = [], []
        for t, edge, more in zip(b.column(1), b.column(2), b.column(3), strict=True):
            words = (t.as_py() or b"").split()
            mark = np.zeros(len(words) + 1, np.int64)
            mark[np.array(edge.as_py()[::2], np.int64)] += 1
            mark[np.array(edge.as_py()[1::2], np.int64)] -= 1
            at = more.as_py() or []
            mask = (np.cumsum(mark[:-1]) > 0) | covered(len(words), at, [1] * len(at))
            removed.append(int(mask.sum()))
            kept.append(kept_digest(words, mask))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                                         ["key", "n_removed", "kept"])

"""Interaction audit of quality filters: what each one removes in every order of application.

1. One pass over the UTF-8 bytes of every whole text, by a table-driven
   transducer: the byte and the state before it (in a word or not) look up the
   next state and what is emitted (word start, capital, code point, symbol).
   The next state depends on the byte alone, so a chunk of texts takes table
   look-ups on arrays. The same pass inserts the word spans into an open-addressed hash
   table whose hits are verified byte by byte, which counts distinct words.
2. The per-text measures and a SHA-256 of the text are stored once; texts are
   never shuffled. A row repeats an earlier text if its id is not the smallest of its digest:
   an aggregate with map-side combine, joined back on (digest, id), so that
   a large group of copies spreads over all tasks.
3. Rows are counted by (part, set of failed filters) with map-side combine. All
   orders follow from these at most 2^k counts per part: a filter removes the rows
   that fail it and none before it; averaged over all orders each filter of a
   row's failed set comes first equally often, which gives the Shapley sums.

Results for odd input: a null text is empty and fails A but none of B to D; a null
``lang`` is the part ''; a null id has no smaller id, so it never fails E and has no labels; repeated
ids with one text do not repeat each other; of several label rows of an id any positive one counts;
bytes that are no UTF-8 count as code points unless they are continuation bytes; an empty table gives no
rows; other columns are never read. Memory: chunks of ``CHUNK`` bytes, or one text if it is longer, at about
ten times that size.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

#: Bytes of text measured at a time.
CHUNK = 1 << 21
#: The filters' letters: the conditions of ``filters``, then E (repeats a smaller id's text).
LETTERS = "ABCDE"

# Emitted by the transducer.
START, CAPITAL, POINT, SYMBOL = 1, 2, 4, 8
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#$%&*|"


def transducer() -> tuple[np.ndarray, np.ndarray]:
    """``step[byte]``: the state after it (1: in a word); ``emit[state << 8 | byte]``."""
    byte = np.arange(256)
    step = (~np.isin(byte, list(SPACES))).astype(np.uint8)
    out = (CAPITAL * ((byte >= 65) & (byte <= 90)) + POINT * ((byte & 0xC0) != 0x80)
           + SYMBOL * np.isin(byte, list(SYMBOLS))).astype(np.uint8)
    return step, np.concatenate([out | step * np.uint8(START), out])


STEP, EMIT = transducer()
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # the first k bytes of eight
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


class Words:
    """Word spans of a chunk: eight bytes of a word at a time."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray):
        self.raw = np.concatenate([raw, np.zeros(8, np.uint8)])
        self.starts, self.size, self.doc = starts, ends - starts, doc
        self.head = self.load(np.arange(len(starts)), 0)
        h = _mix(self.head ^ (self.size.astype(np.uint64) << np.uint64(40)) ^ doc.astype(np.uint64) * _MIX)
        rows, at = np.flatnonzero(self.size > 8), 8
        while len(rows):
            h[rows] = _mix(h[rows] ^ self.load(rows, at))
            at += 8
            rows = rows[self.size[rows] > at]
        self.hash = h

    def load(self, rows: np.ndarray, at: int) -> np.ndarray:
        """Bytes ``at`` to ``at + 8`` of the words as one number, zeros past their ends."""
        first = self.starts[rows] + at
        x = np.zeros(len(rows), np.uint64)
        for k in range(8):
            x |= self.raw[first + k].astype(np.uint64) << np.uint64(8 * k)
        return x & _KEEP[np.minimum(self.size[rows] - at, 8)]

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Are the words a and b of one document and equal in every byte?"""
        out = (self.doc[a] == self.doc[b]) & (self.size[a] == self.size[b]) & (self.head[a] == self.head[b])
        at, rows = 8, np.flatnonzero(out & (self.size[a] > 8))
        while len(rows):
            differ = self.load(a[rows], at) != self.load(b[rows], at)
            out[rows[differ]] = False
            at += 8
            rows = rows[~differ & (self.size[a[rows]] > at)]
        return out

    def distinct(self) -> np.ndarray:
        """The first inserted word of every distinct (document, word)."""
        n = len(self.starts)
        bits = max(4, int(2 * n).bit_length())
        table = np.full(1 << bits, -1, np.int64)
        slot = (self.hash >> np.uint64(64 - bits)).astype(np.int64)
        pending = np.arange(n)
        new = []
        while len(pending):
            at = slot[pending]
            free = table[at] < 0
            table[at[free]] = pending[free]
            held = table[at]
            new.append(pending[held == pending])
            pending = pending[~self.same(pending, held)]
            slot[pending] = (slot[pending] + 1) & ((1 << bits) - 1)
        return np.concatenate(new) if new else np.zeros(0, np.int64)


def _by_doc(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the sorted positions lie in each document."""
    return np.diff(np.searchsorted(positions, offsets))


def measures(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Counts for every document of a chunk; document i is ``raw[offsets[i]:offsets[i + 1]]``."""
    state = STEP[raw]
    full = offsets[:-1] < offsets[1:]
    before = np.zeros_like(state)
    before[1:] = state[:-1]
    before[offsets[:-1][full]] = 0
    out = EMIT[before.astype(np.uint16) << 8 | raw]
    last = np.ones_like(state)  # a word ends where the next byte is none of it
    last[:-1] = 1 - state[1:]
    last[offsets[1:][full] - 1] = 1
    starts, ends = np.flatnonzero(out & START), np.flatnonzero(state & last) + 1
    words = _by_doc(starts, offsets)
    doc = np.repeat(np.arange(len(words)), words)
    spans = Words(raw, starts, ends, doc)
    new = spans.distinct()
    points = np.concatenate(([0], np.cumsum((out & POINT) != 0, dtype=np.int64)))
    return {"words": words, "distinct_words": np.bincount(doc[new], minlength=len(words)),
            "capitals": _by_doc(np.flatnonzero(out & CAPITAL), offsets),
            "code_points": np.diff(points[offsets]), "symbols": _by_doc(np.flatnonzero(out & SYMBOL), offsets)}


NAMES = ["words", "distinct_words", "capitals", "code_points", "symbols"]


def chunks(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``size`` bytes, at least one document each."""
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield a, b
        a = b


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column end to end, and the offsets of its values."""
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def measure(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, part, words, distinct_words, capitals, code_points, symbols, digest`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = texts_of(batch.column(2))
            parts = [measures(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                     for a, b in chunks(offsets, chunk)]
            digests = [hashlib.sha256(raw[a:b]).digest() for a, b in itertools.pairwise(offsets)]
            counts = [pa.array(np.concatenate([p[x] for p in parts]) if parts else [], pa.int64()) for x in NAMES]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *counts, pa.array(digests, pa.binary())],
                ["doc_id", "part", *NAMES, "digest"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select(
        F.col("doc_id").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(
        run, f"doc_id {kind}, part string, " + ", ".join(f"{x} long" for x in NAMES) + ", digest binary")


def filters() -> dict[str, Column]:
    """The failure conditions on one text's measures."""
    return {"A": F.col("words") < 200,
            "B": 100 * F.col("distinct_words") < 50 * F.col("words"),
            "C": 100 * F.col("capitals") > 3 * F.col("code_points"),
            "D": F.col("symbols") > 0}


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, part, failed`` (bit i: fails the i-th letter), ``good, toxic`` for every row of ``docs``."""
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(filters().values())), F.lit(0))
    rows = stored(measure(docs).select("doc_id", "part", bits.alias("failed"), "digest"), "audit-measures")
    of = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic")).where("good + toxic > 0")
    first = rows.where(F.col("doc_id").isNotNull()).groupBy(F.col("digest").alias("first_digest")).agg(
        F.min("doc_id").alias("first_id"))
    repeats = F.col("doc_id").isNotNull() & F.col("first_id").isNull()
    last = 1 << len(filters())
    return (rows.join(first, (F.col("digest") == F.col("first_digest")) & (F.col("doc_id") == F.col("first_id")), "left")
            .join(of, F.col("doc_id") == F.col("label_id"), "left")
            .select("doc_id", "part", (F.col("failed") + F.when(repeats, last).otherwise(0)).alias("failed"),
                    F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")))


def orders(letters: str) -> list[dict]:
    """Every (order, step): the filter's bit and the bits of those before it."""
    bit = {c: 1 << i for i, c in enumerate(letters)}
    return [{"filter_order": "".join(o), "step": i + 1, "bit": bit[c], "earlier": sum(bit[x] for x in o[:i])}
            for o in itertools.permutations(letters) for i, c in enumerate(o)]


def interactions(failed: DataFrame, letters: str = LETTERS) -> DataFrame:
    """The audit of ``part, failed, good, toxic`` rows: one row per part, order and step."""
    one = F.lit(1).cast("long")
    cells = failed.groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("good").cast("long")).alias("good"),
        F.sum(F.col("toxic").cast("long")).alias("toxic"))
    plan = F.from_json(F.lit(json.dumps(orders(letters))),
                       "array<struct<filter_order:string,step:int,bit:int,earlier:int>>")
    fails = F.col("failed").bitwiseAND(F.col("bit")) != 0
    gone = F.col("failed").bitwiseAND(F.col("earlier")) != 0
    share = F.when(fails, F.col("n") * F.expr(f"{math.factorial(len(letters))} div bit_count(failed)"))

    def total(column: Column, where: Column) -> Column:
        return F.sum(F.when(where, column * one).otherwise(0))

    return (cells.select("*", F.inline(plan)).groupBy("part", "filter_order", "step").agg(
        total(F.col("n"), ~fails & ~gone).alias("kept"), total(F.col("n"), fails & ~gone).alias("removed"),
        total(F.col("n"), fails & gone).alias("redundant"),
        total(F.col("n"), F.col("failed") == F.col("bit")).alias("unique_fails"),
        total(F.col("good"), fails & ~gone).alias("good_lost"),
        total(F.col("toxic"), fails & ~gone).alias("toxic_lost"),
        F.coalesce(F.sum(share), F.lit(0)).cast("long").alias("shapley")))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``."""
    return interactions(failures(docs, labels))

"""Byte-level BPE by rank file, with vectorised pre-tokenisation.

1. Texts become arrays of code points, and a class array (one byte per code
   point of Unicode) maps them to twelve symbols: space, other white space,
   letters (those of the contractions apart), numbers, apostrophe, others and a reset before every text.
2. The word pattern is a small automaton over these symbols. A symbol's
   transition function is an element of a finite monoid, and composition is
   associative, so a blocked prefix scan over composition tables gives the
   state at every character of a chunk at once, whatever the texts' lengths. States and symbols
   emit the word boundaries, at the character or the one before it (a run of
   white space or a contraction shows its end one character late). No regular expression runs over a text.
3. The slices between boundaries tile the chunk's bytes. Each distinct slice is merged once
   and cached by the Python worker: slices of one length form a matrix, whose rows each merge their
   lowest-ranked, leftmost pair per step; long slices use a heap.
4. Ids and token offsets of every text stay beside each other: decoding takes each
   id's bytes from the rank table and cuts them by the offsets.

There is one pass over the texts, no shuffle and nothing that grows with the corpus. The class array
follows the tables of the installed tiktoken, whose results the ids equal.

Results for odd input: a null or empty text has no tokens; null and repeated ids keep a row for every row;
bytes that are no UTF-8 are read as U+FFFD; special tokens' strings are ordinary text; an empty table gives
no rows; other columns are never read. Memory: chunks of ``CHUNK`` bytes, or one text if it is longer, at about
25 times that size.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.bpe import Ragged
from ledgerloom.llm.filter_audit import chunks, texts_of

#: Bytes of text encoded at a time, and tokens turned into digests at a time.
CHUNK = 1 << 22
TOKENS = 1 << 18
#: Characters of a block of the scan.
BLOCK = 64
#: Slices longer than this are merged by a heap.
LONG = 64
#: Slices that a worker remembers, of at most LONG bytes each.
CACHE = 1 << 19

# Symbols of the automaton.
RESET, BLANK, SPACE, LETTER, NUMBER, OTHER, APOSTROPHE, ONE, R, V, L, E = range(12)
_LETTERS = (LETTER, ONE, R, V, L, E)
# Its states: after the reset, in a run of one kind, after one or more blanks or
# spaces, after a leading apostrophe, with its r, v or l, and after a contraction.
(BEGIN, WORD, DIGITS, SIGNS, BLANK1, BLANKS, SPACE1, SPACES, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, DONE) = range(13)
#: Emitted: a boundary before this symbol, a boundary before the previous one.
HERE, LATE = 1, 2


def automaton() -> tuple[np.ndarray, np.ndarray]:
    """``step[state, symbol]`` and ``emit[state, symbol]`` of the word pattern.

    's|'t|'re|'ve|'m|'ll|'d| ?letters| ?numbers| ?others|white space not before a character|white space
    """
    step, emit = np.zeros((13, 12), np.uint8), np.zeros((13, 12), np.uint8)
    half = {QUOTE_R: E, QUOTE_V: E, QUOTE_L: L}
    for s in range(13):
        open_blank = s in (BLANK1, BLANKS)  # a blank joins what follows it
        runs = s in (BLANKS, SPACES)        # the last of several white spaces is cut off before a character
        for c in range(12):
            late = LATE * (runs or s in half)
            if c == RESET:
                step[s, c], emit[s, c] = BEGIN, LATE * (s in half)
            elif c in (BLANK, SPACE):
                several = s in (BLANK1, BLANKS, SPACE1, SPACES)
                step[s, c] = (BLANKS if several else BLANK1) if c == BLANK else (SPACES if several else SPACE1)
                emit[s, c] = (0 if several else HERE) | LATE * (s in half)
            elif s in half and c == half[s]:
                step[s, c] = DONE
            elif s == QUOTE and c in (ONE, R, V, L):
                step[s, c] = {ONE: DONE, R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}[c]
            elif c in _LETTERS:
                goes_on = s == WORD or s in half or open_blank
                step[s, c], emit[s, c] = WORD, (0 if goes_on else HERE) | late
            elif c == NUMBER:
                step[s, c], emit[s, c] = DIGITS, (0 if s == DIGITS or open_blank else HERE) | late
            else:
                goes_on = s in (SIGNS, QUOTE) or open_blank
                step[s, c] = QUOTE if c == APOSTROPHE and not goes_on else SIGNS
                emit[s, c] = (0 if goes_on else HERE) | late
    return step, emit


class Monoid:
    """The transition functions of the automaton, closed under composition."""

    def __init__(self, step: np.ndarray):
        states, symbols = step.shape
        found = [tuple(range(states))]
        index = {found[0]: 0}
        rows = []
        for f in found:  # grows while it is read
            row = []
            for c in range(symbols):
                g = tuple(int(step[s, c]) for s in f)
                if g not in index:
                    index[g] = len(found)
                    found.append(g)
                row.append(index[g])
            rows.append(row)
        self.functions = np.array(found, np.uint8)
        #: ``then[f * symbols + c]``: f, then the symbol c.
        self.then = np.array(rows, np.uint16).ravel()
        self.symbols = symbols
        #: ``both[f, g]``: f, then g.
        self.both = np.array([[index[tuple(g[x] for x in f)] for g in found] for f in found], np.uint16)

    def scan(self, f: np.ndarray) -> np.ndarray:
        """Inclusive prefix compositions, by doubling."""
        f, k = f.copy(), 1
        while k < len(f):
            f[k:] = self.both[f[:-k], f[k:]]
            k *= 2
        return f

    def states(self, symbols: np.ndarray, entry: int) -> np.ndarray:
        """The state after every symbol: prefixes inside blocks, then over the blocks."""
        n = len(symbols)
        blocks = -(-n // BLOCK)
        padded = np.zeros(blocks * BLOCK, np.uint16)
        padded[:n] = symbols
        by_place = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
        prefix = np.empty((BLOCK, blocks), np.uint16)
        held = np.zeros(blocks, np.uint16)
        for i in range(BLOCK):
            held = self.then[held * np.uint16(self.symbols) + by_place[i]]
            prefix[i] = held
        before = np.full(blocks, entry, np.uint8)
        before[1:] = self.functions[self.scan(held)[:-1], entry]
        return self.functions[prefix, before].T.reshape(-1)[:n]


STEP, EMIT = automaton()


@lru_cache(maxsize=1)
def monoid() -> Monoid:
    return Monoid(STEP)


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The symbol of every code point, by the character tables of the installed tiktoken."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))

    def members(kind: str) -> np.ndarray:
        one = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)},
                                special_tokens={})
        return np.frombuffer(one.decode_bytes(one.encode_ordinary(every)).decode().encode("utf-32-le"), "<u4")

    table = np.full(0x110000, OTHER, np.uint8)
    for kind, symbol in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        table[members(kind)] = symbol
    for chars, symbol in ((" ", BLANK), ("'", APOSTROPHE), ("stmd", ONE), ("r", R), ("v", V), ("l", L), ("e", E)):
        table[[ord(c) for c in chars]] = symbol
    return table


def boundaries(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """First characters of the words of a chunk; ``firsts``: the first character of each text (or the end)."""
    symbols = np.insert(classes()[points], firsts, RESET)
    states = monoid().states(symbols, BEGIN)
    before = np.concatenate(([np.uint8(BEGIN)], states[:-1])) if len(states) else states
    out = EMIT[before, symbols]
    starts = (out & HERE) != 0
    starts[:-1] |= (out[1:] & LATE) != 0
    if len(states):  # a pending contraction at the very end is cut as before a reset
        starts[-1] |= bool(EMIT[states[-1], RESET] & LATE)
    return np.flatnonzero(starts[symbols != RESET])


class Vocabulary:
    """Ranks, the pairs that merge, and every id's bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        table = [b""] * (max(self.ranks.values()) + 1)
        for piece, i in self.ranks.items():
            table[i] = piece
        self.pieces = Ragged(np.frombuffer(b"".join(table), np.uint8), np.array([len(x) for x in table]))
        numbers = [b"%d " % i for i in range(len(table))]
        self.numbers = Ragged(np.frombuffer(b"".join(numbers), np.uint8), np.array([len(x) for x in numbers]))
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [(self.ranks[p[:i]] << 32 | self.ranks[p[i:]], r) for p, r in self.ranks.items()
                 for i in range(1, len(p)) if p[:i] in self.ranks and p[i:] in self.ranks]
        pairs.sort()
        self.pairs = np.array([a for a, _ in pairs], np.int64)
        self.merged = np.array([r for _, r in pairs], np.int64)
        self.none = len(table)
        self.own = {piece: r.to_bytes(4, "little") for piece, r in self.ranks.items()}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids joined; ``none`` where it is no piece."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.merged[at], self.none)

    def merge(self, raw: np.ndarray) -> list[bytes]:
        """Ids (little-endian, four bytes each) of slices of one length, one per row."""
        ids = self.byte[raw]
        n, width = ids.shape
        out: list[bytes] = [b""] * n
        row = np.arange(n)
        size = width
        rank = self.rank(ids[:, :-1], ids[:, 1:]) if width > 1 else np.zeros((n, 0), np.int64)
        while len(row):
            best = rank.argmin(1) if size > 1 else np.zeros(len(row), np.int64)
            done = rank[np.arange(len(row)), best] == self.none if size > 1 else np.ones(len(row), bool)
            if done.any():
                for i, x in zip(row[done].tolist(), ids[done].astype("<u4"), strict=True):
                    out[i] = x.tobytes()
                row, ids, rank, best = row[~done], ids[~done], rank[~done], best[~done]
                if not len(row):
                    break
            size -= 1  # the pair at ``best`` becomes one id, what follows moves up by one
            here = np.arange(len(row))
            one = rank[here, best]
            at = np.arange(size)
            ids = np.take_along_axis(ids, at + (at > best[:, None]), 1)
            ids[here, best] = one
            at = np.arange(size - 1)
            rank = np.take_along_axis(rank, at + (at >= best[:, None]), 1)
            left, right = np.flatnonzero(best > 0), np.flatnonzero(best < size - 1)
            rank[left, best[left] - 1] = self.rank(ids[left, best[left] - 1], ids[left, best[left]])
            rank[right, best[right]] = self.rank(ids[right, best[right]], ids[right, best[right] + 1])
        return out

    def merge_long(self, piece: bytes) -> bytes:
        """The same for one slice of any length, by a heap of pairs over a linked list."""
        get, n = self.ranks.get, len(piece)
        end = list(range(1, n + 1))  # end[i]: where the part that starts at i ends
        back = list(range(-1, n))    # back[i]: where the part that ends at i starts
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] == n or end[end[i]] != stop:
                continue
            alive[end[i]] = False
            end[i], back[stop] = stop, i
            if stop < n and (x := get(piece[i:end[stop]])) is not None:
                heapq.heappush(heap, (x, i, end[stop]))
            if i and (x := get(piece[back[i]:stop])) is not None:
                heapq.heappush(heap, (x, back[i], stop))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i:end[i]]])
            i = end[i]
        return np.array(ids, "<u4").tobytes()

    def encode(self, slices: list[bytes]) -> list[bytes]:
        """Ids of distinct slices; a slice that is a piece is its own id."""
        whole = list(map(self.own.get, slices))
        same: dict[int, list[int]] = {}
        for i, x in enumerate(whole):
            if x is None:
                same.setdefault(len(slices[i]), []).append(i)
        for size, rows in same.items():
            got = [slices[i] for i in rows]
            merged = map(self.merge_long, got) if size > LONG else self.merge(
                np.frombuffer(b"".join(got), np.uint8).reshape(-1, size))
            for i, x in zip(rows, merged, strict=True):
                whole[i] = x
        return whole


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[Vocabulary, dict[bytes, bytes]]:
    """The rank file and this worker's cache of merged slices."""
    return Vocabulary(path), {}


def encode_slices(slices: pa.Array, path: str) -> Ragged:
    """Ids of distinct slices, cached for short ones."""
    vocab, cache = vocabulary(path)
    pieces = slices.to_pylist()
    ids = list(map(cache.get, pieces))
    missing = [i for i, x in enumerate(ids) if x is None]
    fresh = [pieces[i] for i in missing]
    if len(cache) + len(fresh) > CACHE:
        cache.clear()
    for i, piece, x in zip(missing, fresh, vocab.encode(fresh), strict=True):
        ids[i] = x
        if len(piece) <= LONG:
            cache[piece] = x
    if len(cache) > CACHE:  # one chunk of more distinct slices
        cache.clear()
    return Ragged(np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4)


def encode_chunk(raw: np.ndarray, offsets: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a chunk's texts end to end, and each text's token offset."""
    points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), "<u4")
    width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF).astype(np.int64)
    at = np.concatenate(([0], np.cumsum(width)))
    starts = at[boundaries(points, np.searchsorted(at, offsets[:-1]))]
    ends = np.concatenate((starts, [len(raw)])).astype(np.int32)
    slices = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(raw)])
    coded = slices.dictionary_encode()
    table = encode_slices(coded.dictionary, path)
    ids, n = table.take(coded.indices.to_numpy(zero_copy_only=False))
    tokens = np.concatenate(([0], np.cumsum(n)))[np.searchsorted(starts, offsets)]
    return ids, tokens


def valid(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts as UTF-8; bytes that are none become U+FFFD."""
    try:
        raw.tobytes().decode()
        lead = (raw & 0xC0) != 0x80
        cuts = offsets[:-1][offsets[:-1] < len(raw)]
        if lead[cuts].all():
            return raw, offsets
    except UnicodeDecodeError:
        pass
    texts = [raw[a:b].tobytes().decode("utf-8", "replace").encode()
             for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return (np.frombuffer(b"".join(texts), np.uint8),
            np.concatenate(([0], np.cumsum([len(x) for x in texts], dtype=np.int64))))


def shas(ids: np.ndarray, tokens: np.ndarray, table: Ragged, drop: int = 0) -> list[str]:
    """SHA-256 of every text's ids' bytes in ``table``, without the last ``drop``; long texts in pieces."""
    out = []
    for a, b in chunks(tokens, TOKENS):
        first, last = tokens[a], tokens[b]
        if last - first > TOKENS:  # one text
            h = hashlib.sha256()
            for x in range(first, last, TOKENS):
                got = table.take(ids[x:min(x + TOKENS, last)])[0]
                h.update(got[:len(got) - drop * (x + TOKENS >= last)].tobytes())
            out.append(h.hexdigest())
            continue
        flat, n = table.take(ids[first:last])
        at = np.concatenate(([0], np.cumsum(n)))[tokens[a:b + 1] - first].tolist()
        raw = memoryview(flat.tobytes())
        out += [hashlib.sha256(raw[i:j - drop if j > i else j]).hexdigest()
                for i, j in zip(at[:-1], at[1:], strict=True)]
    return out


def decode(ids: np.ndarray, path: str) -> bytes:
    """The bytes of the ids."""
    return vocabulary(path)[0].pieces.take(np.asarray(ids, np.int64))[0].tobytes()


def _apply(docs: DataFrame, path: str, result, schema: str, kinds: list[pa.DataType]) -> DataFrame:
    """``doc_id`` and ``result(ids, token offsets)`` of every row."""
    names = ["doc_id", *(x.split()[0] for x in schema.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = valid(*texts_of(batch.column(1)))
            for a, b in chunks(offsets, CHUNK):
                ids, tokens = encode_chunk(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], path)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     *(pa.array(x, k) for x, k in zip(result(ids.astype(np.int64), tokens), kinds, strict=True))], names)

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select(F.col("doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text")) \
        .mapInArrow(run, f"doc_id {kind}, {schema}")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` of every row of ``docs``."""
    return _apply(docs, path, lambda ids, tokens: (
        [ids[a:b] for a, b in zip(tokens[:-1], tokens[1:], strict=True)],), "ids array<int>", [pa.list_(pa.int32())])


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row of ``docs``."""

    def summary(ids: np.ndarray, tokens: np.ndarray) -> tuple:
        vocab = vocabulary(path)[0]
        return np.diff(tokens), shas(ids, tokens, vocab.numbers, 1), shas(ids, tokens, vocab.pieces)

    return _apply(docs, path, summary, "n_tokens long, ids_sha256 string, decoded_sha256 string",
                  [pa.int64(), pa.string(), pa.string()])

"""BPE encoding and decoding over a distinct-word table.

1. Spark marks the ends of the byte-level BPE's words in every whole text (native
   regular expression); the words are read off the marked texts' bytes, without a list of them. Each task numbers the distinct words of a chunk of texts
   (an Arrow batch, cut at ``CHUNK`` words) and sends each once as (word, chunk, number).
2. These rows are shuffled and sorted by word, so each distinct word of the whole table
   meets one task, which encodes it once and sends its ids back to every (chunk, number).
3. The texts travel as the numbers of their words (one to three bytes each), never as text, in the
   same shuffle by chunk. There each text's numbers join the chunk's ids by position. A task holds one
   chunk's ids at a time; nothing is broadcast or brought to the driver, and the
   work is the same at every number of distinct words.
4. Decoding looks each id up in the id-to-piece table (fixed size: the
   vocabulary) and joins the pieces' bytes; bytes that are no UTF-8 become
   U+FFFD as in the library.

Texts are split twice, for the words and for the numbers, which is cheaper than storing either. Both
passes must see the same rows in the same order: files give that, also to a task that is run
again, and anything else is stored first. A chunk whose numbers do not fit raises.

Results for odd input: null texts encode as empty; documents are addressed by a
row of their own, so null or repeated ids keep one row each; an empty table gives no
rows; the tokenizer's special token in a text is one id, as in the library.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

#: Words of texts that are numbered together; a longer text is a chunk of its own.
CHUNK = 1 << 22
#: Numbers that are packed at a time: a chunk's as a whole would need 50 bytes each on the way.
SLICE = 1 << 16

# Fixed: Unicode white space.
SPACE = r"\t-\r\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
#: Fixed: the word pattern of byte-level BPE, white space as Unicode has it.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+|["
           + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")
SPECIAL = "<|endoftext|>"
#: Follows each word of a text on its way to the tasks, one byte; texts that hold it go another way.
END = "\x01"


def words(text: str | Column) -> Column:
    """The words of a text, in order and each followed by ``END``; a special token is a word of its own.

    Null for a text that holds ``END`` itself or characters newer than the Java runtime's Unicode
    tables: those are split by the library itself (``own_words``).
    """
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))

    def cut(s: Column) -> Column:  # the pattern leaves no character out
        return F.regexp_replace(s, F.lit(PATTERN), F.lit("$0" + END))

    parts = F.transform(F.split(text, r"<\|endoftext\|>", -1), cut)
    return (F.when(text.rlike(r"\p{Cn}") | text.contains(END), F.lit(None))
            .when(text.contains(SPECIAL), F.array_join(parts, SPECIAL + END)).otherwise(cut(text)))


def cut(docs: DataFrame, *columns: Column) -> DataFrame:
    """The given columns, then ``w`` (words) and ``raw`` (the text where w is null)."""
    w = words("text")
    return docs.select(*columns, w.alias("w"), F.when(w.isNull(), F.col("text")).alias("raw"))


def own_words(text: str, path: str) -> list[str]:
    """A text's words by the library's own splitter, each followed by ``END``."""
    out = []
    for i, part in enumerate(text.split(SPECIAL)):
        out += [SPECIAL + END] * (i > 0)
        out += [part[a:b] + END for _, (a, b) in tokenizer(path).pre_tokenizer.pre_tokenize_str(part)]
    return out


def word_ends(col: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts end to end, on the column's own bytes, and the number of words of each text."""
    _, at, raw = col.buffers()
    wide = np.int64 if pa.types.is_large_string(col.type) else np.int32
    at = np.frombuffer(at, wide)[col.offset:col.offset + len(col) + 1]
    if at[0] == at[-1]:
        return pa.array([], pa.string()), np.zeros(len(col), np.int64)
    data = np.frombuffer(raw, np.uint8)[:at[-1]]
    slices = range(int(at[0]), len(data), SLICE)
    ends = np.empty(1 + sum(np.count_nonzero(data[a:a + SLICE] == ord(END)) for a in slices), np.int32)
    ends[0], done = at[0], 1
    for a in slices:
        found = np.flatnonzero(data[a:a + SLICE] == ord(END))
        ends[done:done + len(found)] = found + a + 1
        done += len(found)
    flat = pa.Array.from_buffers(pa.string(), len(ends) - 1, [None, pa.py_buffer(ends), raw])
    return flat, np.diff(np.searchsorted(ends, at))


def word_lists(col: pa.Array, raw: pa.Array, path: str) -> tuple[pa.Array, np.ndarray]:
    """``word_ends``, null texts filled in from the raw ones."""
    flat, n = word_ends(col)
    if not col.null_count:
        return flat, n
    parts, done, ends = [], 0, np.cumsum(n)
    for i in np.flatnonzero(col.is_null().to_numpy(zero_copy_only=False)):
        own = own_words(raw[int(i)].as_py(), path)
        parts += [flat.slice(done, ends[i] - done), pa.array(own, flat.type)]
        done, n[i] = ends[i], len(own)
    return pa.concat_arrays([*parts, flat.slice(done)]), n


@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def replayable(docs: DataFrame) -> DataFrame:
    """The frame if it is a plain scan of files, whose rows come in the same order each time; else a stored copy."""
    plan = docs._jdf.queryExecution().sparkPlan().toString()
    nodes = set(re.findall(r"^[ :+*()\d-]*([A-Za-z]+)", plan, re.M))
    return docs if nodes <= {"FileScan", "Project", "Filter", "ColumnarToRow"} else stored(docs, "bpe-docs")


def chunks(n: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of n words each: about ``size`` words, at least one text."""
    ends, a = np.concatenate(([0], np.cumsum(n))), 0
    while a < len(n):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + size, "right")) - 1)
        yield a, b
        a = b


def numbered(batches: Iterator[pa.RecordBatch], path: str, size: int) -> Iterator[tuple]:
    """``chunk, first row, last row, batch, words per text, numbers, distinct words`` of partition, words, raw texts, .."""
    count = 0
    for b in batches:
        if not len(b):
            continue
        flat, n = word_lists(b.column(1), b.column(2), path)
        at = np.concatenate(([0], np.cumsum(n)))
        for i, j in chunks(n, size):
            chunk = (b.column(0)[0].as_py() << 32) + count
            count += 1
            coded = flat.slice(at[i], at[j] - at[i]).dictionary_encode()
            if not isinstance(coded, pa.DictionaryArray):
                coded = coded.combine_chunks()
            yield chunk, i, j, b, n[i:j], coded.indices.to_numpy(zero_copy_only=False), pc.utf8_slice_codeunits(
                coded.dictionary, 0, -1)


def id_type(path: str) -> str:
    """The narrowest type that holds every id."""
    return "<u2" if tokenizer(path).get_vocab_size() <= 1 << 16 else "<u4"


def encode_words(words: DataFrame, path: str) -> DataFrame:
    """``chunk, numbers, sizes, ids`` of ``word, chunk, number`` rows: every distinct word is encoded once.

    Numbers are packed as steps from one to the next, in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, kind = tokenizer(path), id_type(path)
        last, last_ids = None, b""
        for b in batches:  # sorted: equal words lie side by side, the first may go on from the batch before
            coded = b.column(0).dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            new = distinct[1:] if distinct and distinct[0] == last else distinct
            got = [np.array(e.ids, kind).tobytes() for e in t.encode_batch_fast(new, add_special_tokens=False)]
            ids = got if len(new) == len(distinct) else [last_ids, *got]
            if distinct:
                last, last_ids = distinct[-1], ids[-1]
            width = np.dtype(kind).itemsize
            table = Ragged(np.frombuffer(b"".join(ids), kind), np.array([len(x) // width for x in ids], np.int64))
            chunk, number = b.column(1).to_numpy(), b.column(2).to_numpy().astype(np.int64)
            order = np.lexsort((number, chunk))
            chunk, number = chunk[order], number[order]
            flat, n = table.take(coded.indices.to_numpy()[order])
            cuts = np.flatnonzero(np.diff(chunk, prepend=-1))
            ends = np.concatenate(([0], np.cumsum(n)))
            rows = [(int(chunk[i]), pack(np.diff(number[i:j], prepend=0)).tobytes(), pack(n[i:j]).tobytes(),
                     flat[ends[i]:ends[j]].tobytes()) for i, j in zip(cuts, [*cuts[1:], len(chunk)], strict=True)]
            cols = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(cols, [pa.int64(), *[pa.binary()] * 3], strict=True)],
                ["chunk", "numbers", "sizes", "ids"])

    return words.repartition("word").sortWithinPartitions("word").mapInArrow(
        run, "chunk long, numbers binary, sizes binary, ids binary")


class Ragged:
    """Rows of different lengths in one flat array."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray):
        self.flat, self.lengths = flat, lengths.astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows' values end to end, and each one's length."""
        n = self.lengths[rows]
        at = np.repeat(self.starts[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.flat[at], n


def pack(x: np.ndarray) -> np.ndarray:
    """Numbers as bytes, seven bits each, the last of a number below 128."""
    return _packed(x, np.zeros(0, np.int64))[0]


def _packed(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``pack`` and the bytes before each of the ascending positions ``at``, by ``SLICE`` numbers at a time."""
    out, before, done = [np.zeros(0, np.uint8)], np.zeros(len(at), np.int64), 0
    for a in range(0, len(x), SLICE):
        part = x[a:a + SLICE].astype(np.int64)
        n = 1 + (part >= 1 << 7) + (part >= 1 << 14) + (part >= 1 << 21)
        end = np.cumsum(n)
        raw = np.zeros(int(end[-1]), np.uint8)
        for k in range(4):  # k-th byte from a number's end
            has = n > k
            raw[end[has] - 1 - k] = (part[has] >> (7 * k)) & 127 | (128 if k else 0)
        i, j = np.searchsorted(at, (a + 1, a + len(part) + 1))
        before[i:j] = done + end[at[i:j] - a - 1]
        done += len(raw)
        out.append(raw)
    return np.concatenate(out), before


def pack_rows(x: np.ndarray, n: np.ndarray) -> pa.Array:
    """``pack`` of consecutive groups of n numbers, one binary value each."""
    raw, ends = _packed(x, np.concatenate(([0], np.cumsum(n))))
    return pa.Array.from_buffers(pa.binary(), len(n), [
        None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(raw)])


def unpack(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8).astype(np.int64)
    ends = np.flatnonzero(b < 128)
    if not len(ends):
        return np.zeros(0, np.int64)
    starts = np.concatenate(([0], ends[:-1] + 1))
    x = np.zeros(len(ends), np.int64)
    for k in range(4):
        has = starts + k <= ends
        x[has] = x[has] << 7 | (b[starts[has] + k] & 127)
    return x


@lru_cache(maxsize=2)
def pieces(path: str) -> Ragged:
    """The id-to-piece table: the bytes of every id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes shown as themselves
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    vocab = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    table = [b""] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        known = all(c in byte_of for c in piece)
        table[i] = bytes(byte_of[c] for c in piece) if known else piece.encode()
    return Ragged(np.frombuffer(b"".join(table), np.uint8), np.array([len(x) for x in table]))


def decode(ids: np.ndarray, table: Ragged) -> bytes:
    """UTF-8 of the decoded text."""
    return table.take(ids.astype(np.int64))[0].tobytes().decode("utf-8", "replace").encode()


def encode(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, ids`` (array of ints) of every row of ``docs``."""
    return _encoded(docs, path, lambda ids: (ids.tolist(),), "ids array<int>", [pa.list_(pa.int32())], chunk)


def digests(docs: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row of ``docs``."""

    def summary(ids: np.ndarray) -> tuple:
        return (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                hashlib.sha256(decode(ids, pieces(path))).hexdigest())

    return _encoded(docs, path, summary, "n_tokens long, ids_sha256 string, decoded_sha256 string",
                    [pa.int64(), pa.string(), pa.string()], chunk)


def _chunk_table(parts: list[tuple[bytes, bytes, bytes]], kind: str) -> Ragged:
    """The ids of a chunk's words by number."""
    number = np.concatenate([np.zeros(0, np.int64), *(np.cumsum(unpack(p[0])) for p in parts)])
    table = Ragged(np.frombuffer(b"".join(p[2] for p in parts), kind), unpack(b"".join(p[1] for p in parts)))
    at = np.full(len(number), -1)
    if len(number) and number.max() < len(number):
        at[number] = np.arange(len(number))
    if (at < 0).any():
        raise RuntimeError("a chunk's words came back incomplete: its texts were not read in the same order twice")
    return Ragged(*table.take(at))


def _encoded(docs: DataFrame, path: str, result, schema: str, kinds: list, size: int) -> DataFrame:
    """Apply ``result`` to every document's ids; one output row per document."""
    docs = replayable(docs.select("doc_id", "text"))
    kind = dict(docs.dtypes)["doc_id"]
    texts = cut(docs, F.spark_partition_id().alias("part"))
    with_ids = cut(docs, F.spark_partition_id().alias("part"), F.col("doc_id").alias("doc_id")).select(
        "part", "w", "raw", "doc_id")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, _, _, _, _, _, distinct in numbered(batches, path, size):
            m = len(distinct)
            yield pa.RecordBatch.from_arrays(
                [distinct, pa.array(np.full(m, chunk, np.int64)), pa.array(np.arange(m, dtype=np.int32))],
                ["word", "chunk", "number"])

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, i, j, b, n, numbers, _ in numbered(batches, path, size):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(j - i, chunk, np.int64)), b.column(3).slice(i, j - i),
                 pack_rows(numbers, n)], ["chunk", "doc_id", "code"])

    none = F.lit(None).cast("binary")
    ids = encode_words(texts.mapInArrow(words, "word string, chunk long, number int"), path).select(
        "chunk", F.lit(0).alias("kind"), F.lit(None).cast(kind).alias("doc_id"), none.alias("code"),
        "numbers", "sizes", "ids")
    numbers = with_ids.mapInArrow(codes, f"chunk long, doc_id {kind}, code binary").select(
        "chunk", F.lit(1).alias("kind"), "doc_id", "code", none.alias("numbers"), none.alias("sizes"), none.alias("ids"))
    names = ["doc_id", *(x.split()[0] for x in schema.split(", "))]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, parts, table, width = None, [], None, id_type(path)
        for b in batches:  # by chunk: first its words' ids, then its texts
            made = []
            which = b.column(0).to_numpy()
            is_text = b.column(1).to_numpy() == 1
            code, number, size, found = (b.column(k) for k in (3, 4, 5, 6))
            for i in range(len(b)):
                if which[i] != chunk:
                    chunk, parts, table = which[i], [], None
                if not is_text[i]:
                    parts.append((number[i].as_py(), size[i].as_py(), found[i].as_py()))
                    continue
                if table is None:
                    table, parts = _chunk_table(parts, width), []
                made.append(result(table.take(unpack(code[i].as_py()))[0]))
            cols = zip(*made, strict=True) if made else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays(
                [b.column(2).filter(pa.array(is_text)),
                 *(pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True))], names)

    both = ids.unionByName(numbers).repartition("chunk").sortWithinPartitions("chunk", "kind")
    return both.mapInArrow(join, f"doc_id {kind}, {schema}")

import hashlib
from collections import Counter

import numpy as np
import pytest
from helpers import ODD, documents, rows
from tokenizers import Tokenizer

from ledgerloom.llm import bpe
from ledgerloom.llm.queries import tokenizer_path

HARD = [(900, "a!<|endoftext|>  b  <|endoftext|>"), (901, "x  \n\n y  z　 'tis 's'll don't"),
        (902, "tab\tcr\r\nnel\u0085 ls ps  zwsp​ end   "), (903, "٣٤ ½ ² Ⅷ ǅ ªº ﻿́a"),
        (904, " " * 50 + "x" + "!" * 5000), (905, "<|endoftext|><|endoftext|>")]


def brute(pairs):
    t = Tokenizer.from_file(tokenizer_path())
    out = Counter()
    for i, text in pairs:
        ids = t.encode(text or "", add_special_tokens=False).ids
        out[(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("chunk", [1, 5000, bpe.CHUNK])
def test_matches_the_library(spark, chunk):
    pairs = ODD + HARD + [(r["doc_id"] + 2000, r["text"]) for r in rows("documents")]
    got = bpe.digests(documents(spark, pairs, clashes=True), tokenizer_path(), chunk).collect()
    assert Counter(tuple(r) for r in got) == brute(pairs)


def test_ids_and_round_trip(spark):
    pairs = [(r["doc_id"], r["text"]) for r in rows("documents")][:40]
    t = Tokenizer.from_file(tokenizer_path())
    table = bpe.pieces(tokenizer_path())
    text = dict(pairs)
    for r in bpe.encode(documents(spark, pairs), tokenizer_path()).collect():
        assert r["ids"] == t.encode(text[r["doc_id"]], add_special_tokens=False).ids
        assert bpe.decode(np.array(r["ids"], np.uint32), table).decode() == text[r["doc_id"]]


def test_decode_replaces_broken_utf8():
    t = Tokenizer.from_file(tokenizer_path())
    ids = t.encode("漢字 \U0001f600", add_special_tokens=False).ids
    for a in range(len(ids)):
        for b in range(a + 1, len(ids) + 1):
            want = t.decode(ids[a:b], skip_special_tokens=False)
            assert bpe.decode(np.array(ids[a:b]), bpe.pieces(tokenizer_path())).decode() == want


def test_every_character(spark):
    """Each character between letters, digits, marks and spaces, a few hundred to a text."""
    chars = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x20000)]]  # beyond: ideographs and unassigned
    pairs = [(i, " ".join(f"a{c}1{c}!{c}" for c in chars[i:i + 256])) for i in range(0, len(chars), 256)]
    got = bpe.digests(documents(spark, pairs).repartition(8), tokenizer_path()).collect()
    assert Counter(tuple(r) for r in got) == brute(pairs)


def test_pack():
    x = np.array([0, 1, 127, 128, 16383, 16384, 2**21 - 1, 2**21, 2**27])
    assert (bpe.unpack(bpe.pack(x).tobytes()) == x).all()
    rows = bpe.pack_rows(x, np.array([0, 4, 0, 5]))
    assert [bpe.unpack(r.as_py()).tolist() for r in rows] == [[], x[:4].tolist(), [], x[4:].tolist()]
    assert len(bpe.unpack(b"")) == 0 and len(bpe.pack(np.zeros(0, np.int64))) == 0


def test_empty(spark):
    assert bpe.digests(documents(spark, []), tokenizer_path()).count() == 0


def test_packing_a_chunk_needs_little_memory():
    """Before, the arrays on the way took fifty bytes a number, hundreds of MB for a chunk."""
    import tracemalloc

    rng = np.random.default_rng(7)
    sizes = rng.integers(0, 900, 4000)
    x = (rng.integers(0, 1 << 28, sizes.sum()) >> rng.integers(0, 28, sizes.sum())).astype(np.int32)
    tracemalloc.start()
    got = bpe.pack_rows(x, sizes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * len(x)
    ends = np.cumsum(sizes)
    for i in (0, 1, 17, 1999, 3999):
        assert bpe.unpack(got[i].as_py()).tolist() == x[ends[i] - sizes[i]:ends[i]].tolist()
    assert bpe.unpack(bpe.pack(x).tobytes()).tolist() == x.tolist()
    assert b"".join(got.to_pylist()) == bpe.pack(x).tobytes()


def test_words_travel_on_the_text_itself(spark):
    """As lists, the words took twice the text's bytes in every buffer on the way to a task."""
    odd = ["\x01", "a\x01b \x01", "\x01<|endoftext|>\x01", "x<|endoftext|>", "", None, "$0 \\ $1", "it's\n\n x"]
    pairs = HARD + [(i, t) for i, t in enumerate(odd * 3)] + [(i, None) for i in range(50, 53)]
    docs = documents(spark, pairs).coalesce(1)
    assert dict(bpe.cut(docs).dtypes)["w"] == "string"
    for chunk in (1, 7, bpe.CHUNK):
        assert Counter(tuple(r) for r in bpe.digests(docs, tokenizer_path(), chunk).collect()) == brute(pairs)
    empty = documents(spark, [(1, None), (2, "")]).coalesce(1)
    assert Counter(tuple(r) for r in bpe.digests(empty, tokenizer_path()).collect()) == brute([(1, None), (2, "")])

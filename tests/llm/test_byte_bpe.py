import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import ODD, documents, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import byte_bpe
from ledgerloom.llm.queries import RANKS, tokenizer_path

PATH = tokenizer_path(RANKS)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(texts):
    raws = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in raws]))).astype(np.int64)
    ids, tokens = byte_bpe.encode_chunk(np.frombuffer(b"".join(raws), np.uint8), offsets, PATH)
    return [ids[a:b].tolist() for a, b in zip(tokens[:-1], tokens[1:], strict=True)]


def test_digests_match_the_library(spark, library, monkeypatch):
    pairs = ODD + [(900, "<|endoftext|> 'll 'Re don't"), (901, "!" * 5000 + " " * 999 + "\n\n x"), (902, "ab" * 40_000)] + [
        (r["doc_id"] + 2000, r["text"]) for r in rows("documents")]
    want = Counter()
    for i, t in pairs:
        ids = library.encode_ordinary(t or "")
        want[(i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
              hashlib.sha256(library.decode_bytes(ids)).hexdigest())] += 1
    for docs in (documents(spark, pairs, clashes=True), documents(spark, pairs).repartition(7)):
        assert Counter(tuple(r) for r in byte_bpe.digests(docs, PATH).collect()) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n\r'srtvlemdSRabxz019!?.é漢́　 \x85\U0001f600", max_size=24), max_size=12))
def test_boundaries_of_any_text(library, texts):
    assert ids_of(texts) == [library.encode_ordinary(t) for t in texts]


def test_many_contractions(library):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("'srevlmd \n") for _ in range(rnd.randrange(10))) for _ in range(20_000)]
    assert ids_of(texts) == [library.encode_ordinary(t) for t in texts]


def test_every_character(library):
    chars = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x20000), *range(0xE0000, 0xE0200), 0x10FFFF]]
    texts = [" ".join(f"a{c}1{c}!{c}" for c in chars[i:i + 256]) for i in range(0, len(chars), 256)]
    assert ids_of(texts) == [library.encode_ordinary(t) for t in texts]


def test_scan_is_a_run_of_the_automaton():
    symbols = np.random.default_rng(1).integers(0, 12, 10_000).astype(np.uint8)
    state, want = byte_bpe.BEGIN, []
    for c in symbols:
        state = byte_bpe.STEP[state, c]
        want.append(state)
    m = byte_bpe.monoid()
    assert m.states(symbols, byte_bpe.BEGIN).tolist() == want
    assert len(m.states(symbols[:0], byte_bpe.BEGIN)) == 0
    a, b, c = np.random.default_rng(2).integers(0, len(m.functions), (3, 500))
    assert (m.both[m.both[a, b], c] == m.both[a, m.both[b, c]]).all()  # associative


def test_long_and_short_merges_agree():
    vocab = byte_bpe.vocabulary(PATH)[0]
    rnd = random.Random(3)
    for size in (1, 2, 7, 40):
        raw = [bytes(rnd.choice(b"abcdetions \xc3\xa9") for _ in range(size)) for _ in range(200)]
        got = vocab.merge(np.frombuffer(b"".join(raw), np.uint8).reshape(-1, size))
        assert got == [vocab.merge_long(x) for x in raw]


def test_ids_offsets_and_round_trip(spark, library):
    pairs = [(r["doc_id"], r["text"]) for r in rows("documents")][:40]
    text = dict(pairs)
    for r in byte_bpe.encode(documents(spark, pairs), PATH).collect():
        assert r["ids"] == library.encode_ordinary(text[r["doc_id"]])
        assert byte_bpe.decode(r["ids"], PATH).decode() == text[r["doc_id"]]


def test_small_blocks_of_tokens(spark, monkeypatch):
    texts = [t or "" for _, t in ODD]
    ids = ids_of(texts)
    tokens = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int64)
    flat = np.array([x for y in ids for x in y], np.int64)
    vocab = byte_bpe.vocabulary(PATH)[0]
    want = byte_bpe.shas(flat, tokens, vocab.numbers, 1)
    monkeypatch.setattr(byte_bpe, "TOKENS", 7)
    assert byte_bpe.shas(flat, tokens, vocab.numbers, 1) == want


def test_broken_utf8():
    raw = np.frombuffer(b"ab\xff" + b"\xc3" + b"\xa9x" + b"", np.uint8)
    got, offsets = byte_bpe.valid(raw, np.array([0, 3, 4, 6, 6]))
    assert [got[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [
        "ab�", "�", "�x", ""]


def test_empty(spark):
    assert byte_bpe.digests(documents(spark, []), PATH).count() == 0

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import LONG, ODD, documents, rows

from ledgerloom.llm import substring_dedup


def brute(pairs):
    far, first, out = 1 << 63, {}, Counter()
    texts = [(far if i is None else i, (t or "").encode().split()) for i, t in pairs]
    for i, w in texts:
        for s in range(len(w) - 12):
            k = b" ".join(w[s:s + 13])
            first[k] = min(i, first.get(k, i))
    for (i, w), (doc_id, _) in zip(texts, pairs, strict=True):
        gone = np.zeros(len(w), bool)
        for s in range(len(w) - 12):
            if first[b" ".join(w[s:s + 13])] < i:
                gone[s:s + 13] = True
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[(doc_id, len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest())] += 1
    return out


def random_texts(seed, n=150):
    """Few words, so that runs, shared passages of 8 to 40 words, and edits are common."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(30)] + ["x", "x", "x"]
    shared = [[rng.choice(vocabulary) for _ in range(rng.randrange(8, 40))] for _ in range(12)]
    pairs = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(6)):
            kind = rng.random()
            if kind < 0.5:
                part = list(rng.choice(shared))
                if rng.random() < 0.4:
                    part[rng.randrange(len(part))] = "edit"
                words += part[rng.randrange(4):]
            elif kind < 0.7:
                words += [rng.choice("xy")] * rng.randrange(1, 45)
            elif kind < 0.8:
                words += ["p", "q"] * rng.randrange(1, 20)
            else:
                words += [rng.choice(vocabulary) for _ in range(rng.randrange(30))]
        pairs.append((i, rng.choice([" ", "  ", "\n"]).join(words)))
    return pairs


@pytest.mark.parametrize(("seed", "counters"), [(1, 5), (2, 1023)])
def test_random_texts(spark, seed, counters):
    pairs = random_texts(seed)
    got = substring_dedup.dedup(documents(spark, pairs), counters).collect()
    assert Counter(tuple(r) for r in got) == brute(pairs)


def test_whole_table_and_odd_rows(spark):
    pairs = [(r["doc_id"] + 100, r["text"]) for r in rows("documents")] + ODD + [(99, LONG[500:90_000])]
    got = substring_dedup.dedup(documents(spark, pairs, clashes=True)).collect()
    assert Counter(tuple(r) for r in got) == brute(pairs)


def test_hot_passage_and_copies(spark):
    passage = " ".join(f"h{i}" for i in range(60))
    pairs = [(i, f"own{i} words{i} {passage} tail{i}" if i % 3 else f"copy {passage}") for i in range(200)]
    got = substring_dedup.dedup(documents(spark, pairs), 3).collect()
    assert Counter(tuple(r) for r in got) == brute(pairs)


def test_equal_windows_have_equal_anchors():
    """Whatever surrounds a window, it gets the same key."""
    rng = random.Random(5)
    for _ in range(300):
        window = [rng.choice(["a", "b", "c", "x", "x"]) for _ in range(13)]
        keys = set()
        for _ in range(6):
            left, right = ([rng.choice(["a", "x", "b"]) for _ in range(rng.randrange(9))] for _ in range(2))
            text = " ".join(left + window + right).encode()
            _, key, _, at, n = substring_dedup.Parsed([b"z z", text]).anchors()
            doc_at = len(left)
            doc = substring_dedup.Parsed([b"z z", text]).anchors()[0]
            keys |= {k for d, k, s, c in zip(doc, key, at, n, strict=True) if d == 1 and s <= doc_at < s + c}
        assert len(keys) == 1


def test_empty(spark):
    assert substring_dedup.dedup(documents(spark, [])).count() == 0


def test_words_that_sums_of_powers_confuse(spark):
    """Words of two letters in Thue-Morse order and its complement, and very long words, are words of their own."""
    for size in (1024, 4096, 100_000):
        bits = [bin(i).count("1") & 1 for i in range(size)]
        words = ["".join("ab"[b ^ flip] for b in bits) for flip in (0, 1)]
        rest = " ".join(f"w{i}" for i in range(12))
        got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.dedup(documents(spark, [
            (1, f"{words[0]} {rest}"), (2, f"{words[1]} {rest}"), (3, f"{rest} {words[1][:-1]}"),
            (4, f"{words[0]} {rest}")])).collect()}
        assert got == {1: 0, 2: 0, 3: 0, 4: 13}, size

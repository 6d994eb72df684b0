import random
from collections import Counter

import numpy as np
import pytest
from helpers import ODD, documents, rows
from xxhash import xxh64_intdigest

from ledgerloom.llm import simhash


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    fps = np.array(fps, np.uint64)
    label = np.arange(len(fps))
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= 2
    while True:
        new = np.where(near, label[None], len(fps)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def expected(pairs):
    fps = [slow_fingerprint(t) for _, t in pairs]
    label = slow_components(fps)
    least = {}
    for (i, _), c in zip(pairs, label, strict=True):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return Counter((i, f"{f:016x}", least.get(c)) for (i, _), f, c in zip(pairs, fps, label, strict=True))


@pytest.mark.parametrize("bucket", [1, simhash.BUCKET])
def test_matches_brute_force(spark, bucket):
    pairs = [(r["doc_id"], (r["text"] or "")[:4000]) for r in rows("documents")] + [
        (None if i is None else 10_000 + i, t and t[:3000]) for i, t in ODD]
    got = simhash.near_duplicates(documents(spark, pairs, clashes=True), bucket).collect()
    assert Counter(tuple(r) for r in got) == expected(pairs)


@pytest.mark.parametrize("bucket", [2, 64])
def test_links_connect_what_pairs_connect(spark, bucket):
    """Fingerprints crowded around a few centres: pairs at distance 1 to 4 in either segment."""
    rng = random.Random(3)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            fps.add(centre ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(4))}))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bucket).collect()
    at = {f: i for i, f in enumerate(signed)}
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        assert bin((a ^ b) & (2**64 - 1)).count("1") <= 2
        parent[find(at[a])] = find(at[b])
    label = slow_components(fps)
    assert all((find(i) == find(j)) == (label[i] == label[j]) for i in range(len(fps)) for j in range(i))


def test_dedup_keeps_one_of_each_component(spark):
    pairs = [(i, t) for i, t in ODD if t is None or len(t) < 1000] + [(50 + i, "hot words again") for i in range(60)]
    docs = documents(spark, pairs, clashes=True)
    got = simhash.dedup(docs)
    assert got.columns == docs.columns
    groups = {}
    for (i, _), c in zip(pairs, slow_components([slow_fingerprint(t) for _, t in pairs]), strict=True):
        groups.setdefault(c, []).append(i)
    want = sorted(min((i for i in g if i is not None), default=-1) for g in groups.values())
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in got.collect()) == want


def test_empty(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert simhash.dedup(documents(spark, [])).count() == 0

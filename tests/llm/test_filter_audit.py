import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import CLASHES, LONG, ODD, SCHEMA, documents, rows

from ledgerloom.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    w = WORD.findall(text or "")
    t = text or ""
    return (len(w), len(set(w)), sum("A" <= c <= "Z" for c in t), len(t), sum(c in "#$%&*|" for c in t))


def brute(docs, labels):
    """(doc_id, text, lang) and (doc_id, quality, toxic) rows to the audit's rows."""
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    failed = defaultdict(list)
    for i, t, lang in docs:
        n, d, caps, points, signs = measured(t)
        f = {"A": n < 200, "B": 100 * d < 50 * n, "C": 100 * caps > 3 * points, "D": signs > 0,
             "E": i is not None and least[t or ""] < i}
        failed[lang or ""].append(({x for x in f if f[x]}, i in good, i in toxic))
    out = []
    for part, docs_of in failed.items():
        removed_of = Counter()
        made = []
        for order in itertools.permutations("ABCDE"):
            left = docs_of
            for step, x in enumerate(order, 1):
                earlier = set(order[:step - 1])
                gone = [d for d in left if x in d[0]]
                left = [d for d in left if x not in d[0]]
                removed_of[x] += len(gone)
                made.append((part, "".join(order), step, x, len(left), len(gone),
                             sum(x in f and bool(f & earlier) for f, _, _ in docs_of),
                             sum(f == {x} for f, _, _ in docs_of), sum(g for _, g, _ in gone), sum(t for _, _, t in gone)))
        out += [(*r[:3], *r[4:], removed_of[r[3]]) for r in made]
    return Counter(out)


def test_matches_brute_force(spark):
    odd = [(i, t, "en") for i, t in ODD] + [
        (40, "A B C # a", None), (41, "A B C # a", ""), (42, "A B C # a", "de"), (40, "A B C # a", "de"),
        (43, " ".join(f"w{i % 90}" for i in range(200)), "de"), (44, " ".join(f"W{i}" for i in range(199)), "de"),
        (45, "x" * 100_000 + " " + "x" * 99_999 + "y|", "fr"), (46, "ÀÉ ABC\x0b\x1c\x85 b c", "fr")]
    docs = odd + [(r["doc_id"] + 1000, r["text"], r["lang"]) for r in rows("documents")]
    labels = [(r["doc_id"] + 1000, r["quality"], r["toxic"]) for r in rows("labels")] + [
        (40, 1, 0), (40, 0, 1), (None, 1, 1), (44, None, None), (3, 1, None), (99_999, 1, 1)]
    wide = SCHEMA + "".join(f", `{c}` string" for c in [*CLASHES, "part", "failed", "good", "toxic", "first_id"])
    data = [(i, t, lang, "s", 0, *("x" for _ in range(len(CLASHES) + 5))) for i, t, lang in docs]
    got = filter_audit.audit(spark.createDataFrame(data, wide).repartition(5),
                             spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert Counter(tuple(r) for r in got.collect()) == brute(docs, labels)


@pytest.mark.parametrize("chunk", [1, 1000, 1 << 21])
def test_measures_at_every_chunk_size(spark, chunk):
    texts = [t for _, t in ODD] + ["", "a", " a", "a ", "aaaaaaaa aaaaaaaab aaaaaaaa", LONG[:5000]]
    got = filter_audit.measure(documents(spark, list(enumerate(texts))), chunk).collect()
    assert {r["doc_id"]: tuple(r[n] for n in filter_audit.NAMES) for r in got} == {
        i: measured(t) for i, t in enumerate(texts)}


def test_equal_hashes_are_verified(monkeypatch):
    """With one hash for every word, only the comparison of bytes tells words apart."""
    monkeypatch.setattr(filter_audit, "_mix", lambda h: np.zeros_like(h))
    texts = [b"aa ab aa ba 123456789 123456780 123456789 12345678 " * 2, b"aa", b""]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    got = filter_audit.measures(np.frombuffer(b"".join(texts), np.uint8), offsets)
    assert got["distinct_words"].tolist() == [len(set(t.split())) for t in texts]


def test_empty(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(documents(spark, []), labels).count() == 0
    assert filter_audit.audit(documents(spark, [(1, None)]), labels).count() == 600

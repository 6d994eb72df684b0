import math
import random
import zlib

import numpy as np
import pytest
from helpers import LONG, ODD, documents

from ledgerloom.llm import toxicity

BAD = ["vilex", "scumbo", "trashy"]


def corpus(n=500, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    pairs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 90))]
        toxic = int(rng.random() < 0.2)
        for _ in range(3 * toxic):
            text.insert(rng.randrange(len(text)), rng.choice(BAD) + rng.choice(["", "ia", "or"]))
        pairs.append((i, " ".join(text)))
        labels.append((i, 1, toxic))
    return pairs, labels


def table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_scored_well_and_not_learned_from(spark):
    pairs, labels = corpus()
    docs = documents(spark, pairs, clashes=True)
    got = {r["doc_id"]: r for r in toxicity.score_documents(docs, table(spark, labels)).collect()}
    held = {i for i, _ in pairs if zlib.crc32(str(i).encode()) % 4 == 2}
    assert {i for i, r in got.items() if r["held_out"]} == held
    wrong = [i for i, _, y in labels if i in held and got[i]["predicted"] != y]
    assert len(wrong) <= 0.03 * len(held)
    flipped = [(i, q, 1 - y if i in held else y) for i, q, y in labels]
    again = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, table(spark, flipped)).collect()}
    assert again == {i: r["score"] for i, r in got.items()}
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got.values())


def test_vocabulary_is_every_term_beyond_chance(spark):
    """Against a brute-force version, at three sample sizes; none is empty or cut at a number."""
    for n in (60, 300, 900):
        pairs, labels = corpus(n, seed=n)
        rows = [(t, y) for (_, t), (_, _, y) in zip(pairs, labels, strict=True)]
        p_all, q_all = sum(y for _, y in rows), sum(1 - y for _, y in rows)
        seen = {}
        for t, y in rows:
            for term in set(toxicity.term_set(t)):
                seen.setdefault(term, [0, 0])[1 - y] += 1

        def g(p, q, p_all=p_all, q_all=q_all):
            table = [(p, p + q, p_all), (q, p + q, q_all), (p_all - p, p_all + q_all - p - q, p_all),
                     (q_all - q, p_all + q_all - p - q, q_all)]
            return 2 * sum(k * math.log(k * (p_all + q_all) / (of * side)) for k, of, side in table if k)

        for least in range(1, n + 1):
            m = sum(p + q >= least for p, q in seen.values())
            most = max(g(min(least, p_all), max(0, least - p_all)), g(max(0, least - q_all), min(least, q_all)))
            if m and most > 2 * math.log(m):
                break
        want = {t for t, (p, q) in seen.items() if p + q >= least and g(p, q) > 2 * math.log(m)}
        got = toxicity.vocabulary(spark.createDataFrame(rows, "text string, toxic int"))
        assert set(got) == want and want & {"^vile", "^scum", "^tras"}
        assert all(math.isclose(w, math.log((1 + n) / (1 + sum(seen[t]))) + 1) for t, w in got.items())


def test_string_ids(spark):
    pairs, labels = corpus(300)
    docs = spark.createDataFrame([(f"d{i}", t) for i, t in pairs], "doc_id string, text string")
    lab = spark.createDataFrame([(f"d{i}", y) for i, _, y in labels], "doc_id string, toxic int")
    rows = toxicity.score_documents(docs, lab).collect()
    assert len(rows) == 300 and any(e["example"].startswith("d") for r in rows for e in r["evidence"])


def test_index_returns_the_nearest_exactly():
    rng = np.random.default_rng(2)
    entries = []
    for _ in range(700):
        terms = sorted(rng.choice(40, rng.integers(1, 6), replace=False))
        w = rng.random(len(terms)) + 0.1
        entries.append(tuple(zip(map(int, terms), (w / np.linalg.norm(w)).round(9).tolist(), strict=True)))
    dense = np.zeros((700, 40))
    for e, v in enumerate(entries):
        for t, w in v:
            dense[e, t] = w
    flat = [(t, w) for v in entries for t, w in v]
    index = toxicity.BlockMaxIndex(np.array([t for t, _ in flat], np.int32), np.array([w for _, w in flat]),
                                   np.array([len(v) for v in entries]), 40, block=16)
    for q in range(0, 700, 7):
        cos = (dense @ dense[q]).round(9)
        order = sorted((-c, e) for e, c in enumerate(cos) if c > 0)[:12]
        terms, weights = zip(*entries[q], strict=True)
        got = index.nearest((np.array(terms, np.int32), np.array(weights)), 12)
        assert [e for _, e in got] == [e for _, e in order]
        assert np.allclose([c for c, _ in got], [-c for c, _ in order], atol=1e-8)


def test_isotonic_steps_rise():
    rng = random.Random(3)
    points = [(rng.random(), float(rng.random() < 0.4), 1.0) for _ in range(200)]
    at, value = toxicity.isotonic(points)
    assert at == sorted(at) and value == sorted(value)
    assert toxicity.isotonic([]) == ([], [])


def test_odd_rows_and_few_labels(spark):
    pairs, labels = corpus(120)
    docs = documents(spark, pairs + [(None if i is None else i + 1000, t) for i, t in ODD] + [(2000, LONG * 2)])
    rows = toxicity.score_documents(docs, table(spark, labels + [(0, None, None), (None, 1, 1), (1, 0, 1)])).collect()
    assert len(rows) == docs.count() and all(r["score"] is not None for r in rows)
    for given in ([], [(1, 1, 0)], [(i, 1, 1) for i in range(20)]):
        assert toxicity.score_documents(docs, table(spark, given)).count() == docs.count()
    assert toxicity.score_documents(documents(spark, []), table(spark, labels)).count() == 0


@pytest.mark.parametrize("clashes", [False, True])
def test_reject_drops_what_is_predicted(spark, clashes):
    pairs, labels = corpus(300)
    docs = documents(spark, pairs + [(None, None), (None, "")], clashes)
    lab = table(spark, labels)
    bad = {r["doc_id"] for r in toxicity.score_documents(docs, lab).where("predicted = 1").collect()}
    got = toxicity.reject(docs, lab)
    assert got.columns == docs.columns and len(bad) > 20
    assert {r["doc_id"] for r in got.collect()} == {i for i, _ in pairs} - bad | {None}

import numpy as np
import pytest
from helpers import CLASHES, LONG, ODD, documents

from ledgerloom.llm import mixing


def corpus():
    pairs = [(i, f"quiet prose number {i} with plain words, and some more of them. " * (1 + i % 5)) for i in range(160)]
    pairs += [(1000 + i, f"LOUD!!! JUNK!!! {i} $$$ ### " * (1 + i % 9)) for i in range(120)]
    labels = [(i, "prose" if i < 1000 else "junk") for i, _ in pairs if i % 2]
    return pairs, labels


def table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, domain string")


def reached(rows, k):
    return np.array([sum(r["rate"] * r["words"] * r["p"][j] for r in rows) for j in range(k)])


def test_rates_meet_the_targets(spark):
    pairs, labels = corpus()
    df, domains = mixing.document_rates(documents(spark, pairs), table(spark, labels), {"prose": 0.8, "junk": 0.2})
    rows = df.collect()
    assert domains == ["junk", "prose"] and all(r["rate"] >= 0 for r in rows)
    got = reached(rows, 2)
    assert got / got.sum() == pytest.approx([0.2, 0.8], abs=2e-3)
    assert got.sum() == pytest.approx(sum(r["words"] for r in rows), rel=2e-3)
    assert np.mean([r["p"][1] > 0.5 for r in rows if r["doc_id"] < 1000]) > 0.98


def test_steps_solve_the_least_squares_problem(spark):
    """Against a dense projected gradient run to the end by one process."""
    rng = np.random.default_rng(1)
    p, t = rng.dirichlet([0.4, 0.4, 0.4], 200), rng.integers(1, 50, 200)
    soft = spark.createDataFrame([(i, i, int(n), x.tolist()) for i, (n, x) in enumerate(zip(t, p, strict=True))],
                                 "key long, doc_id long, words long, p array<double>")
    steps, want, now = mixing.solve(soft, ["a", "b", "c"], {"a": 0.5, "b": 0.3, "c": 0.2})
    r, c = np.ones(200), t @ p
    for _ in range(20_000):
        r = np.maximum(0, r - p @ (((r * t) @ p - want) / c))
    assert now == pytest.approx(want, rel=2e-3) and (r * t) @ p == pytest.approx(want, rel=2e-3)
    assert mixing.rates_of(p, steps, None) == pytest.approx(r, abs=0.05)


@pytest.mark.parametrize("most", [None, 1.0])
def test_overlapping_domains_reach_the_optimum(spark, most):
    """Posteriors around 0.87 on either side, against a dense projected gradient of many steps."""
    rng = np.random.default_rng(2)
    high, t = rng.beta(0.87 * 20, 0.13 * 20, 2000), rng.integers(20, 400, 2000)
    own = np.where(rng.random(2000) < 0.8, high, 1 - high)
    p = np.stack([own, 1 - own], 1)
    soft = spark.createDataFrame([(i, i, int(n), x.tolist()) for i, (n, x) in enumerate(zip(t, p, strict=True))],
                                 "key long, doc_id long, words long, p array<double>")
    steps, want, now = mixing.solve(soft, ["a", "b"], {"a": 0.95, "b": 0.05}, most, "a" if most else None)
    r, c = np.ones(2000), t @ p
    for _ in range(20_000):
        r = np.clip(r - p @ (((r * t) @ p - want) / c), 0, most)
    best = (r * t) @ p
    assert (mixing.rates_of(p, steps, most) * t) @ p == pytest.approx(now, rel=1e-6)
    assert now / now.sum() == pytest.approx(best / best.sum(), abs=1e-3) and now.sum() == pytest.approx(best.sum(), rel=2e-3)
    if most is None:
        assert now / now.sum() == pytest.approx([0.95, 0.05], abs=1e-3)


def test_a_fit_that_stops_early_is_reported(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_STEPS", 1)
    soft = spark.createDataFrame([(i, i, 10, [0.5 + i / 100, 0.5 - i / 100]) for i in range(20)],
                                 "key long, doc_id long, words long, p array<double>")
    with pytest.warns(RuntimeWarning, match="least-squares"):
        mixing.solve(soft, ["a", "b"], {"a": 0.9, "b": 0.1}, 1.0)


def test_mix_with_a_bound_keeps_the_anchor(spark):
    pairs, labels = corpus()
    docs = documents(spark, pairs, clashes=True)
    got = mixing.mix(docs, table(spark, labels), {"prose": 0.9, "junk": 0.1}, most=1.0, anchor="prose")
    assert got.columns == docs.columns
    ids = [r["doc_id"] for r in got.collect()]
    assert len(ids) == len(set(ids))
    assert sum(i < 1000 for i in ids) >= 0.98 * 160 and 0 < sum(i >= 1000 for i in ids) < 100


def test_mix_repeats_rows_above_rate_one(spark):
    pairs, labels = corpus()
    docs = documents(spark, pairs)
    got = mixing.mix(docs, table(spark, labels), {"prose": 0.2, "junk": 0.8})
    rates, _ = mixing.document_rates(docs, table(spark, labels), {"prose": 0.2, "junk": 0.8})
    want = {r["doc_id"]: r["copies"] for r in mixing.copies(rates).collect() if r["copies"]}
    have = {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert have == want and max(want.values()) > 1


def test_odd_rows_and_labels(spark):
    pairs, labels = corpus()
    docs = documents(spark, pairs + [(None if i is None else i + 5000, t) for i, t in ODD] + [(9000, LONG)], True)
    given = table(spark, [*labels, (None, "prose"), (1, None), (1, "prose")])
    got = mixing.mix(docs, given, {"prose": 0.9, "junk": 0.1}, most=1.0, anchor="prose")
    assert got.columns == docs.columns and set(CLASHES) <= set(got.columns) and got.count() > 150
    for few in ([], [(1, "prose")]):
        rows, _ = mixing.document_rates(docs, table(spark, few), {"prose": 1.0}, key="doc_id")
        assert {r["rate"] for r in rows.collect()} == {1.0}
    assert mixing.mix(documents(spark, []), given, {"prose": 0.9, "junk": 0.1}).count() == 0
    free, _ = mixing.document_rates(docs, given, {"absent": 1.0})
    assert {r["rate"] for r in free.collect()} == {1.0}

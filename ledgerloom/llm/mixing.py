"""Mixing sources to target weights with soft domain membership.

A classifier fitted on a labelled table (``doc_id, domain``; a bounded sample
of ``EXAMPLES`` rows by a hash of the id) gives every document a posterior
over the domains. Document rates r >= 0 then solve

    minimise sum_k (sum_i r_i t_i p_ik - T_k)^2 / C_k

with t_i the document's words, p_ik its posterior, T_k the target and C_k the
expected words of domain k at r = 1. Of the rates that do so, those nearest to 1
are taken, in the limit of a small weight RIDGE on sum_i t_i (r_i - 1)^2: they
are r_i = clip(1 - sum_k p_ik m_k) for K multipliers m, which maximise a concave
function of K variables. Newton steps find them: each is one map-only pass over a
small stored table with K + K^2 + 1 sums for every step length tried, and nothing
of size N reaches the driver. RIDGE falls in stages, each started from the one
before. A fit that does not reach the tolerance is reported as a warning.

``realise`` turns rates into rows: floor(r) copies, and one more if a hash of
the row's key falls below the fraction.

Results for odd input: null texts have no words and get the rate of their
posterior; null and repeated ids keep one row each; a label of null is ignored;
with fewer than two labelled domains every posterior is the same and all rates
are 1; target domains without words in the corpus are left out; an empty table
gives no rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh, keyed, stored, without

#: Labelled rows that the classifier is fitted on, at most about so many.
EXAMPLES = 20_000
#: Newton steps at most, and the share of the target words by which totals may miss the optimum's condition.
MAX_STEPS = 200
TOLERANCE = 1e-5
#: Weights of the distance from rate 1, in turn, and the step lengths tried in one pass.
RIDGE = [10.0 ** -i for i in range(1, 8)]
LENGTHS = [0.5 ** i for i in range(16)]

#: Byte classes whose shares are features: letters, digits, spaces, then single marks.
CLASSES = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t", "\n\r",
           ".", ",", "!", "?", "|", "$", "%", "&", "*", "#", "@", "_-=+", "()[]{}<>", "\"'`", ";:/\\^~"]
CLASS_OF = np.full(256, len(CLASSES))
for _i, _c in enumerate(CLASSES):
    CLASS_OF[list(_c.encode())] = _i
#: The last class holds all other bytes; then mean word length, distinct words and lines, log words.
FEATURES = len(CLASSES) + 1 + 4


def features(text: bytes) -> tuple[int, list[float]]:
    """Number of words and the feature vector of a UTF-8 text."""
    raw = np.frombuffer(text, np.uint8)
    share = np.bincount(CLASS_OF[raw], minlength=len(CLASSES) + 1) / max(1, len(raw))
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    n = len(words)
    return n, [*share.tolist(), sum(map(len, words)) / max(1, n) / 10, len(set(words)) / max(1, n),
               len(set(lines)) / max(1, len(lines)), float(np.log1p(n)) / 10]


def profile(docs: DataFrame, key: str) -> DataFrame:
    """``key, doc_id, words, features`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [features(t.as_py() or b"") for t in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([n for n, _ in got], pa.int64()),
                 pa.array([f for _, f in got], pa.list_(pa.float32()))], ["key", "doc_id", "words", "features"])

    kinds = dict(docs.dtypes)
    return docs.select(F.col(key).alias("key"), F.col("doc_id").alias("doc_id"),
                       F.col("text").cast("binary").alias("text")).mapInArrow(
        run, f"key {kinds[key]}, doc_id {kinds['doc_id']}, words long, features array<float>")


def classifier(prof: DataFrame, labelled: DataFrame, examples: int = EXAMPLES):
    """Domains in order and the coefficients of a multinomial logistic regression."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    lab = labelled.where("doc_id is not null and domain is not null").groupBy("doc_id").agg(
        F.min("domain").alias("domain"))
    n = lab.count()
    if n > examples:
        lab = lab.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(examples / n * (1 << 30)))
    rows = stored(prof.join(F.broadcast(lab), "doc_id").select("features", "domain"), "mix-sample")
    domains = sorted(r["domain"] for r in rows.select("domain").distinct().collect())
    if len(domains) < 2:
        return domains, None
    order = F.array(*(F.lit(d) for d in domains))
    data = rows.select(array_to_vector(F.col("features").cast("array<double>")).alias("features"),
                       (F.array_position(order, F.col("domain")) - 1).cast("double").alias("label"))
    model = LogisticRegression(family="multinomial", maxIter=60, regParam=1e-4).fit(data)
    return domains, (model.coefficientMatrix.toArray(), model.interceptVector.toArray())


def posteriors(prof: DataFrame, domains: list[str], weights) -> DataFrame:
    """``key, doc_id, words, p`` with p the posterior over the domains in order."""
    k = max(1, len(domains))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES).astype(float)
            z = x @ weights[0].T + weights[1] if weights else np.zeros((len(x), k))
            z = np.exp(z - z.max(axis=1, keepdims=True)) if len(z) else z
            p = (z / z.sum(axis=1, keepdims=True)).round(9)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(list(p), pa.list_(pa.float64()))],
                                             ["key", "doc_id", "words", "p"])

    kinds = dict(prof.dtypes)
    return prof.mapInArrow(run, f"key {kinds['key']}, doc_id {kinds['doc_id']}, words long, p array<double>")


def rates_of(p: np.ndarray, steps: list[np.ndarray], most: float | None) -> np.ndarray:
    """Rates after the given steps from 1, each projected on [0, most]."""
    r = np.ones(len(p))
    for g in steps:
        r = np.clip(r - p @ g, 0.0, most)
    return r


def sums(soft: DataFrame, k: int, trials: list[np.ndarray], most: float | None) -> np.ndarray:
    """For each trial of multipliers, a row of: expected words of the K domains, the K by K sums of
    t p p' over the rates within their bounds, and the sum of t ((r - 1)^2 / 2 + r p m)."""
    width = k + k * k + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(trials), width))
        for b in batches:
            p = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            t = b.column(0).to_numpy(zero_copy_only=False).astype(float)
            total += [sums_of(p, t, m, most) for m in trials]
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())],
                                         ["at", "total"])

    got = soft.select("words", "p").mapInArrow(run, "at int, total double").groupBy("at").agg(
        F.sum("total").alias("total")).collect()
    out = np.zeros(len(trials) * width)
    for r in got:
        out[r["at"]] = r["total"]
    return out.reshape(len(trials), width)


def sums_of(p: np.ndarray, t: np.ndarray, m: np.ndarray, most: float | None) -> np.ndarray:
    r = rates_of(p, [m], most)
    free = t * ((r > 0) & (r < (np.inf if most is None else most)))
    return np.concatenate([(r * t) @ p, ((p * free[:, None]).T @ p).ravel(),
                           [t @ ((r - 1) ** 2 / 2 + r * (p @ m))]])


def newton(evaluate: Callable[[list[np.ndarray]], np.ndarray], have: np.ndarray,
           want: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Multipliers, totals at their rates, and if every stage reached the tolerance.

    A zero gradient of the concave function is the optimum's condition: the totals miss the targets by
    RIDGE x C x m, as in the least-squares problem with that weight.
    """
    k, c, size = len(have), np.where(have > 0, have, 1.0), want.sum()
    m, now, left, reached = np.zeros(k), evaluate([np.zeros(k)])[0], MAX_STEPS, True
    for ridge in RIDGE:
        def value(at: np.ndarray, row: np.ndarray, ridge: float = ridge) -> float:
            return row[-1] - want @ at - ridge / 2 * (c @ at ** 2)

        finest = 0
        while np.abs(slope := now[:k] - want - ridge * c * m).max() > TOLERANCE * size and left and finest < 3:
            step = np.linalg.solve(now[k:-1].reshape(k, k) + np.diag(ridge * c), slope)
            trials = [m + step * x * LENGTHS[-1] ** finest for x in LENGTHS]
            rows = evaluate(trials)
            values = [value(x, r) for x, r in zip(trials, rows, strict=True)]
            best, left = int(np.argmax(values)), left - 1
            if values[best] > value(m, now):
                m, now, finest = trials[best], rows[best], 0
            else:
                finest += 1
        reached = np.abs(slope).max() <= TOLERANCE * size
    return m, now[:k], reached


def solve(soft: DataFrame, domains: list[str], targets: dict[str, float], most: float | None = None,
          anchor: str | None = None) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Steps from rate 1 (the multipliers, if any), target totals and reached totals.

    The targets are shares. They add up to the corpus's words, or, with an
    ``anchor`` domain, to the size at which that domain keeps its words.
    """
    k = len(domains)
    if k < 2:
        return [], np.zeros(k), np.zeros(k)
    have = sums(soft, k, [np.zeros(k)], most)[0][:k]
    share = np.array([max(0.0, targets.get(d, 0.0)) for d in domains]) * (have > 0)
    if not share.sum():
        return [], have, have
    share /= share.sum()
    size = have.sum()
    if anchor in domains and share[(a := domains.index(anchor))] > 0:
        size = have[a] / share[a]
    want = share * size
    if np.abs(have - want).max() <= TOLERANCE * size:
        return [], want, have
    m, now, reached = newton(lambda trials: sums(soft, k, trials, most), have, want)
    if not reached:
        warnings.warn(f"mixing: rates not at the least-squares optimum after {MAX_STEPS} steps at most: totals "
                      f"{now.tolist()} for targets {want.tolist()}", RuntimeWarning, stacklevel=2)
    return [m], want, now


def document_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], most: float | None = None,
                   anchor: str | None = None, key: str = "doc_id") -> tuple[DataFrame, list[str]]:
    """``key, doc_id, words, p, rate`` of every row, and the domains in the order of p."""
    prof = stored(profile(docs, key), "mix-profile")
    domains, weights = classifier(prof, labelled)
    soft = stored(posteriors(prof, domains, weights), "mix-posteriors")
    k = max(1, len(domains))
    steps, _, _ = solve(soft, domains, targets, most, anchor)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rates_of(p, steps, most).round(6))],
                                             [*b.schema.names, "rate"])

    kinds = dict(soft.dtypes)
    return soft.mapInArrow(run, f"key {kinds['key']}, doc_id {kinds['doc_id']}, words long, "
                                f"p array<double>, rate double"), domains


def copies(rates: DataFrame) -> DataFrame:
    """``rates`` with ``copies``: floor(rate), and one more by the key's hash."""
    u = F.pmod(F.xxhash64("key", F.lit("mix")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    whole = F.floor("rate")
    return rates.withColumn("copies", (whole + F.when(u < F.col("rate") - whole, 1).otherwise(0)).cast("int"))


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], most: float | None = None,
        anchor: str | None = None) -> DataFrame:
    """The rows of ``docs`` at their rates: dropped, kept, or repeated."""
    docs, key = keyed(docs)
    got = copies(document_rates(docs, labelled, targets, most, anchor, key)[0])
    out = without(docs, key, got.where("copies = 0").select("key"))
    if most is None or most > 1:
        # Rows that stay as they are need no partner: only repeated ones are joined.
        k, n = fresh(docs, "_mix_key"), fresh(docs, "_mix_copies")
        more = got.where("copies > 1").select(F.col("key").alias(k), F.col("copies").alias(n))
        out = out.join(more, F.col(key) == F.col(k), "left").withColumn(
            n, F.explode(F.sequence(F.lit(1), F.coalesce(n, F.lit(1))))).drop(k, n)
    return out if key == "doc_id" else out.drop(key)

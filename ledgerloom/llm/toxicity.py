"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Fit (a bounded sample of labelled rows, ``EXAMPLES`` by a hash of their id):
terms are words, word prefixes, and prefixes with the octave of
their density in the text. All those associated with the label beyond chance
form the vocabulary: a term's G-squared over the sample exceeds 2 ln m, with m
the terms in enough rows to reach that at all, so the bar follows the number of
tests at every sample size and no count of terms is fixed. Every example becomes
a unit TF-IDF vector over it; equal vectors become one entry with its number of
examples and of toxic ones.

Index: entries in blocks of ``BLOCK``; each term has, for each block that it
occurs in, its postings and its largest weight, so its size is that of the entries. A query sums those maxima into an upper bound
per block and visits blocks in falling order of bound until the bound is below
the K-th best cosine found, so the K nearest entries are exact.

Score: votes of the K nearest entries weighted by cosine**4 and number of
examples, smoothed by the base rate, then calibrated by isotonic regression on
leave-one-out votes of the examples. A text without any vocabulary term gets
the rate of the examples without one. Evidence: the nearest examples.

Results for odd input: null and empty texts score as texts without terms;
rows with a null doc_id are scored and never learned from; labels that are null
are ignored, and of repeated labels of one id the largest counts; without
labelled rows every score is 0; repeated rows score alike; an empty table gives
no rows. Whole texts are read.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh, stored

#: Labelled rows that the index is fitted on, at most about so many.
EXAMPLES = 20_000
NEAREST = 16
BLOCK = 64
THRESHOLD = 0.3
#: Lengths of the word prefixes that are terms beside the words.
PREFIXES = (4, 5, 6, 7)
#: Terms that a task counts before it hands them on.
FLUSH = 200_000

WORDS = re.compile(r"\w+")


def octave(count: int, words: int) -> int:
    """Density of a term: whole octaves of words per occurrence."""
    return (words // count).bit_length()


def words_and_prefixes(text: str) -> tuple[Counter, Counter]:
    words = Counter(WORDS.findall(text.lower()))
    prefixes: Counter = Counter()
    for w, n in words.items():
        for k in PREFIXES:
            if len(w) > k:
                prefixes[w[:k]] += n
    return words, prefixes


def term_set(text: str) -> list[str]:
    """Terms of a text: words, ^prefixes, ^prefixes#octave."""
    words, prefixes = words_and_prefixes(text)
    n = words.total()
    return [*words, *("^" + p for p in prefixes), *(f"^{p}#{octave(c, n)}" for p, c in prefixes.items())]


def held_out(doc_id: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """Labelled texts ``doc_id, text, toxic`` to learn from."""
    lab = (labels.where("toxic is not null and doc_id is not null").where(~held_out())
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = lab.count()
    if n > examples:
        lab = lab.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(examples / n * (1 << 30)))
    got = docs.select("doc_id", "text").join(F.broadcast(lab), "doc_id")
    return stored(got.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                             (F.col("toxic") > 0).cast("int").alias("toxic")), "toxic-sample")


def g_squared(p: Column, q: Column, p_all: int, q_all: int) -> Column:
    """Likelihood-ratio statistic of a term in p of p_all positive and q of q_all negative rows."""
    n = float(p_all + q_all)

    def part(seen: Column, of: Column, side: int) -> Column:
        return F.when(seen > 0, seen * F.log(seen * n / (of * side))).otherwise(0.0)

    has, lacks = p + q, F.lit(n) - p - q
    return 2 * (part(p, has, p_all) + part(q, has, q_all) + part(p_all - p, lacks, p_all)
                + part(q_all - q, lacks, q_all))


def least_rows(seen: DataFrame, p_all: int, q_all: int) -> tuple[int, float]:
    """Rows from which a term can pass the bar, and the bar: 2 ln of the number of such terms.

    ``seen`` (term, p, q). Only as many rows as the sample has counts, at most ``EXAMPLES``, reach the driver.
    """
    counts = seen.groupBy((F.col("p") + F.col("q")).alias("c")).agg(F.count(F.lit(1)).alias("terms"))
    c, p_most, q_most = F.col("c").cast("double"), F.least("c", F.lit(p_all)), F.least("c", F.lit(q_all))
    most = F.greatest(g_squared(p_most, c - p_most, p_all, q_all), g_squared(c - q_most, q_most, p_all, q_all))
    rows = counts.select("c", "terms", most.alias("most")).orderBy("c").collect()
    left = sum(r["terms"] for r in rows)
    for r in rows:
        if r["most"] > 2 * math.log(left):
            return r["c"], 2 * math.log(left)
        left -= r["terms"]
    return 0, math.inf


def vocabulary(rows: DataFrame) -> dict[str, float]:
    """Terms associated with the label, and their inverse document frequency."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pos, neg = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            names = list(pos.keys() | neg.keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([pos[x] for x in names], pa.int64()),
                 pa.array([neg[x] for x in names], pa.int64())], ["term", "p", "q"])
            pos.clear()
            neg.clear()
            return out

        for b in batches:
            for t, y in zip(b.column(0), b.column(1), strict=True):
                (pos if y.as_py() else neg).update(term_set(t.as_py()))
                if len(pos) + len(neg) > FLUSH:
                    yield flush()
        yield flush()

    both = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("p"), F.count(F.lit(1)).alias("n")).first()
    p_all, q_all = both["p"], both["n"] - both["p"]
    if not p_all or not q_all:
        return {}
    seen = (rows.select("text", "toxic").mapInArrow(run, "term string, p long, q long")
            .groupBy("term").agg(F.sum("p").alias("p"), F.sum("q").alias("q")))
    seen = stored(seen, "toxic-terms")
    least, bar = least_rows(seen, p_all, q_all)
    g = g_squared(F.col("p").cast("double"), F.col("q").cast("double"), p_all, q_all)
    found = seen.where((F.col("p") + F.col("q") >= least) & (g > bar)).collect()  # terms of the sample
    return {r["term"]: math.log((1 + both["n"]) / (1 + r["p"] + r["q"])) + 1 for r in found}


Vector = tuple[np.ndarray, np.ndarray]  # term numbers in order, weights


def vectors(idf: dict[str, float]):
    """A function from a text to its unit vector."""
    number = {t: i for i, t in enumerate(sorted(idf))}
    known: dict[int, dict[str, dict]] = {}  # by length, prefix: its terms by octave, None for the plain one
    for t, i in number.items():
        if t[0] == "^":
            prefix, _, o = t[1:].partition("#")
            known.setdefault(len(prefix), {}).setdefault(prefix, {})[int(o) if o else None] = i
    weight = np.array([idf[t] for t in sorted(idf)])

    def vector(text: str) -> Vector:
        tf: dict[int, int] = {}
        met: dict[str, int] = {}
        words = Counter(WORDS.findall(text.lower()))
        for w, n in words.items():
            if (i := number.get(w)) is not None:
                tf[i] = n
            for k, prefixes in known.items():
                if len(w) > k and w[:k] in prefixes:
                    met[w[:k]] = met.get(w[:k], 0) + n
        for prefix, n in met.items():
            terms = known[len(prefix)][prefix]
            for o in (None, octave(n, words.total())):
                if (i := terms.get(o)) is not None:
                    tf[i] = n
        terms = np.array(sorted(tf), np.int32)
        raw = (1 + np.log([tf[i] for i in terms.tolist()])) * weight[terms] if tf else np.zeros(0)
        return terms, (raw / np.sqrt((raw * raw).sum())).round(9) if tf else raw

    return vector


@dataclass
class Model:
    """The fitted examples: distinct vectors end to end, their votes, and the calibration steps."""

    idf: dict[str, float]
    terms: np.ndarray
    weights: np.ndarray
    lengths: np.ndarray
    n: np.ndarray
    toxic: np.ndarray
    example: list
    base: float = 0.0
    empty: float = 0.0
    steps: tuple[list[float], list[float]] = ((), ())

    def calibrated(self, vote: float) -> float:
        at, value = self.steps
        return value[max(0, bisect.bisect_right(at, vote) - 1)] if at else vote


def runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, .. of each run, end to end."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


class BlockMaxIndex:
    """Postings of the entries by block and term, and each term's largest weight by block."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, lengths: np.ndarray, n_terms: int,
                 block: int = BLOCK):
        self.block = block
        entry = np.repeat(np.arange(len(lengths)), lengths)
        order = np.lexsort((entry, terms, entry // block))
        terms, self.weights, entry = terms[order], weights[order], entry[order]
        self.blocks = -(-len(lengths) // block)
        self.at = entry % block
        # One list of postings for each block and term that meet, in order of block * n_terms + term.
        cell = (entry // block).astype(np.int64) * n_terms + terms
        first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.zeros(0, int)
        self.cells, self.starts = cell[first], first
        self.sizes = np.diff(np.concatenate((first, [len(cell)])))
        self.n_terms = n_terms
        # The lists' largest weights, by term: those of term t are numbers first_of[t] to first_of[t + 1].
        by_term = np.argsort(terms[first], kind="stable")
        self.peak = (np.maximum.reduceat(self.weights, first) if len(first) else np.zeros(0))[by_term]
        self.peak_block = (entry[first] // block)[by_term]
        self.first_of = np.searchsorted(terms[first][by_term], np.arange(n_terms + 1))

    def bounds(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For each block an upper bound of the cosines of its entries."""
        size = self.first_of[terms + 1] - self.first_of[terms]
        at = runs(self.first_of[terms], size)
        return np.bincount(self.peak_block[at], self.peak[at] * np.repeat(weights, size), self.blocks)

    def nearest(self, vec: Vector, k: int) -> list[tuple[float, int]]:
        """The k entries of largest cosine above 0, as ``(cosine, entry)``; ties by entry.

        Blocks are visited in falling order of bound, 1, 2, 4, .. of them at a time.
        """
        terms, weights = vec
        bound = self.bounds(terms, weights)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        score, entry, size = np.zeros(0), np.zeros(0, int), 1
        while len(order):
            now, order, size = order[:size], order[size:], 2 * size
            new = self.scores(now, terms, weights).round(9)
            hit = np.flatnonzero(new)
            score = np.concatenate((score, new[hit]))
            entry = np.concatenate((entry, now[hit // self.block] * self.block + hit % self.block))
            if len(score) > k:
                near = score >= -np.partition(-score, k - 1)[k - 1]
                score, entry = score[near], entry[near]
                best = np.lexsort((entry, -score))[:k]
                score, entry = score[best], entry[best]
            if len(score) == k:
                order = order[bound[order] >= score.min() - 1e-8]
        best = np.lexsort((entry, -score))
        return list(zip(score[best].tolist(), entry[best].tolist(), strict=True))

    def scores(self, blocks: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Cosines of the entries of some blocks, end to end, from the lists of the query's terms."""
        want = (blocks[:, None] * self.n_terms + terms.astype(np.int64)).ravel()
        i = np.searchsorted(self.cells, want)
        has = np.flatnonzero(self.cells[np.minimum(i, len(self.cells) - 1)] == want)
        i = i[has]
        size = self.sizes[i]
        at = runs(self.starts[i], size)
        row = np.repeat(has // len(terms) * self.block, size) + self.at[at]
        return np.bincount(row, self.weights[at] * np.repeat(weights[has % len(terms)], size),
                           len(blocks) * self.block)


def vote(found: list[tuple[float, int]], model: Model, label: int | None = None) -> float:
    """Share of toxic among the nearest, by cosine**4; ``label``: of an example left out of the first entry."""
    up, down = model.base, 1.0
    for i, (s, e) in enumerate(found):
        n, y = int(model.n[e]), int(model.toxic[e])
        if label is not None and i == 0:
            n, y = n - 1, y - label
        up, down = up + s**4 * y, down + s**4 * n
    return up / down


def isotonic(points: list[tuple[float, float, float]]) -> tuple[list[float], list[float]]:
    """Pool adjacent violators over ``(x, rate, weight)``: step starts and values."""
    pools: list[list[float]] = []
    for x, y, w in sorted(points):
        pools.append([x, y * w, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            _, s, w2 = pools.pop()
            pools[-1][1] += s
            pools[-1][2] += w2
    return [p[0] for p in pools], [p[1] / p[2] for p in pools]


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> Model:
    rows = sample(docs, labels, examples)
    idf = vocabulary(rows)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = vectors(idf)
        for b in batches:
            got = [vector(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([i for i, _ in got], pa.list_(pa.int32())),
                 pa.array([w for _, w in got], pa.list_(pa.float64()))], ["doc_id", "toxic", "terms", "weights"])

    made = stored(rows.select("doc_id", "text", "toxic").mapInArrow(
        run, f"doc_id {kind}, toxic int, terms array<int>, weights array<double>")
        .groupBy("terms", "weights").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic"),
                                         F.min("doc_id").alias("example")), "toxic-entries")
    all_ = made.agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).first()
    none = made.where(F.size("terms") == 0).agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).first()
    some = made.where(F.size("terms") > 0)
    got = some.toArrow().combine_chunks()  # at most EXAMPLES entries
    # Entries in order of their terms: those that share terms share blocks, which keeps the bounds near.
    order = sorted(range(len(got)), key=list(zip(*(got.column(c).to_pylist() for c in ("terms", "weights")),
                                                 strict=True)).__getitem__)
    got = got.take(pa.array(order, pa.int64())).combine_chunks()
    terms, weights = (got.column(c).combine_chunks() for c in ("terms", "weights"))
    model = Model(idf, terms.flatten().to_numpy(zero_copy_only=False), weights.flatten().to_numpy(zero_copy_only=False),
                  pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64),
                  *(got.column(c).to_numpy() for c in ("n", "toxic")), got.column("example").to_pylist())
    if not all_["n"]:
        return model
    model.base = all_["toxic"] / all_["n"]
    model.empty = ((none["toxic"] or 0) + model.base) / ((none["n"] or 0) + 1)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Leave-one-out votes: the nearest entry is the vector itself, so the example is left out of that."""
        m = shared.value
        index = index_of(m)
        for b in batches:
            out = []
            for t, w, n, y in zip(*b.columns, strict=True):
                near = index.nearest((np.array(t.as_py(), np.int32), np.array(w.as_py())), NEAREST)
                n, y = n.as_py(), y.as_py()
                out += [(vote(near, m, label), float(label), float(k)) for label, k in ((1, y), (0, n - y)) if k]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()) for x in (zip(*out) if out else [[]] * 3)],
                                             ["vote", "label", "n"])

    points = some.select("terms", "weights", "n", "toxic").repartition(
        docs.sparkSession.sparkContext.defaultParallelism).mapInArrow(votes, "vote double, label double, n double")
    points = points.groupBy(F.round("vote", 6).alias("vote")).agg(
        F.sum(F.col("label") * F.col("n")).alias("y"), F.sum("n").alias("n")).collect()
    model.steps = isotonic([(r["vote"], r["y"] / r["n"], r["n"]) for r in points])
    return model


def index_of(model: Model) -> BlockMaxIndex:
    return BlockMaxIndex(model.terms, model.weights, model.lengths, len(model.idf))


def scores(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted, evidence`` of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most EXAMPLES short vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, score = shared.value, scorer(shared.value)
        for b in batches:
            got = [score(t.as_py() or "") for t in b.column(1)]
            evidence = [[{"example": model.example[e], "cosine": s} for s, e in near[:3]] for _, near in got]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([s for s, _ in got], pa.float64()),
                 pa.array([int(s >= threshold) for s, _ in got], pa.int32()),
                 pa.array(evidence, pa.list_(pa.struct([("example", b.column(0).type), ("cosine", pa.float64())])))],
                ["doc_id", "score", "predicted", "evidence"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, predicted int, evidence array<struct<example: {kind}, cosine: double>>")


def score_documents(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, evidence``."""
    out = scores(docs, fit(docs, labels, examples))
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted", "evidence")


def reject(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns, without a shuffle."""
    model = fit(docs, labels, examples)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxic_score(texts):
        score = scorer(shared.value)
        return texts.map(lambda t: score(t)[0])

    name = fresh(docs, "_toxic_score")
    return docs.withColumn(name, toxic_score(F.coalesce("text", F.lit("")))).where(
        F.col(name) < THRESHOLD).drop(name)


_scorers: dict[int, tuple[Model, object]] = {}


def scorer(model: Model):
    """A function from a text to its score and nearest entries; built once per worker and model."""
    if id(model) not in _scorers:
        _scorers.clear()
        vector, index = vectors(model.idf), index_of(model)

        def score(text: str) -> tuple[float, list]:
            vec = vector(text)
            near = index.nearest(vec, NEAREST) if len(vec[0]) else []
            value = model.calibrated(vote(near, model)) if near else model.empty
            return min(1.0, max(0.0, value)), near

        _scorers[id(model)] = (model, score)
    return _scorers[id(model)][1]

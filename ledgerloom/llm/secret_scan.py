r"""Secret scans with a randomness test battery; native expressions only.

Base spans: assignments to secret-like names, access keys and long hex runs, by
pattern. Positions come from the gaps between matches: a pattern's gaps
(``split``) and matches (``regexp_extract_all``) are exploded in order and
their lengths summed by a window within the row; texts are never shuffled.

Method spans: other runs of ``MIN_LENGTH`` or more token characters, also right
after an ``=``; an ``=`` before token characters ends a run. For each
the encoding is inferred from its characters (hex, base32 in either case, letters
or letters and digits of one case, base64 or its URL form, alphanumeric) and its codes are put to three tests of randomness: chi-squared
uniformity over the encoding's alphabet, runs about the middle of the alphabet,
and serial correlation. Fisher's combination of the three rejects what is not
uniformly random (``NOT_RANDOM``). For the others the likelihood ratio of a
uniform source against the letter frequencies of the rejected runs of the
corpus (within the alphabet for encodings of one case) is an e-value: it grows with length, so a short run that merely looks
random proves little. Within each octave of length, e-BH controls the false
discovery rate at ``FDR`` under any dependence; the number of runs above each
threshold is counted in bins, so ranks need no global sort.

Results for odd input: null and empty texts have no spans; rows are addressed
by a row key, so null or repeated ids give one row each; spans of one kind never
overlap; runs that touch a base span are left to it; an empty table gives no
rows. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import keyed, stored

# The kinds in order, their patterns, and the least length of what counts.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "random"]
MIN_SECRET, MIN_ACCESS = 6, 20

MIN_LENGTH = 20
# One or two '=' after a run are its padding unless a token character or another '=' follows them.
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
NOT_RANDOM = 1e-3
FDR = 0.01
#: Width in nats, and number, of the bins in which e-values are counted.
BIN, BINS = 0.25, 2_000

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = {
    "hex": DIGITS + "abcdef", "HEX": DIGITS + "ABCDEF", "base32": UPPER + "234567",
    "base64": UPPER + LOWER + DIGITS + "+/", "base64url": UPPER + LOWER + DIGITS + "-_",
    "alnum": UPPER + LOWER + DIGITS,
    "lower": LOWER, "upper": UPPER, "lower32": LOWER + "234567", "lower36": LOWER + DIGITS, "upper36": UPPER + DIGITS}
#: Encodings of one case. Words are of one case too, so their letters are counted in either case and their
#: frequencies taken within the alphabet: the case alone is no evidence.
ONE_CASE = ["lower", "upper", "lower32", "lower36", "upper36"]


def hits(text: Column, rank: int, pattern: str, cheap: Column, group: int | None = None) -> Column:
    """Matches of a pattern in order: ``rank, gap`` (characters before it), ``match, secret``."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.transform(F.split(text, pattern, -1), lambda s: F.length(s))
    rows = F.transform(F.arrays_zip(gaps.alias("gap"), whole.alias("match"), part.alias("secret")),
                       lambda x, i: F.struct(F.lit(rank).alias("rank"), i.alias("at"), x["gap"].alias("gap"),
                                             x["match"].alias("match"), x["secret"].alias("secret")))
    return F.when(cheap & text.rlike(pattern), rows)


def found(docs: DataFrame, key: str) -> DataFrame:
    """All matches: ``key, rank, start, end, match``; failing ones dropped."""
    text = F.coalesce(F.col("text"), F.lit(""))
    any_name = text.rlike(r"(?i:passw|secret|token|api_?key)")
    kinds = [hits(text, 0, ASSIGN, any_name, 2), hits(text, 1, ACCESS, text.contains("AKIA")),
             hits(text, 2, HEX, F.lit(True)), hits(text, 3, RUN, F.lit(True))]
    empty = F.array().cast("array<struct<rank:int,at:int,gap:int,match:string,secret:string>>")
    rows = docs.select(F.col(key).alias("key"),
                       F.explode(F.concat(*(F.coalesce(k, empty) for k in kinds))).alias("m")).select("key", "m.*")
    before = W.partitionBy("key", "rank").orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.sum(F.col("gap") + F.coalesce(F.length("match"), F.lit(0))).over(before).cast("int")
    rows = rows.select("key", "rank", "match", "secret", end.alias("end")).where("match is not null")
    passes = (F.when(F.col("rank") == 0, F.length("secret") >= MIN_SECRET)
              .when(F.col("rank") == 1, F.length("match") >= MIN_ACCESS).otherwise(True))
    return rows.where(passes).select("key", "rank", (F.col("end") - F.length("match")).alias("start"), "end", "match")


def normal_tail(z: Column) -> Column:
    """P(Z > z), by the rational approximation 26.2.17 of Abramowitz and Stegun."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * poly
    return F.greatest(F.lit(1e-300), F.when(z >= 0, tail).otherwise(1 - tail))


def encoding(s: Column) -> Column:
    return (F.when(s.rlike("^[0-9a-f]+$"), "hex").when(s.rlike("^[0-9A-F]+$"), "HEX")
            .when(s.rlike("^[a-z]+$"), "lower").when(s.rlike("^[A-Z]+$"), "upper")
            .when(s.rlike("^[A-Z2-7]+$"), "base32").when(s.rlike("^[a-z2-7]+$"), "lower32")
            .when(s.rlike("^[a-z0-9]+$"), "lower36").when(s.rlike("^[A-Z0-9]+$"), "upper36")
            .when(s.rlike("[+/]"), "base64")
            .when(s.rlike("[_-]"), "base64url").otherwise("alnum"))


def battery(runs: DataFrame) -> DataFrame:
    """Adds ``body, code, size, p_chi, p_runs, p_serial, p_random`` to runs with a ``match``."""
    body = F.regexp_replace("match", "=+$", "")
    alphabet = F.lit(None).cast("string")
    for name, letters in ALPHABETS.items():
        alphabet = F.when(F.col("code") == name, letters).otherwise(alphabet)
    out = runs.withColumn("body", body).withColumn("code", encoding(F.col("body")))
    out = out.withColumn("alphabet", alphabet).withColumn("size", F.length("alphabet").cast("double"))
    out = out.withColumn("n", F.length("body").cast("double"))
    # A run that mixes both forms of base64 has characters outside its alphabet: code -1.
    out = out.withColumn("x", F.transform(F.split("body", ""), lambda c: (
        F.position(c, F.col("alphabet")) - 1).cast("double")))
    squares = F.aggregate(F.array_distinct("x"), F.lit(0.0), lambda s, v: s + F.pow(
        F.size(F.filter("x", lambda y: y == v)).cast("double"), F.lit(2.0)))
    n, k = F.col("n"), F.col("size")
    df = k - 1
    chi = k / n * squares - n
    z_chi = (F.cbrt(F.greatest(chi, F.lit(0.0)) / df) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    high = F.transform("x", lambda v: F.when(v >= F.col("size") / 2, 1).otherwise(0))
    out = out.withColumn("p_chi", normal_tail(z_chi)).withColumn("high", high)
    ones = F.aggregate("high", F.lit(0), lambda s, v: s + v).cast("double")
    pairs = F.sequence(F.lit(1), F.length("body") - 1)
    changes = F.aggregate(pairs, F.lit(0), lambda s, i: s + F.when(
        F.get("high", i) != F.get("high", i - 1), 1).otherwise(0)).cast("double")
    mean = F.aggregate("x", F.lit(0.0), lambda s, v: s + v) / n
    out = out.withColumn("ones", ones).withColumn("changes", changes).withColumn("mean", mean)
    mu = 2 * F.col("ones") * (n - F.col("ones")) / n + 1
    var = (mu - 1) * (mu - 2) / (n - 1)
    z_runs = F.when(var > 0, (F.col("changes") + 1 - mu) / F.sqrt(var)).otherwise(F.lit(12.0))
    cov = F.aggregate(pairs, F.lit(0.0), lambda s, i: s + (F.get("x", i) - F.col("mean"))
                      * (F.get("x", i - 1) - F.col("mean")))
    spread = F.aggregate("x", F.lit(0.0), lambda s, v: s + F.pow(v - F.col("mean"), F.lit(2.0)))
    z_serial = F.when(spread > 0, cov / spread * F.sqrt(n)).otherwise(F.lit(12.0))
    out = (out.withColumn("p_runs", F.least(F.lit(1.0), 2 * normal_tail(F.abs(z_runs))))
           .withColumn("p_serial", F.least(F.lit(1.0), 2 * normal_tail(F.abs(z_serial)))))
    half = -(F.log("p_chi") + F.log("p_runs") + F.log("p_serial"))  # half of Fisher's statistic, 6 degrees
    return out.withColumn("p_random", F.exp(-half) * (1 + half + half * half / 2)).drop(
        "x", "high", "ones", "changes", "mean", "alphabet")


def discoveries(tested: DataFrame) -> DataFrame:
    """The runs that pass the battery and e-BH within their octave of length."""
    rejected = tested.where(F.col("p_random") < NOT_RANDOM)
    letters = rejected.select(F.explode(F.split("body", "")).alias("c")).groupBy("c").agg(
        F.count(F.lit(1)).alias("n")).collect()  # at most one row per token character
    total = sum(r["n"] for r in letters) + 66
    cost = {r["c"]: -math.log((r["n"] + 1) / total) for r in letters}
    table = F.create_map(*(F.lit(x) for c in sorted(cost) for x in (c, cost[c]))) if cost else F.lit(None).cast(
        "map<string,double>")
    folded: Counter[str] = Counter()
    for r in letters:
        folded[r["c"].lower()] += r["n"]
    for code in ONE_CASE:
        alphabet = ALPHABETS[code].lower()
        within = sum(folded[c] for c in alphabet) + len(alphabet)
        own = F.create_map(*(F.lit(x) for c in alphabet for x in (c, math.log(within / (folded[c] + 1)))))
        table = F.when(F.col("code") == code, own).otherwise(table)
    other = F.lit(math.log(total))
    shown = F.when(F.col("code").isin(ONE_CASE), F.lower("body")).otherwise(F.col("body"))
    costs = tested.withColumn("table", table).withColumn("prose", F.aggregate(
        F.split(shown, ""), F.lit(0.0), lambda s, c: s + F.coalesce(F.try_element_at("table", c), other)))
    prose = F.col("prose")
    e = prose - F.col("n") * F.log("size")
    octave = F.floor(F.log2("n")).cast("int")
    rows = costs.withColumn("octave", octave).withColumn("bin", F.when(
        F.col("p_random") < NOT_RANDOM, -1).otherwise(F.least(F.lit(BINS), F.greatest(
            F.lit(-1), F.floor(e / BIN)))).cast("int"))
    counts = rows.groupBy("octave", "bin").agg(F.count(F.lit(1)).alias("n")).collect()  # at most BINS per octave
    cut: dict[int, int] = {}
    for o in {r["octave"] for r in counts}:
        bins = sorted(((r["bin"], r["n"]) for r in counts if r["octave"] == o), reverse=True)
        tests, above = sum(n for _, n in bins), 0
        for b, n in bins:
            above += n
            if b >= 0 and b * BIN >= math.log(tests / (FDR * above)):
                cut[o] = b
    accept = F.lit(False)
    for o, b in cut.items():
        accept = accept | ((F.col("octave") == o) & (F.col("bin") >= b))
    return rows.where(accept).drop("table", "prose")


def spans(docs: DataFrame, key: str) -> DataFrame:
    """Base and method spans: ``key, rank, start, end``."""
    rows = stored(found(docs, key), "secret-matches")
    base = rows.where("rank < 3").select("key", "rank", "start", "end")
    order = W.partitionBy("key").orderBy("start")
    last = F.max(F.when(F.col("rank") < 3, F.col("end"))).over(order.rangeBetween(W.unboundedPreceding, W.currentRow))
    first = F.min(F.when(F.col("rank") < 3, F.col("start"))).over(order.rangeBetween(W.currentRow, W.unboundedFollowing))
    free = (rows.withColumn("last", last).withColumn("first", first).where("rank = 3")
            .where((F.coalesce("last", F.lit(0)) <= F.col("start"))
                   & (F.col("first").isNull() | (F.col("first") >= F.col("end")))))
    tested = stored(battery(free.drop("last", "first")), "secret-tests")
    return base.unionByName(discoveries(tested).select("key", "rank", "start", "end"))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``."""
    docs, key = keyed(docs.select("doc_id", "text"))
    s = spans(docs, key)
    name = F.array(*(F.lit(k) for k in KINDS))
    label = F.concat_ws(":", F.get(name, F.col("rank")), "start", "end")
    one = F.struct("start", "rank", label.alias("label"))

    def joined(rows: Column) -> Column:
        return F.concat_ws(",", F.transform(F.sort_array(rows), lambda x: x["label"]))

    of = s.groupBy("key").agg(
        *(F.count(F.when(F.col("rank") == i, 1)).alias(f"n_{KINDS[i]}") for i in range(3)),
        joined(F.collect_list(F.when(F.col("rank") < 3, one))).alias("base"),
        joined(F.collect_list(one)).alias("spans")).withColumnRenamed("key", "skey")
    out = docs.select(F.col(key).alias("key"), "doc_id").join(of, F.col("key") == F.col("skey"), "left")
    return out.select("doc_id", *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
                      F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"))

"""Keyword matching for dictionaries of any size (FLT3-FLT6, JN10, CM9).

``tag`` gives flags, ``match_rows`` one row per matching word. Up to ``COMPILE_MAX``
words ``tag`` compiles the dictionary into one JVM expression (``functions.text.matches``). A
larger one stays distributed: every word has sets of literals, of each of which a match holds one (a LIKE pattern's
longest fixed part; what ``functions.regex_literals`` reads from a regular expression); of a word's sets the
one with the rarest and longest literals counts. The literals' beginnings (``HEADS``, so few that they are broadcast) tell
where in a comment a literal may start and how long it may be; every distinct comment emits these pieces under a number
of its own. A literal that an expression has at the end of the text is looked for there alone. An equi join on the
whole literal gives the words: plain ones are found by that, the others are verified by ``LIKE`` or ``RLIKE``. Words without a literal meet all comments in blocks of ``BLOCK``
words: LIKE patterns of wildcards only ask for a length, expressions are compiled a block at a time, and
each block's hits are written before the next is read, so no more than a block is ever on the driver.

The answers are those of the expression at every size; ``not_any`` counts the words
present against all of them. NULL comments match nothing and take no part in a join. Frames that grow with the
tables are joined by ``merge``: the size of a file says little of its rows, and such a frame, taken for a
small one and broadcast, would fill the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.regex_literals import literals as read_literals
from ..functions.text import KeywordError, folded, matches
from ..session import scratch_path, ship_package, stored
from ..sources.keywords import LISTS, list_columns, load_lists_upto, long_form

COMPILE_MAX = 512
#: Different beginnings of literals that are broadcast (as counted by a sketch), and their greatest length.
HEADS, HEAD = 4096, 16
#: Words without a literal that are compiled together.
BLOCK = 256
#: Words up to which ``match_rows`` needs no join.
DIRECT = 256
#: A comment of more than one operation in so many is joined in as many parts as SALTS.
HOT, SALTS = 1024, 64
# Characters that make a regex fragment more than plain text.
_META = r"[\\.\[\]{}()*+?^$|]"
# What may follow the place of a regex's final $.
_LINE_ENDS = ("", "\n", "\r\n", "\r", "\u0085", "\u2028", "\u2029")


def _body(mode: str) -> Column:
    """What LIKE verifies of a word without a stray backslash; a regular expression is itself."""
    return F.concat(F.lit(" "), F.col("word"), F.lit(",")) if mode == "token" else F.col("word")


def _known_words(words: DataFrame, mode: str) -> DataFrame:
    """``_literals``, stored; what the word itself tells is not stored again."""
    made = _literals(words, mode)
    usual, one = F.col("body") == _body(mode), F.array(F.array("body"))
    kept = stored(made.withColumns({
        "literals": F.when(~F.col("plain") | (F.col("literals") != one) | (F.length("body") == 0), F.col("literals")),
        "body": F.when(~usual, F.col("body"))}), "keyword-words")
    return kept.withColumn("body", F.coalesce("body", _body(mode))).withColumn("literals", F.coalesce(
        "literals", F.when(F.col("plain") & (F.length("body") > 0), one))).select(*made.columns)


def _literals(words: DataFrame, mode: str) -> DataFrame:
    """list, word, body (what LIKE verifies), plain, literals (sets; null: none known), need (least length).

    For expressions also ``end``: the literal at the end of the text, if any.
    """
    if mode == "regex":
        return _regex_literals(words)
    w = F.col("word")
    valid = F.regexp_replace(w, r"(?<!\\)((?:\\\\)*)\\(?![%_\\])", r"$1\\\\")
    body = F.concat(F.lit(" "), valid, F.lit(",")) if mode == "token" else valid
    marks = ["\ue000", "\ue001", "\ue002"]  # private use: stand for the escaped %, _ and backslash
    shown = F.col("body")
    for mark, escaped in zip(reversed(marks), (r"\\\\", r"\\_", r"\\%"), strict=True):
        shown = F.regexp_replace(shown, escaped, mark)
    parts = F.transform(F.split(F.col("shown"), "[%_]"),
                        lambda p: F.translate(p, "".join(marks), "%_\\"))
    sized = F.transform(parts, lambda p: F.struct(F.length(p).alias("n"), p.alias("part")))
    longest = F.array_max(sized)["part"]
    return (words.select("list", "word").distinct().withColumn("body", body).withColumn("shown", shown)
            .select("list", "word", "body", (~F.col("shown").rlike("[%_]")).alias("plain"),
                    F.when(F.length(longest) > 0, F.array(F.array(longest))).alias("literals"),
                    F.length(F.regexp_replace("shown", "%", "")).alias("need")))


def _regex_literals(words: DataFrame) -> DataFrame:
    """The same for regular expressions, after a check that each one is valid on its own."""
    words = words.select("list", "word")
    try:
        words.agg(F.count_if(F.rlike(F.lit(""), F.col("word")))).collect()
    except (Py4JJavaError, PySparkException) as e:
        if "PatternSyntaxException" in str(e) or "PATTERN" in str(e):
            raise KeywordError from e
        raise
    ship_package(words.sparkSession)
    words = words.distinct()
    plain = ~F.col("word").rlike(_META)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [read_literals(w) for w in b.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([x or None for x, _ in found], pa.list_(pa.list_(pa.string()))),
                 pa.array([x for _, x in found], pa.string())], [*b.schema.names, "literals", "end"])

    schema = "list string, word string, body string, plain boolean, literals array<array<string>>, end string"
    body = F.col("word").alias("body")
    simple = words.where(plain).select("list", "word", body, F.lit(True).alias("plain"),
                                       F.when(F.length("word") > 0, F.array(F.array("word"))).alias("literals"),
                                       F.lit(None).cast("string").alias("end"))
    rest = words.where(~plain).select("list", "word", body, F.lit(False).alias("plain")).mapInArrow(read, schema)
    return simple.unionByName(rest).withColumn("need", F.lit(0))


def _chosen(words: DataFrame, mode: str) -> DataFrame:
    """list, word, body, plain, literal, final: one row for each literal of the best of each word's sets.

    Few words share the best set's literals, and these are long: a character counts as much as four times fewer words.
    ``final``: the literal stands at the end of the text.
    """
    kept = ["list", "word", "body", "plain"]
    sets = words.where(F.col("literals").isNotNull())
    if mode != "regex":  # a LIKE pattern has one literal
        return sets.select(*kept, F.col("literals")[0][0].alias("literal"), F.lit(False).alias("final"))
    only = F.col("literals")[0]
    final = (F.size(only) == 1) & F.coalesce(F.col("end").endswith(only[0]), F.lit(False))
    one = sets.where(F.size("literals") == 1).select(*kept, final.alias("final"), F.explode(only).alias("literal"))
    # An expression is its own body and not plain: only the word goes through the shuffles.
    more = sets.where(F.size("literals") > 1).select("list", "word", "end", F.posexplode("literals").alias("set", "of")).select(
        "list", "word", "set", (F.size("of") == 1) & F.coalesce(F.col("end").endswith(F.col("of")[0]), F.lit(False)),
        F.explode("of")).toDF("list", "word", "set", "final", "literal")
    shared = more.groupBy("literal").agg(F.count(F.lit(1)).alias("n"))
    more = more.join(shared.hint("merge"), "literal")
    score = F.log2(F.sum("n")) - 2 * F.min(F.length("literal"))
    best = more.groupBy("list", "word", "set", "final").agg(
        score.alias("score"), F.collect_set("literal").alias("of")).groupBy("list", "word").agg(
        F.min(F.struct("score", "set", "of", "final")).alias("best"))
    best = best.select("list", "word", F.col("word").alias("body"), F.lit(False).alias("plain"), "best.final",
                       F.explode("best.of").alias("literal"))
    return stored(one.unionByName(best), "keyword-literals").select(*kept, "literal", "final")


def _heads(literals: DataFrame) -> tuple[DataFrame, int]:
    """head, lengths and finals (of the literals that begin so, in the text or at its end) and the length of the shortest head.

    Heads are as many characters long as HEADS allows, or a whole shorter literal.
    """
    sizes = range(1, HEAD + 1)
    seen = literals.agg(F.min(F.length("literal")).alias("least"), *[
        F.approx_count_distinct(F.substring("literal", 1, k)).alias(f"n_{k}") for k in sizes]).first()
    size = max([k for k in sizes if seen[f"n_{k}"] <= HEADS], default=0)
    first = min(size, seen["least"] or 0)
    n = F.length("literal")
    heads = literals.groupBy(F.substring("literal", 1, size).alias("head")).agg(
        F.collect_set(F.when(~F.col("final"), n)).alias("lengths"), F.collect_set(F.when(F.col("final"), n)).alias("finals"))
    return heads, first


def _pieces(comments: DataFrame, literals: DataFrame) -> DataFrame:
    """The columns of ``comments`` but c, and piece, final: what may be a literal, once a comment; final ones stand at its end.

    ``literals``: literal and, where some are sought at the end alone, final.
    """
    if "final" not in literals.columns:
        literals = literals.withColumn("final", F.lit(False))
    heads, first = _heads(literals)
    # Few places begin as some head does; only these are tried with the heads' lengths.
    starts = heads.groupBy(F.substring("head", 1, first).alias("start")).agg(F.collect_set(F.length("head")).alias("sizes"))
    places = comments.where(F.length("c") > 0).withColumn("at", F.explode(F.sequence(F.lit(1), F.length("c")))).withColumn(
        "start", F.substr("c", "at", F.lit(first))).join(F.broadcast(starts), "start").withColumn(
        "size", F.explode("sizes")).where(F.col("at") + F.col("size") - 1 <= F.length("c"))
    tried = F.expr("concat(transform(lengths, n -> struct(n AS size, false AS final)),"
                   " transform(finals, n -> struct(n AS size, true AS final)))")
    found = places.withColumn("head", F.substr("c", "at", "size")).join(F.broadcast(heads), "head").drop("size").select(
        "*", F.inline(tried)).where(F.col("at") + F.col("size") - 1 <= F.length("c"))
    rest = F.substr("c", F.col("at") + F.col("size"))
    return found.withColumn("piece", F.substr("c", "at", "size")).where(
        F.when(F.col("final"), rest.isin(*_LINE_ENDS)).otherwise(F.instr("c", F.col("piece")) == F.col("at"))).drop(
        "c", "at", "start", "sizes", "size", "head", "lengths", "finals")


def _anchor_pairs(comments: DataFrame, words: DataFrame, mode: str) -> DataFrame:
    """The columns of ``comments`` (i, c, ..) but c, and list, word: the words that have literals and occur in the comment.

    A plain word is its literal and so comes once a comment; another comes once a literal.
    """
    chosen = _chosen(words, mode)
    pieces, same = _pieces(comments, chosen.select("literal", *["final"] * (mode == "regex"))), F.col("piece") == F.col("literal")
    if mode == "regex":
        near = pieces.withColumnRenamed("final", "_final").join(
            chosen.hint("merge"), same & (F.col("_final") == F.col("final"))).drop("piece", "_final", "literal", "final")
    else:
        near = pieces.drop("final").join(chosen.drop("final").hint("merge"), same).drop("piece", "literal")
    pairs = near.where("plain").drop("body", "plain")
    if not chosen.where(~F.col("plain")).limit(1).collect():
        return pairs
    test = F.expr("c RLIKE word" if mode == "regex" else "c LIKE concat('%', body, '%')")
    rest = near.where(~F.col("plain")).drop(*(["body", "plain"] if mode == "regex" else ["plain"]))
    return pairs.unionByName(rest.join(comments.select("i", "c").hint("merge"), "i").where(test).select(*pairs.columns))


def _bare(words: DataFrame) -> DataFrame:
    return words.where(F.col("literals").isNull())


def _blocks(bare: DataFrame, block: int) -> Iterator[list]:
    """The rows of ``bare``, a bounded block at a time, in order of word and list."""
    last = None
    while True:
        left = bare if last is None else bare.where(
            (F.col("word") > last["word"]) | ((F.col("word") == last["word"]) & (F.col("list") > last["list"])))
        rows = left.orderBy("word", "list").limit(block).collect()
        if rows:
            yield rows
        if len(rows) < block:
            return
        last = rows[-1]


def _bare_pairs(comments: DataFrame, bare: DataFrame, mode: str, with_words: bool) -> DataFrame | None:
    """The columns of ``comments`` but c, and list(, word), of words without a literal: blocks of words against all comments."""
    path, some = scratch_path(comments.sparkSession, "keyword-blocks"), False
    for rows in _blocks(bare, BLOCK):
        some = True
        if with_words:
            hit = [F.when(matches("c", [r["word"]], mode), F.struct(F.lit(r["list"]).alias("list"),
                                                                    F.lit(r["word"]).alias("word"))) for r in rows]
        else:
            hit = [F.when(matches("c", [r["word"] for r in rows if r["list"] == x], mode),
                          F.struct(F.lit(x).alias("list"))) for x in sorted({r["list"] for r in rows})]
        found = comments.withColumn("hit", F.explode(F.array_compact(F.array(*hit)))).select("*", "hit.*").drop("c", "hit")
        found.write.mode("append").parquet(path)
    return comments.sparkSession.read.parquet(path) if some else None


def _flags(comments: DataFrame, words: DataFrame, mode: str, lists: list[str]) -> DataFrame:
    """c and one boolean per list; comments whose flags are all ``mode == 'not_any'`` are left out."""
    words = _known_words(words, mode)
    pairs = _anchor_pairs(comments, words, mode)
    pairs = pairs.select("i", "list")  # LIKE words have one literal: not_any counts each once
    bare: dict[str, Column] = {}
    if mode == "regex":
        more = _bare_pairs(comments, _bare(words), mode, False)
        pairs = pairs if more is None else pairs.unionByName(more)
    else:  # wildcards only: a word occurs in every comment of its length
        for r in _bare(words).groupBy("list", "need").agg(F.count(F.lit(1)).alias("n")).collect():
            bare[r["list"]] = bare.get(r["list"], F.lit(0)) + F.when(F.length("c") >= r["need"], r["n"]).otherwise(0)
    counts = pairs.groupBy("i").agg(*[F.count_if(F.col("list") == x).alias(f"n_{x}") for x in lists])
    if bare:  # such words can hit comments that no pair names
        counts = comments.join(counts.hint("merge"), "i", "left")
    totals = {}
    if mode == "not_any":
        totals = {r["list"]: r["n"] for r in words.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    columns = []
    for x in lists:
        n = F.coalesce(F.col(f"n_{x}"), F.lit(0)) + bare.get(x, F.lit(0))
        columns.append(((n < totals.get(x, 0)) if mode == "not_any" else (n > 0)).alias(f"hit_{x}"))
    flags = counts.select(*([F.col("c")] if bare else [F.col("i")]), *columns)
    rare = [~F.col(f"hit_{x}") if mode == "not_any" else F.col(f"hit_{x}") for x in lists]
    flags = flags.where(reduce(Column.__or__, rare))
    return flags if bare else flags.join(comments.hint("merge"), "i").drop("i")


def _numbered(comments: DataFrame) -> DataFrame:
    """Distinct comments, stored, each with a number ``i`` of its own."""
    return stored(comments.withColumn("i", F.monotonically_increasing_id()), "keyword-comments")


def tag(df: DataFrame, keywords: DataFrame, modes: dict[str, str], comment: str = "Comment",
        trim_comment: bool = False, trim_words: bool = False) -> DataFrame:
    """``df`` with a boolean ``hit_<list>`` for each list of ``modes`` (NULL comments: False)."""
    lists = load_lists_upto(keywords, COMPILE_MAX, trim_words)
    if lists is not None:
        return df.select("*", *[F.coalesce(matches(comment, lists[x], m, trim_comment), F.lit(False))
                                .alias(f"hit_{x}") for x, m in modes.items()])
    c = F.trim(F.col(comment)) if trim_comment else F.col(comment)
    comments = _numbered(df.select(c.alias("c")).filter(F.col("c").isNotNull()).distinct())
    words = long_form(keywords, trim_words).filter(F.col("list").isin(*LISTS))
    filled = {r["list"] for r in words.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    # NULL comments have keys of their own, spread over the tasks, and meet nothing.
    apart = F.when(c.isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)) + 1).otherwise(0)
    # The comment itself goes through the join, trimmed or not, and no second copy of it.
    out = df.withColumn("_apart", apart)
    for mode in sorted(set(modes.values())):
        of = [x for x, m in modes.items() if m == mode]
        flags = _flags(comments, words.filter(F.col("list").isin(*of)), mode, of)
        flags = flags.withColumnRenamed("c", "_c").withColumn("_none", F.lit(0).cast("long"))
        out = out.join(flags.hint("merge"), (c == F.col("_c")) & (F.col("_apart") == F.col("_none")), "left").drop(
            "_c", "_none")

    def flag(x: str) -> Column:
        # A list without words matches nothing; a comment without a row has the common flag.
        common = c.isNotNull() if modes[x] == "not_any" and x in filled else F.lit(False)
        return F.coalesce(F.col(f"hit_{x}"), common).alias(f"hit_{x}")

    return out.select(*df.columns, *[flag(x) for x in modes])


def tag_folded(df: DataFrame, keywords: DataFrame, modes: dict[str, str], comment: str = "Comment",
               trim_comment: bool = False, trim_words: bool = False) -> DataFrame:
    """``tag`` without regard to case and look-alike letters: both sides are folded, then matched as ever.

    Brand names that mix Latin and Cyrillic letters match comments in either spelling. LIKE modes
    only: folding would change what the letters of an expression mean.
    """
    if "regex" in modes.values():
        raise ValueError("regular expressions are not folded")
    columns = list_columns(keywords)
    words = keywords.select(*[folded(columns[x]).alias(x) for x in LISTS])
    out = tag(df.withColumn("_folded", folded(comment)), words, modes, "_folded", trim_comment, trim_words)
    return out.drop("_folded")


def _pairs(comments: DataFrame, words: DataFrame, mode: str) -> DataFrame:
    """The columns of ``comments`` (i, c, ..) but c, and list, word: one row for each comment and word that occurs in it."""
    _like_or_regex(mode)
    words = _known_words(words, mode)
    pairs = _anchor_pairs(comments, words, mode)
    if mode == "regex":  # one word may have been found by several literals
        pairs = pairs.distinct()
    more = _bare_pairs(comments, _bare(words), mode, True)
    return pairs if more is None else pairs.unionByName(more)


def match_pairs(comments: DataFrame, words: DataFrame, mode: str) -> DataFrame:
    """``c, list, word``: one row for each comment and word that occurs in it.

    ``comments`` has one column ``c`` of distinct texts, ``words`` (list, word).
    """
    comments = _numbered(comments)
    return _pairs(comments, words, mode).join(comments.hint("merge"), "i").select("c", "list", "word")


def _counted(df: DataFrame, comment: str, trim_comment: bool) -> DataFrame:
    """c, n, i: the distinct comments, their rows and numbers, stored."""
    c = F.trim(F.col(comment)) if trim_comment else F.col(comment)
    return _numbered(df.select(c.alias("c")).filter(F.col("c").isNotNull()).groupBy("c").agg(
        F.count(F.lit(1)).alias("n")))


def _like_or_regex(mode: str) -> None:
    if mode not in ("regex", "token", "contains"):
        raise ValueError(f"keyword mode {mode!r} has no matching words")


def _direct_rows(df: DataFrame, words: list, mode: str, c: Column) -> DataFrame:
    """``df`` with ``list`` and ``word``, every word an expression of its own."""
    _like_or_regex(mode)
    named = [F.struct(F.lit(r["list"]).alias("list"), F.lit(r["word"]).alias("word")) for r in words]
    hits = F.array(*[F.when(matches(c, [r["word"]], mode), x) for r, x in zip(words, named, strict=True)])
    if not words:
        hits = F.array().cast("array<struct<list: string, word: string>>")
    return df.select("*", F.explode(F.array_compact(hits)).alias("_hit")).select(*df.columns, "_hit.list", "_hit.word")


def match_rows(df: DataFrame, keywords: DataFrame, mode: str, comment: str = "Comment",
               trim_comment: bool = False, trim_words: bool = False) -> DataFrame:
    """The theta join as rows: ``df`` with ``list`` and ``word``, one row per operation and matching word (JN10).

    Up to ``DIRECT`` words are tested on the rows as they are read, without a join. Beyond that, a
    hot comment, one of more than N / HOT rows (fewer than HOT of them), meets its words in SALTS parts.
    """
    some = long_form(keywords, trim_words).distinct().limit(DIRECT + 1).collect()
    if len(some) <= DIRECT:
        return _direct_rows(df, some, mode, F.trim(F.col(comment)) if trim_comment else F.col(comment))
    counted = _counted(df, comment, trim_comment)
    pairs = _pairs(counted.select("i", "c"), long_form(keywords, trim_words), mode).join(
        counted.select("i", "c").hint("merge"), "i")
    total = counted.agg(F.sum("n")).first()[0] or 0
    hot = stored(counted.where(F.col("n") * HOT > F.lit(total)).select(F.col("c").alias("_hot")), "keyword-hot")
    salts = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    pairs = pairs.join(F.broadcast(hot), F.col("c") == F.col("_hot"), "left").select(
        F.col("c").alias("_c"), "list", "word", F.explode(salts).alias("_salt"))
    c = F.trim(F.col(comment)) if trim_comment else F.col(comment)
    salt = F.when(F.col("_hot").isNotNull(), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    rows = df.withColumn("_c", c).filter(F.col("_c").isNotNull()).join(
        F.broadcast(hot), F.col("_c") == F.col("_hot"), "left").withColumn("_salt", F.coalesce(salt, F.lit(0)))
    return rows.join(pairs.hint("merge"), ["_c", "_salt"]).select(*df.columns, "list", "word")


def match_counts(df: DataFrame, keywords: DataFrame, mode: str, comment: str = "Comment",
                 trim_comment: bool = False, trim_words: bool = False) -> DataFrame:
    """``list, word, operations, comments``: how many rows and distinct comments each word occurs in.

    Words that occur nowhere have zeros. Rows are counted per comment first, so a hot comment is one row.
    """
    counted = _counted(df, comment, trim_comment)
    words = long_form(keywords, trim_words).distinct()
    found = _pairs(counted, words, mode).groupBy("list", "word").agg(
        F.sum("n").alias("operations"), F.count(F.lit(1)).alias("comments"))
    return words.join(found.hint("merge"), ["list", "word"], "left").select(
        "list", "word", F.coalesce("operations", F.lit(0)).alias("operations"),
        F.coalesce("comments", F.lit(0)).alias("comments"))

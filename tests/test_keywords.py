"""Keyword matching modes, compiled and joined."""

import re

import pytest
import regex
from conftest import SF001
from hypothesis import HealthCheck, Phase, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom import fixtures
from ledgerloom.functions.regex_literals import required
from ledgerloom.functions.text import KeywordError, matches
from ledgerloom.operators import keyword_join
from ledgerloom.operators.keyword_join import tag

COMMENTS = ["оплата за small ring, договор 1", "оплата за ringo, договор 2", "rod", None, "a%b_c"]


@pytest.fixture(scope="module")
def comments(spark):
    return spark.createDataFrame([(c,) for c in COMMENTS], "c string")


def _eval(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_modes(comments):
    assert _eval(comments, matches("c", ["ring"], "regex")) == [True, True, False, None, False]
    assert _eval(comments, matches("c", ["ring"], "token")) == [True, False, False, None, False]
    assert _eval(comments, matches("c", ["ring"], "contains")) == [True, True, False, None, False]
    assert _eval(comments, matches("c", ["ring", "rod"], "not_any")) == [True, True, True, None, True]


def test_stray_backslash_is_itself(comments, spark):
    df = spark.createDataFrame([("a\\b",), ("a%",), ("ab",), ("a\\%",)], "c string")
    assert _eval(df, matches("c", ["a\\b"], "contains")) == [True, False, False, False]
    assert _eval(df, matches("c", ["a\\%"], "contains")) == [False, True, False, False]
    assert _eval(df, matches("c", ["a\\\\%"], "contains")) == [True, False, False, True]


def test_not_any_of_many_words(comments):
    words = [f"w{i}" for i in range(2000)]
    assert _eval(comments, matches("c", words, "not_any")) == [True, True, True, None, True]


def test_unknown_mode_rejected():
    with pytest.raises(ValueError):
        matches(F.col("c"), ["x"], "fuzzy")


TEXTS = ["оплата за small ring, договор 1", "x  ring,y", "ring,", " ring,", "a b c, d", "", " ",
         "купил автомобиль , 2", "a,b c,d e,", None, "ring", "за  ring,", "a%b_c", "a\\b", " a.b, x"]
WORDS = ["ring", "b c", "автомобиль ", "", "small ring", "a%b", "c, d", "_", "__", "%", "a\\b", "r_ng", "a\\%b",
         "\\", "нет такого слова", " ring ", "a.b"]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck),
          phases=[Phase.explicit, Phase.generate])
@given(first=st.lists(st.one_of(st.sampled_from(WORDS), st.none()), max_size=9),
       second=st.lists(st.sampled_from(WORDS), max_size=4), trim=st.booleans())
@example(first=WORDS, second=["ring"], trim=False)
@example(first=["ring"], second=[], trim=True)
def test_one_answer_at_every_dictionary_size(spark, first, second, trim):
    """Every mode, compiled and joined, with lower-case column names."""
    n = max(len(first), len(second), 1)
    cells = list(zip(first + [None] * (n - len(first)), second + [None] * (n - len(second)), strict=True))
    kw = spark.createDataFrame(cells, "list_1 string, LIST_2 string").coalesce(1)
    df = spark.createDataFrame([(c,) for c in TEXTS], "Comment string").coalesce(1)
    for mode in ("token", "contains", "not_any", "regex"):
        words = kw
        if mode == "regex":  # a backslash at the end is no regular expression: see test_invalid_expressions
            ends = [F.coalesce(F.substring(F.col(c), -1, 1), F.lit("")) for c in ("list_1", "LIST_2")]
            words = kw.filter((ends[0] != "\\") & (ends[1] != "\\"))
        modes = {"List_1": mode, "List_2": mode}
        got = []
        for limit in (0, 10_000):
            with pytest.MonkeyPatch.context() as mp:
                mp.setattr(keyword_join, "COMPILE_MAX", limit)
                out = tag(df, words, modes, trim_comment=trim, trim_words=trim)
                got.append(sorted((tuple(r) for r in out.collect()), key=str))
        assert got[0] == got[1], mode


def test_missing_list_column_raises(spark):
    with pytest.raises(ValueError, match="List_2"):
        tag(spark.createDataFrame([("a",)], "Comment string"), spark.createDataFrame([("x",)], "List_1 string"),
            {"List_1": "token", "List_2": "token"})


def test_distributed_dictionary_in_marts(sf001_tables, monkeypatch):
    from ledgerloom.operators import payments_mart

    for dialect in ("frame", "sql", "sql_v1"):
        a = payments_mart(sf001_tables, dialect)
        with monkeypatch.context() as mp:
            mp.setattr(keyword_join, "COMPILE_MAX", 0)
            b = payments_mart(sf001_tables, dialect)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, dialect


EXPRESSIONS = ["(?i)q", "ring", "a(.)\\1", "(r)(i)\\2", "\\Qa.b", "^$", "x{0}", "(?:small|red) r[io]ng", "\\bring\\b", "[^a-zа-я ,]",
               "(?x) r i n g  # all of it", "за +(?=small)", "", "a|b|", "(?<n>r)ing", "(?<n>r)ad", "q+u", "\\d$", "\\p{Lu}"]


@pytest.mark.parametrize("block", [3, 256])
def test_expressions_keep_to_themselves(spark, monkeypatch, block):
    """Flags, group numbers and quotes of one word change nothing for another, at both sizes."""
    texts = [*TEXTS, "RING", "Quiz", "quu", "abb", "rii", "a.b", "red rong", "ring1", "rad"]
    df = spark.createDataFrame([(c,) for c in texts], "Comment string").coalesce(1)
    kw = spark.createDataFrame([(w, None) for w in EXPRESSIONS[:3]] + [(None, w) for w in EXPRESSIONS], "List_1 string, List_2 string")
    each = {w: {r[0]: r[1] for r in df.select("Comment", F.col("Comment").rlike(w)).collect()} for w in EXPRESSIONS}
    want = sorted((str(t), any(each[w][t] or False for w in EXPRESSIONS[:3]), any(each[w][t] or False for w in EXPRESSIONS))
                  for t in texts)
    monkeypatch.setattr(keyword_join, "BLOCK", block)
    for limit in (0, 10_000):
        monkeypatch.setattr(keyword_join, "COMPILE_MAX", limit)
        got = tag(df, kw, {"List_1": "regex", "List_2": "regex"}).collect()
        assert sorted((str(r[0]), r[1], r[2]) for r in got) == want, limit
    rows = keyword_join.match_rows(df, kw.select(F.lit(None).cast("string").alias("List_1"), "List_2"), "regex")
    assert sorted(tuple(r) for r in rows.collect()) == sorted(
        (t, "List_2", w) for t in texts if t is not None for w in EXPRESSIONS if each[w][t])


@pytest.mark.parametrize("words", [["a(", "b)"], ["ring", "\\"], ["*"], ["[a"]])
@pytest.mark.parametrize("limit", [0, 10_000])
def test_invalid_expressions(spark, monkeypatch, words, limit):
    """A word that is no expression on its own raises alike at both sizes, also where the join of all is one."""
    kw = spark.createDataFrame([(w, None) for w in words], "List_1 string, List_2 string")
    df = spark.createDataFrame([("ring",)], "Comment string")
    monkeypatch.setattr(keyword_join, "COMPILE_MAX", limit)
    with pytest.raises(KeywordError):
        tag(df, kw, {"List_1": "regex", "List_2": "regex"}).collect()


def test_required_literals():
    for fragment, want in [
            ("ring", [["ring"]]), ("(за|для) small,", [[" small,"], ["для", "за"]]), ("foo(bar|baz)?", [["foo"]]),
            ("x+abc{2,3}d", [["xabcc"], ["ccd"], ["x"]]), ("(?i)q", []), ("(?i:ab)cd", [["cd"]]), ("ab|", []),
            ("\\Qa.b\\E+c", [["a.b"], ["bc"]]), ("(?:abc|de)f?", [["abc", "de"]]), ("^a\\.b$", [["a.b"]]), ("[ab]c", [["c"]]),
            ("(ab){2}", [["abab"]]), ("a{0}bc", [["bc"]]), ("(?=abc)de", [["de"]]), ("\\x41bc", []), ("(a", []),
            ("(" * 5000 + "a" + ")" * 5000, [])]:
        assert required(fragment) == want, fragment


PIECES = ["a", "b", "ab", "(a|b)", "(?:ab)?", "c*", "c+", "[ab]", ".", "a{2}", "b{1,2}", "\\w", "^", "$", "(a(b|c))", "(?=b)", "|", "\\."]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=6), st.lists(st.text(alphabet="abc.", max_size=7), max_size=20))
def test_required_literals_are_in_every_match(pieces, texts):
    fragment = "".join(pieces)
    try:
        compiled = re.compile(fragment)
    except re.error:
        return
    needs = required(fragment)
    for t in texts:
        if compiled.search(t):
            assert all(any(x in t for x in some) for some in needs), (fragment, needs, t)


@pytest.mark.parametrize("mode", ["contains", "token", "regex"])
def test_match_rows(spark, monkeypatch, mode):
    """One row per operation and word, with a comment that a third of the rows share."""
    monkeypatch.setattr(keyword_join, "HOT", 10)
    texts = TEXTS * 3 + ["за small ring, x"] * 40 + [None] * 30
    words = ["ring", "small ring", "r_ng", "%", "а", "ring", "нет", " ", "b c"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(texts)], "id long, Comment string").repartition(4)
    kw = spark.createDataFrame([(w, None) for w in words] + [(None, "ring")], "List_1 string, List_2 string")

    def hit(w, t):
        if mode == "regex":
            return re.search(w, t) is not None
        like = "".join({"%": ".*", "_": "."}.get(x, re.escape(x)) for x in w)
        return re.fullmatch(f".* {like},.*" if mode == "token" else f".*{like}.*", t, re.S) is not None

    want = sorted((i, t, x, w) for i, t in enumerate(texts) if t is not None
                  for x, w in [*(("List_1", w) for w in set(words)), ("List_2", "ring")] if hit(w, t))
    got = keyword_join.match_rows(df, kw, mode)
    assert sorted(tuple(r) for r in got.collect()) == want
    counts = {(r["list"], r["word"]): (r["operations"], r["comments"])
              for r in keyword_join.match_counts(df, kw, mode).collect()}
    for x, w in counts:
        mine = [t for _, t, y, v in want if (y, v) == (x, w)]
        assert counts[x, w] == (len(mine), len(set(mine)))
    assert len(counts) == len(set(words)) + 1


def test_large_regex_dictionary_against_brute_force(spark, sf001_tables):
    """The registered large dictionaries, every operation of the smallest table against every expression."""
    kw = fixtures.large_patterns(spark, SF001)
    ops = sf001_tables.operations.select("Comment")
    got = {r[0]: (r[1], r[2]) for r in tag(ops, kw, {"List_1": "regex", "List_2": "regex"}, trim_comment=True,
                                           trim_words=True).distinct().collect()}
    lists = {x: "|".join(f"(?:{r[0]})" for r in kw.select(x).distinct().collect() if r[0] is not None)
             for x in ("List_1", "List_2")}
    both = [regex.compile(lists[x].replace("(?iu:", "(?i:")) for x in ("List_1", "List_2")]
    for text, flags in list(got.items())[::7]:
        assert flags == tuple(p.search(text) is not None for p in both), text


def test_no_pairwise_join_in_large_plans(spark):
    from ledgerloom.queries import QUERIES

    for name in ("kw_regex_large", "kw_matches", "kw_match_rows"):
        plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


@pytest.mark.parametrize("limit", [0, 10_000])
def test_folded(spark, monkeypatch, limit):
    """Latin and Cyrillic look-alikes and capitals meet; NULL comments and empty lists as ever."""
    monkeypatch.setattr(keyword_join, "COMPILE_MAX", limit)
    texts = ["купил FORD", "купил fоrd", "вмw x5", "BMW X5", "ford", None, "лада", ""]
    df = spark.createDataFrame([(t,) for t in texts], "Comment string")
    kw = spark.createDataFrame([("фord", None), ("fоrd", None), ("бмв", None), ("вмw", None)], "list_1 string, LIST_2 string")
    got = {r[0]: (r[1], r[2]) for r in keyword_join.tag_folded(df, kw, {"List_1": "contains", "List_2": "token"}).collect()}
    assert {t for t, (a, _) in got.items() if a} == {"купил FORD", "купил fоrd", "вмw x5", "BMW X5", "ford"}
    assert not any(b for _, b in got.values())
    with pytest.raises(ValueError, match="not folded"):
        keyword_join.tag_folded(df, kw, {"List_1": "regex"})


def test_growing_frames_are_not_broadcast(spark, monkeypatch):
    """Files hide the size of their rows: only the bounded beginnings of literals are broadcast, whatever the threshold."""
    monkeypatch.setattr(keyword_join, "COMPILE_MAX", 0)
    df = spark.createDataFrame([(t,) for t in TEXTS], "Comment string")
    kw = spark.createDataFrame([("ring", "small ring"), ("b c", "a%b")], "List_1 string, List_2 string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        for out in (tag(df, kw, {"List_1": "contains", "List_2": "not_any"}),
                    keyword_join.match_counts(df, kw, "contains"), fixtures.operations(spark, SF001)):
            joins = [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "BroadcastHashJoin" in x]
            assert all("start#" in x or "head#" in x for x in joins), joins
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pieces_come_once_and_only_where_a_word_may_start(spark):
    """Words that share all but their end meet a comment only where they occur in it."""
    words = spark.range(3000).selectExpr("concat('договор ', id) AS literal")
    comments = spark.createDataFrame([(0, "договор 12, договор 12"), (1, "нет"), (2, ""), (3, "договор 7")], "i long, c string")
    got = sorted(tuple(r) for r in keyword_join._pieces(comments, words).join(words, F.col("piece") == F.col("literal")).select(
        "i", "piece").collect())
    assert got == [(0, "договор 1"), (0, "договор 12"), (3, "договор 7")]


@pytest.mark.parametrize("mode", ["contains", "token", "regex"])
def test_match_rows_of_few_words_need_no_join(spark, monkeypatch, mode):
    """The same rows with and without the join; copies, NULL comments, repeated and empty words, an empty dictionary."""
    monkeypatch.setattr(keyword_join, "HOT", 10)
    df = spark.createDataFrame([(i % 5, c) for i, c in enumerate(TEXTS * 2 + [" ring,x "] * 40 + [None] * 3)], "id long, Comment string")
    kw = spark.createDataFrame([("ring", "ring"), ("", None), ("ring", "b c"), (" ", "a.b")], "List_1 string, List_2 string")
    for words in (kw, kw.limit(0)):
        got = []
        for most in (-1, 256):
            monkeypatch.setattr(keyword_join, "DIRECT", most)
            out = keyword_join.match_rows(df, words, mode, trim_comment=True, trim_words=True)
            got.append(sorted((tuple(r) for r in out.collect()), key=str))
        assert got[0] == got[1]
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan


def test_final_literal():
    from ledgerloom.functions.regex_literals import final

    known = {"договор 333$": "договор 333", "r[io]d, (?:a|б) 12$": " 12", "ab+$": "b", "(ab)$": "ab", "a$$": "a"}
    assert {x: final(x) for x in known} == known
    none = ["a$|b", "a|b$", "(a$)", "(?m)a$", "(?m:a)b$", "ab*$", "a$?", r"a\$", "[$]", "a$b", "$", "ab", "(", "(?:a|b)$"]
    assert [final(x) for x in none] == [None] * len(none)


def test_final_literal_is_sought_at_the_end_alone(spark):
    """Of a comment with a number at its end one piece is tried, not one for each length of a number."""
    words = spark.createDataFrame([("List_1", f"договор {n}$") for n in (1, 12, 123, 1234)], "list string, word string")
    words = keyword_join._known_words(words, "regex")
    chosen = keyword_join._chosen(words, "regex").select("literal", "final")
    comments = spark.createDataFrame([(0, "договор 1234"), (1, "договор 12 и договор 1\r\n")], "i long, c string")
    found = sorted((r.i, r.piece) for r in keyword_join._pieces(comments, chosen).collect() if r.piece.endswith(
        ("1", "12", "123", "1234")))
    assert found == [(0, "договор 1234"), (1, "договор 1")]


def test_final_literals_find_what_the_expression_finds(spark, monkeypatch):
    texts = ["a 12", "a 12\n", "a 12\r\n", "a 12 ", "a 12 12", "12", "a 12x", "a 12\n\n", "a 1", "12 a 12", "", None, "x 12\r"]
    words = ["12$", " 12$", "a 1$", "a .* 12$", "a 12", "(?m)12$", "12\\n$", "x (?:1|2)2$", "2+$", "(12|13)$"]
    df = spark.createDataFrame([(t, n) for t in texts for n in range(2)], "Comment string, n int")
    dictionary = spark.createDataFrame([(w, words[-1 - k]) for k, w in enumerate(words)], "List_1 string, List_2 string")
    got = []
    for most in (256, -1):
        monkeypatch.setattr(keyword_join, "DIRECT", most)
        got.append(sorted((tuple(r) for r in keyword_join.match_rows(df, dictionary, "regex").collect()), key=str))
    assert got[0] == got[1]


@pytest.mark.parametrize("mode", ["token", "contains", "regex"])
def test_stored_words_are_the_words(spark, mode):
    """What is not stored again is made again: bodies and literals are those of the words as read."""
    rows = [("List_1", w) for w in WORDS if mode != "regex" or w not in ("\\",)]
    words = spark.createDataFrame(rows, "list string, word string")
    made, kept = keyword_join._literals(words, mode), keyword_join._known_words(words, mode)
    key = lambda r: (r.word, str(r))
    assert sorted(made.collect(), key=key) == sorted(kept.collect(), key=key)
    stored_rows = spark.read.parquet(kept.inputFiles()[0].rsplit("/", 1)[0])
    assert stored_rows.where("word = 'small ring' AND body IS NULL AND literals IS NULL").count() == 1


@pytest.mark.parametrize("trim", [False, True])
def test_a_comment_goes_through_the_join_once(spark, monkeypatch, trim):
    """The rows are dealt out by the (trimmed) comment without a second copy of it."""
    monkeypatch.setattr(keyword_join, "COMPILE_MAX", 0)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "n int, Comment string")
    out = tag(df, spark.createDataFrame([("ring", "b c")], "List_1 string, List_2 string"),
              {"List_1": "contains", "List_2": "not_any"}, trim_comment=trim)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Comment#\d+ AS _c#|trim\(Comment#\d+, None\) AS _c#", plan)
    assert {(r.n, r.hit_List_1, r.hit_List_2) for r in out.collect()} == {
        (i, t is not None and "ring" in t, t is not None and "b c" not in t) for i, t in enumerate(TEXTS)}

"""Keyword matching of payment comments (FLT3-FLT6, CM9).

Four modes, one per way the marts sort comments:

* ``regex``    - ``comment RLIKE w`` for some word: words are regular
                 expressions of their own, unanchored (DataFrame dialect).
* ``token``    - ``comment LIKE '% w,%'`` for some word: a blank before the
                 word and a comma right after it (SQL dialect).
* ``contains`` - ``comment LIKE '%w%'`` for some word (first SQL query).
* ``not_any``  - ``comment NOT LIKE '%w%'`` for *some* word, i.e. at least one
                 word is absent (first SQL query, vehicles list).

Words of the LIKE modes are patterns: ``%`` and ``_`` are wildcards, a
backslash escapes those two and itself, and is itself before anything else.
``matches`` compiles a word list into one JVM expression; dictionaries too
large for that go through ``operators.keyword_join`` with the same answers.
A regular expression keeps to itself: its flags, group numbers and quotes do not
reach its neighbours, and one that is invalid on its own raises.
An empty dictionary matches nothing. NULL comments give NULL; callers decide
with ``coalesce`` (D12).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

MODES = ("regex", "token", "contains", "not_any")


def like_body(word: str) -> str:
    """The word as a valid LIKE pattern: a stray backslash is doubled."""
    return re.sub(r"\\([%_\\])|\\", lambda m: m.group(0) if m.group(1) else "\\\\", word)


def _balanced(terms: list[Column], join: Callable[[Column, Column], Column]) -> Column:
    """Terms joined as a balanced tree: depth grows with the logarithm of their number."""
    while len(terms) > 1:
        terms = [join(*terms[i:i + 2]) if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]


class KeywordError(ValueError):
    """A word of a regex dictionary that is no regular expression."""

    def __init__(self):
        super().__init__("a word of the keyword dictionary is not a regular expression")


# References, names, quotes and comment mode reach beyond a fragment that is joined with others.
_ALONE = re.compile(r"\\[1-9kQ]|\(\?(<[A-Za-z]|[a-zA-Z-]*x)")


def _compiled(c: Column, words: Sequence[str]) -> Column:
    """Does some expression match? Those that can be are one alternation of groups."""
    jvm = SparkContext._active_spark_context._jvm
    for w in words:
        try:
            jvm.java.util.regex.Pattern.compile(w)
        except Exception as e:
            raise KeywordError from e
    alone = [w for w in words if _ALONE.search(w)]
    joined = [f"(?:{w})" for w in words if not _ALONE.search(w)]
    return _balanced([c.rlike(w) for w in (["|".join(joined)] if joined else []) + alone], Column.__or__)


def matches(comment: Column | str, words: Sequence[str], mode: str,
            trim_comment: bool = False) -> Column:
    """Boolean (nullable) column: does ``comment`` match the dictionary?"""
    if mode not in MODES:
        raise ValueError(f"unknown keyword mode {mode!r}; expected one of {MODES}")
    c = F.col(comment) if isinstance(comment, str) else comment
    if trim_comment:
        c = F.trim(c)
    words = sorted({w for w in words if w is not None})
    if not words:
        # D13: an empty list matches nothing (NULL comments stay NULL).
        return F.when(c.isNull(), F.lit(None).cast("boolean")).otherwise(F.lit(False))
    if mode == "regex":
        return _compiled(c, words)
    if mode == "token":
        return _balanced([c.like(f"% {like_body(w)},%") for w in words], Column.__or__)
    present = [c.like(f"%{like_body(w)}%") for w in words]
    if mode == "contains":
        return _balanced(present, Column.__or__)
    return ~_balanced(present, Column.__and__)


# Latin small letters and the Cyrillic ones that look like them, in small or capital form.
LOOK_ALIKE = ("abcehkmoptuxyi", "авсенкмортихуі")


def folded(c: Column | str) -> Column:
    """A text without case, its Latin letters replaced by the Cyrillic ones that look alike (D11, D26)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.translate(F.lower(c), *LOOK_ALIKE)

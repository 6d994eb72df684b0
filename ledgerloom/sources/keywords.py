"""Keyword dictionary (SRC8).

The dictionary file has independent columns (``List_1`` vehicles,
``List_2`` food) padded with empty cells; column names are matched without
regard to case. ``long_form`` turns it into (list, word) rows;
``load_lists_upto`` brings a small dictionary to the driver and leaves a large
one distributed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LISTS = ("List_1", "List_2")


def list_columns(keywords: DataFrame, required: tuple[str, ...] = LISTS) -> dict[str, str]:
    """Canonical list name → the frame's column; raises when one is absent."""
    found = {}
    for c in keywords.columns:
        if c.lower().startswith("list_"):
            found["List_" + c[len("list_"):]] = c
    missing = [x for x in required if x not in found]
    if missing:
        raise ValueError(f"keyword dictionary has no column {', '.join(missing)}; it has {keywords.columns}")
    return found


def java_trim(c: Column) -> Column:
    """``String.trim``: leading and trailing characters up to U+0020 removed."""
    return F.regexp_replace(c, "^[\\x00-\\x20]+|[\\x00-\\x20]+$", "")


def long_form(keywords: DataFrame, trim: bool = False) -> DataFrame:
    """(list, word) rows for every non-NULL cell of every ``List_*`` column.

    ``trim`` strips the words the way the DataFrame dialect does; the SQL
    dialects use them as written (D9).
    """
    cells = F.array(*[F.struct(F.lit(name).alias("list"), F.col(c).alias("word"))
                      for name, c in list_columns(keywords, ()).items()])
    stacked = keywords.select(F.explode(cells).alias("kw")).select("kw.list", "kw.word")
    word = java_trim(F.col("word")) if trim else F.col("word")
    return stacked.filter(F.col("word").isNotNull()).select("list", word.alias("word"))


def load_lists_upto(keywords: DataFrame, total: int, trim: bool = False) -> dict[str, list[str]] | None:
    """Every list's distinct words when there are at most ``total`` of them, else None."""
    names = list_columns(keywords)
    rows = long_form(keywords, trim).distinct().limit(total + 1).collect()
    if len(rows) > total:
        return None
    return {n: sorted(r["word"] for r in rows if r["list"] == n) for n in names}

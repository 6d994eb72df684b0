"""The three ways the marts are defined.

``frame``  - the DataFrame program: newest rate per currency, orphans kept,
             regex keywords on trimmed comment and trimmed words.
``sql``    - the SQL program: rates of the newest global date, orphans
             dropped, ``LIKE '% w,%'`` keywords, words as written.
``sql_v1`` - the first SQL query: as ``sql`` for rates and kernel, amounts
             rounded after summing, distinct (amount, converted) sums,
             ``NOT LIKE`` some word for vehicles, ``LIKE '%w%'`` for food,
             own-account tax/clearing tests, NULL for missing measures.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Dialect:
    name: str
    rate_policy: str
    keep_orphans: bool
    cars_mode: str
    food_mode: str
    trim_words: bool
    trim_comment: bool


FRAME = Dialect("frame", "latest_per_currency", True, "regex", "regex", True, True)
SQL = Dialect("sql", "latest_global", False, "token", "token", False, False)
SQL_V1 = Dialect("sql_v1", "latest_global", False, "not_any", "contains", False, False)

DIALECTS = {d.name: d for d in (FRAME, SQL, SQL_V1)}


def get_dialect(d: str | Dialect) -> Dialect:
    if isinstance(d, Dialect):
        return d
    try:
        return DIALECTS[d]
    except KeyError:
        raise ValueError(f"unknown dialect {d!r}; expected one of {sorted(DIALECTS)}") from None

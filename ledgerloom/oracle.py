"""DuckDB oracle text for every registered query.

Independent, straightforward SQL (kernel + measures + left joins, the
reference's shape) over the same fixture mapping, written for DuckDB:
``regexp_matches`` for RLIKE, ``//`` for integer division, 1-based
``substring``. Every measure is cast to DECIMAL(38,2) as in Spark.
"""

from __future__ import annotations

from .fixtures import ORACLE_PRELUDE

# Shared CTEs appended to the fixture prelude.
_COMMON = """
, rate_pc AS (
  SELECT r.Currency, r.Rate FROM rates r
  JOIN (SELECT Currency, max(RateDate) AS RateDate FROM rates
        WHERE RateDate IS NOT NULL GROUP BY Currency) m
    ON r.Currency = m.Currency AND r.RateDate = m.RateDate
), rate_gl AS (
  SELECT Currency, Rate FROM rates WHERE RateDate = (SELECT max(RateDate) FROM rates)
), conv AS (
  SELECT o.AccountDB, o.AccountCR, o.DateOp,
         round(TRY_CAST(replace(o.Amount, ',', '.') AS DECIMAL(10,2))
             * TRY_CAST(replace(r.Rate, ',', '.') AS DECIMAL(10,2)), 2) AS Amount,
         o.Comment
  FROM operations o JOIN rate_pc r ON o.Currency = r.Currency
), conv_sql AS (
  SELECT o.AccountDB, o.AccountCR, o.DateOp,
         round(TRY_CAST(replace(o.Amount, ',', '.') AS DECIMAL(10,2))
             * TRY_CAST(replace(r.Rate, ',', '.') AS DECIMAL(10,2)), 2) AS Amount,
         o.Comment
  FROM operations o JOIN rate_gl r ON o.Currency = r.Currency
), v1ops AS (
  SELECT o.AccountDB, o.AccountCR, o.DateOp, o.Amount, o.Comment,
         TRY_CAST(replace(o.Amount, ',', '.') AS DECIMAL(10,2))
           * TRY_CAST(replace(r.Rate, ',', '.') AS DECIMAL(10,2)) AS res
  FROM operations o JOIN rate_gl r ON o.Currency = r.Currency
), ids AS (
  SELECT AccountDB AS AccountId, DateOp AS CutoffDt FROM operations
  UNION
  SELECT AccountCR AS AccountId, DateOp AS CutoffDt FROM operations
), kernel AS (
  SELECT i.AccountId, a.ClientId, i.CutoffDt FROM ids i LEFT JOIN accounts a ON i.AccountId = a.AccountId
), kernel_sql AS (
  SELECT i.AccountId, a.ClientId, i.CutoffDt FROM ids i JOIN accounts a ON i.AccountId = a.AccountId
)
"""


def _hit(list_col: str, mode: str, comment: str = "c.Comment", words: str = "keywords") -> str:
    """EXISTS test of one comment against one keyword column."""
    if mode == "regex":
        cond = f"regexp_matches(trim({comment}), trim(k.{list_col}))"
    elif mode == "token":
        cond = f"{comment} LIKE '% ' || k.{list_col} || ',%'"
    elif mode == "contains":
        cond = f"{comment} LIKE '%' || k.{list_col} || '%'"
    elif mode == "not_any":
        cond = f"NOT ({comment} LIKE '%' || k.{list_col} || '%')"
    else:
        raise ValueError(mode)
    return f"EXISTS (SELECT 1 FROM {words} k WHERE k.{list_col} IS NOT NULL AND {cond})"


def _measures(conv: str, mode: str) -> str:
    """Seven measure CTEs over a converted-operations CTE."""
    return f"""
, m_pay AS (
  SELECT AccountDB AS AccountId, DateOp AS CutoffDt, sum(Amount) AS v FROM {conv}
  WHERE AccountDB IS NOT NULL AND DateOp IS NOT NULL GROUP BY 1, 2
), m_enr AS (
  SELECT AccountCR AS AccountId, DateOp AS CutoffDt, sum(Amount) AS v FROM {conv}
  WHERE AccountCR IS NOT NULL AND DateOp IS NOT NULL GROUP BY 1, 2
), m_tax AS (
  SELECT c.AccountDB AS AccountId, c.DateOp AS CutoffDt, sum(c.Amount) AS v
  FROM {conv} c JOIN accounts a ON c.AccountCR = a.AccountId
  WHERE substring(a.AccountNum, 1, 5) = '40702' AND c.DateOp IS NOT NULL GROUP BY 1, 2
), m_clr AS (
  SELECT c.AccountCR AS AccountId, c.DateOp AS CutoffDt, sum(c.Amount) AS v
  FROM {conv} c JOIN accounts a ON c.AccountDB = a.AccountId
  WHERE substring(a.AccountNum, 1, 5) = '40802' AND c.DateOp IS NOT NULL GROUP BY 1, 2
), m_cars AS (
  SELECT AccountDB AS AccountId, DateOp AS CutoffDt, sum(Amount) AS v
  FROM (SELECT DISTINCT * FROM {conv} c WHERE NOT {_hit('List_1', mode)}) x
  WHERE AccountDB IS NOT NULL AND DateOp IS NOT NULL GROUP BY 1, 2
), m_food AS (
  SELECT AccountCR AS AccountId, DateOp AS CutoffDt, sum(Amount) AS v
  FROM (SELECT DISTINCT AccountDB, AccountCR, DateOp, Amount FROM {conv} c
        WHERE {_hit('List_2', mode)}) x
  WHERE AccountCR IS NOT NULL AND DateOp IS NOT NULL GROUP BY 1, 2
), m_fl AS (
  SELECT c.AccountDB AS AccountId, c.DateOp AS CutoffDt, sum(c.Amount) AS v
  FROM {conv} c JOIN accounts a ON c.AccountCR = a.AccountId
                JOIN clients cl ON a.ClientId = cl.ClientId
  WHERE cl.Type = 'Ф' AND c.AccountDB IS NOT NULL AND c.DateOp IS NOT NULL GROUP BY 1, 2
)
"""


_V1_MEASURES = f"""
, v_pay AS (
  SELECT AccountDB AS AccountId, DateOp AS CutoffDt, round(sum(res), 2) AS v FROM v1ops GROUP BY 1, 2
), v_enr AS (
  SELECT AccountCR AS AccountId, DateOp AS CutoffDt, round(sum(res), 2) AS v FROM v1ops GROUP BY 1, 2
), v_tax AS (
  SELECT c.AccountDB AS AccountId, c.DateOp AS CutoffDt, round(sum(c.res), 2) AS v
  FROM v1ops c JOIN accounts a ON c.AccountDB = a.AccountId
  WHERE substring(a.AccountNum, 1, 5) = '40702' GROUP BY 1, 2
), v_clr AS (
  SELECT c.AccountCR AS AccountId, c.DateOp AS CutoffDt, round(sum(c.res), 2) AS v
  FROM v1ops c JOIN accounts a ON c.AccountCR = a.AccountId
  WHERE substring(a.AccountNum, 1, 5) = '40802' GROUP BY 1, 2
), v_cars AS (
  SELECT AccountDB AS AccountId, DateOp AS CutoffDt, round(sum(res), 2) AS v
  FROM (SELECT DISTINCT AccountDB, DateOp, Amount, res FROM v1ops c WHERE {_hit('List_1', 'not_any')}) x
  GROUP BY 1, 2
), v_food AS (
  SELECT AccountCR AS AccountId, DateOp AS CutoffDt, round(sum(res), 2) AS v
  FROM (SELECT DISTINCT AccountCR, DateOp, Amount, res FROM v1ops c WHERE {_hit('List_2', 'contains')}) x
  GROUP BY 1, 2
), v_fl AS (
  SELECT c.AccountDB AS AccountId, c.DateOp AS CutoffDt, round(sum(c.res), 2) AS v
  FROM v1ops c JOIN accounts a ON c.AccountCR = a.AccountId
               JOIN clients cl ON a.ClientId = cl.ClientId
  WHERE cl.Type = 'Ф' GROUP BY 1, 2
)
"""

_M = "CAST(coalesce({a}.v, 0) AS DECIMAL(38,2)) AS {n}"
_J = " LEFT JOIN {a} ON {a}.AccountId = k.AccountId AND {a}.CutoffDt = k.CutoffDt"
_PAIRS = [("m_pay", "PaymentAmt"), ("m_enr", "EnrollmentAmt"), ("m_tax", "TaxAmt"), ("m_clr", "ClearAmt"),
          ("m_cars", "CarsAmt"), ("m_food", "FoodAmt"), ("m_fl", "FLAmt")]


def _payments_select(kernel: str) -> str:
    cols = ", ".join(_M.format(a=a, n=n) for a, n in _PAIRS)
    joins = "".join(_J.format(a=a) for a, _ in _PAIRS)
    return f"SELECT k.AccountId, k.ClientId, {cols}, k.CutoffDt FROM {kernel} k{joins}"


def _payments_v1_select() -> str:
    pairs = [(a.replace("m_", "v_"), n) for a, n in _PAIRS]
    cols = ", ".join(f"CAST({a}.v AS DECIMAL(38,2)) AS {n}" for a, n in pairs)
    joins = "".join(_J.format(a=a) for a, _ in pairs)
    return f"SELECT k.AccountId, k.ClientId, {cols}, k.CutoffDt FROM kernel_sql k{joins}"


def _with(*parts: str) -> str:
    return ORACLE_PRELUDE + _COMMON + "".join(parts)


_PAY_FRAME_CTE = _measures("conv", "regex") + f", pay_frame AS ({_payments_select('kernel')})\n"
_PAY_SQL_CTE = (_measures("conv_sql", "token").replace("m_", "s_")
                + f", pay_sql AS ({_payments_select('kernel_sql').replace('m_', 's_')})\n")

_ACCOUNT_FRAME = """
, acct_frame AS (
  SELECT p.AccountId, a.AccountNum, a.DateOpen, p.ClientId, c.ClientName,
         CAST(p.PaymentAmt + p.EnrollmentAmt AS DECIMAL(38,2)) AS TotalAmt, p.CutoffDt
  FROM pay_frame p LEFT JOIN accounts a ON p.AccountId = a.AccountId
                   LEFT JOIN clients c ON p.ClientId = c.ClientId
)
"""
_ACCOUNT_SQL = """
, acct_sql AS (
  SELECT p.AccountId, a.AccountNum, a.DateOpen, p.ClientId, c.ClientName,
         CAST(TRY_CAST(coalesce(p.PaymentAmt, 0) AS DECIMAL(10,2))
            + TRY_CAST(coalesce(p.EnrollmentAmt, 0) AS DECIMAL(10,2)) AS DECIMAL(38,2)) AS TotalAmt,
         p.CutoffDt
  FROM pay_sql p JOIN accounts a ON p.AccountId = a.AccountId
                 JOIN clients c ON p.ClientId = c.ClientId
)
"""


def _info(acct: str) -> str:
    return f"""
SELECT c.ClientId, c.ClientName, c.Type, c.Form, c.RegisterDate,
       CAST(sum(x.TotalAmt) AS DECIMAL(38,2)) AS TotalAmt, x.CutoffDt
FROM clients c JOIN {acct} x ON c.ClientId = x.ClientId
GROUP BY c.ClientId, c.ClientName, c.Type, c.Form, c.RegisterDate, x.CutoffDt
"""


def _kw(mode: str) -> str:
    return _with() + f"""
SELECT c.AccountDB, c.AccountCR, c.DateOp, c.Comment,
       {_hit('List_1', mode)} AS List1Hit, {_hit('List_2', mode)} AS List2Hit
FROM operations c
"""


# Words and the comments that contain them, by an equi join on all substrings of a word's length
# (the large dictionary's words hold no wildcards). ``{before}`` and ``{after}`` surround a token.
_SUBSTRINGS = """
, words AS (
  SELECT DISTINCT 'List_1' AS list, {word1} AS word FROM large_dictionary
  UNION ALL SELECT DISTINCT 'List_2', {word2} FROM large_dictionary
), comments AS (
  SELECT {comment} AS Comment, count(*) AS n FROM operations GROUP BY {comment}
), sizes AS (
  SELECT DISTINCT length(word) + {pad} AS size FROM words
), cuts AS (
  SELECT Comment, size, unnest(range(1, length(Comment) - size + 2)) AS at FROM comments, sizes
  WHERE length(Comment) >= size
), pairs AS (
  SELECT DISTINCT c.Comment, w.list, w.word FROM cuts c
  JOIN words w ON substring(c.Comment, c.at, c.size) = {before} || w.word || {after}
)
"""
_PLAIN = {"word1": "List_1", "word2": "List_2", "comment": "Comment"}
_FOLD = "translate(lower({}), 'abcehkmoptuxyi', 'авсенкмортихуі')"
_MIXED = _FOLD.format("translate(upper({}), 'AOT', 'АОТ')")
_CONTAINS = _SUBSTRINGS.format(pad=0, before="''", after="''", **_PLAIN)
_TOKENS = _SUBSTRINGS.format(pad=2, before="' '", after="','", **_PLAIN)
_FOLDED = _SUBSTRINGS.format(pad=0, before="''", after="''", word1=_MIXED.format("List_1"),
                             word2=_MIXED.format("List_2"), comment=_FOLD.format("Comment"))


def _kw_large(mode: str) -> str:
    """Flags of the distinct comments, joined back to the operations."""
    def hit(x: str) -> str:
        if mode == "not_any":
            return (f"coalesce(f.n{x}, 0) < (SELECT count(*) FROM words WHERE list = 'List_{x}')")
        return f"coalesce(f.n{x}, 0) > 0"
    key = _FOLD.format("o.Comment") if mode == "folded" else "o.Comment"
    return _with() + {"token": _TOKENS, "folded": _FOLDED}.get(mode, _CONTAINS) + f"""
, flags AS (
  SELECT Comment, count(*) FILTER (list = 'List_1') AS n1, count(*) FILTER (list = 'List_2') AS n2
  FROM pairs GROUP BY Comment
)
SELECT o.AccountDB, o.AccountCR, o.DateOp, o.Comment, {hit('1')} AS List1Hit, {hit('2')} AS List2Hit
FROM operations o LEFT JOIN flags f ON {key} = f.Comment
"""


_KW_REGEX_LARGE = _with() + r"""
, parts AS (
  SELECT DISTINCT Comment, trim(Comment) AS c, regexp_extract(Comment, 'за (.*), договор', 1) AS name,
         regexp_extract(Comment, 'договор (\d+)$', 1) AS num FROM operations
), names AS (
  SELECT DISTINCT replace(p_name, 'red', 'hot') AS w FROM part
), flags AS (
  SELECT Comment,
         name IN (SELECT w FROM names) OR num IN (SELECT CAST(o_orderkey * 3 AS VARCHAR) FROM orders)
           OR regexp_matches(c, '\d{4}7$') AS List1Hit,
         regexp_matches(name, 'r[io][nd]g?$') AND num IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders)
           OR regexp_matches(num, '[13579]$') AND EXISTS (SELECT 1 FROM names WHERE starts_with(name, w)) AS List2Hit
  FROM parts
)
SELECT o.AccountDB, o.AccountCR, o.DateOp, o.Comment, f.List1Hit, f.List2Hit
FROM operations o JOIN flags f ON o.Comment = f.Comment
"""
_KW_ROWS = _with() + """
SELECT o.AccountDB, o.AccountCR, o.DateOp, o.Comment, k.list, k.word
FROM operations o
JOIN (SELECT 'List_1' AS list, trim(List_1) AS word FROM keywords WHERE List_1 IS NOT NULL
      UNION SELECT 'List_2', trim(List_2) FROM keywords WHERE List_2 IS NOT NULL) k
  ON regexp_matches(trim(o.Comment), k.word)
"""
_KW_COUNTS = _with() + _CONTAINS + """
SELECT w.list, w.word, coalesce(sum(c.n), 0)::BIGINT AS operations, count(c.n) AS comments
FROM words w LEFT JOIN pairs p ON w.list = p.list AND w.word = p.word
             LEFT JOIN comments c ON p.Comment = c.Comment
GROUP BY w.list, w.word
"""


def _measure(alias: str, name: str) -> str:
    return _with(_measures("conv", "regex")) + f"SELECT AccountId, CutoffDt, CAST(v AS DECIMAL(38,2)) AS {name} FROM {alias}"


def _measure_v1(alias: str, name: str) -> str:
    return _with(_V1_MEASURES) + f"SELECT AccountId, CutoffDt, CAST(v AS DECIMAL(38,2)) AS {name} FROM {alias}"


_MONEY_OPS = "SELECT AccountDB, AccountCR, DateOp, CAST(Amount AS DECIMAL(38,2)) AS Amount, Comment FROM {}"
_LEGS = """
SELECT k.AccountId, k.ClientId, k.CutoffDt, c.AccountDB, c.AccountCR,
       CAST(c.Amount AS DECIMAL(38,2)) AS Amount, c.Comment
FROM kernel k JOIN conv c ON k.AccountId = c.{side} AND k.CutoffDt = c.DateOp
"""

_FAULTY = _with() + """
, faulty AS (
  SELECT AccountDB, AccountCR, CASE WHEN CAST(AccountDB AS BIGINT) % 101 = 0 THEN CAST(DateOp AS VARCHAR) || '/'
                                    ELSE CAST(DateOp AS VARCHAR) END AS DateOp,
         CASE WHEN CAST(AccountCR AS BIGINT) % 97 = 0 THEN '1.' || Amount ELSE Amount END AS Amount, Currency, Comment
  FROM operations
), faults AS (
  SELECT *, 'Amount' AS "column", 'not a decimal(10,2)' AS reason FROM faulty WHERE CAST(AccountCR AS BIGINT) % 97 = 0
  UNION ALL
  SELECT *, 'DateOp', 'not a date' FROM faulty WHERE CAST(AccountDB AS BIGINT) % 101 = 0
)
"""
_INFO_ORDER = "TRY_CAST(ClientId AS BIGINT) NULLS LAST, ClientId NULLS LAST, CutoffDt NULLS LAST"

ORACLE: dict[str, str] = {
    "src_csv": _with() + "SELECT AccountDB, AccountCR, CAST(DateOp AS VARCHAR) AS DateOp, Amount, Currency, Comment FROM operations",
    "src_parquet": _with() + "SELECT AccountId, AccountNum FROM accounts",
    "src_partitioned": _with() + "SELECT * FROM operations WHERE DateOp BETWEEN DATE '1998-01-01' AND DATE '1999-12-31'",
    "src_wholetext": _with() + "SELECT Comment AS line, count(*) AS n FROM operations GROUP BY Comment",
    "json_path": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    "ingest_roundtrip": _with() + "SELECT * FROM operations",
    "ingest_reordered": _with() + "SELECT * FROM operations",
    "sink_partitioned": _with(_PAY_FRAME_CTE) + "SELECT * FROM pay_frame",
    "sink_flat": _with() + "SELECT * FROM kernel",
    "sink_csv_sorted": _with(_PAY_FRAME_CTE, _ACCOUNT_FRAME) + _info("acct_frame"),
    "ops_converted": _with() + _MONEY_OPS.format("conv"),
    "ops_converted_sql": _with() + _MONEY_OPS.format("conv_sql"),
    "kw_regex": _kw("regex"),
    "kw_token": _kw("token"),
    "kw_contains": _kw("contains"),
    "kw_not_any": _kw("not_any"),
    "kw_token_large": _kw_large("token"),
    "kw_contains_large": _kw_large("contains"),
    "kw_not_any_large": _kw_large("not_any"),
    "kw_regex_large": _KW_REGEX_LARGE,
    "kw_folded": _kw_large("folded"),
    "kw_match_rows": _KW_ROWS,
    "kw_matches": _KW_COUNTS,
    "rate_latest_rank": _with() + """
SELECT Currency, Rate, RateDate FROM (
  SELECT *, rank() OVER (PARTITION BY Currency ORDER BY RateDate DESC) AS rk
  FROM rate_history WHERE RateDate IS NOT NULL) x
WHERE rk = 1""",
    "rate_latest_global": _with() + """
SELECT Currency, Rate, RateDate FROM rate_history
WHERE RateDate = (SELECT max(RateDate) FROM rate_history)""",
    "kw_list": _with() + """
SELECT 'List_1' AS list, List_1 AS word FROM part_dictionary WHERE List_1 IS NOT NULL
UNION ALL
SELECT 'List_2' AS list, List_2 AS word FROM part_dictionary WHERE List_2 IS NOT NULL""",
    "acct_prefix": _with() + """
SELECT AccountId, AccountNum, substring(AccountNum, 1, 5) AS BalanceCode,
       substring(AccountNum, 1, 5) = '40702' AS IsTax, substring(AccountNum, 1, 5) = '40802' AS IsClear
FROM accounts""",
    "ledger_ids": _with() + "SELECT * FROM ids",
    "kernel": _with() + "SELECT * FROM kernel",
    "kernel_sql": _with() + "SELECT * FROM kernel_sql",
    "legs_debit": _with() + _LEGS.format(side="AccountDB"),
    "legs_credit": _with() + _LEGS.format(side="AccountCR"),
    "ops_not_cars": _with() + _MONEY_OPS.format(f"(SELECT DISTINCT * FROM conv c WHERE NOT {_hit('List_1', 'regex')}) x"),
    "amt_payment": _measure("m_pay", "PaymentAmt"),
    "amt_enrollment": _measure("m_enr", "EnrollmentAmt"),
    "amt_tax": _measure("m_tax", "TaxAmt"),
    "amt_clear": _measure("m_clr", "ClearAmt"),
    "amt_cars": _measure("m_cars", "CarsAmt"),
    "amt_food": _measure("m_food", "FoodAmt"),
    "amt_fl": _measure("m_fl", "FLAmt"),
    "amt_payment_v1": _measure_v1("v_pay", "PaymentAmt"),
    "amt_tax_v1": _measure_v1("v_tax", "TaxAmt"),
    "amt_clear_v1": _measure_v1("v_clr", "ClearAmt"),
    "amt_cars_v1": _measure_v1("v_cars", "CarsAmt"),
    "amt_food_v1": _measure_v1("v_food", "FoodAmt"),
    "mart_payments": _with(_PAY_FRAME_CTE) + "SELECT * FROM pay_frame",
    "mart_payments_sql": _with(_PAY_SQL_CTE) + "SELECT * FROM pay_sql",
    "mart_payments_v1": _with(_V1_MEASURES) + _payments_v1_select(),
    "mart_account": _with(_PAY_FRAME_CTE, _ACCOUNT_FRAME) + "SELECT * FROM acct_frame",
    "mart_account_sql": _with(_PAY_SQL_CTE, _ACCOUNT_SQL) + "SELECT * FROM acct_sql",
    "mart_info": _with(_PAY_FRAME_CTE, _ACCOUNT_FRAME) + _info("acct_frame"),
    "mart_info_sql": _with(_PAY_SQL_CTE, _ACCOUNT_SQL) + _info("acct_sql"),
}
ORACLE |= {
    "ingest_good": _FAULTY + """SELECT * FROM operations
WHERE CAST(AccountCR AS BIGINT) % 97 <> 0 AND CAST(AccountDB AS BIGINT) % 101 <> 0""",
    "ingest_rejects": _FAULTY + "SELECT * FROM faults",
    "ingest_reject_counts": _FAULTY + 'SELECT "column", reason, count(*) AS n FROM faults GROUP BY "column", reason',
    "preview_top": f"SELECT * FROM ({ORACLE['mart_info']}) x ORDER BY {_INFO_ORDER} LIMIT 20",
    "info_ranked": f"SELECT *, row_number() OVER (ORDER BY {_INFO_ORDER}) AS RowNumber FROM ({ORACLE['mart_info']}) x",
    "ops_converted_as_of": _with() + """
, dated AS (
  SELECT Currency, RateDate, max(TRY_CAST(replace(Rate, ',', '.') AS DECIMAL(10,2))) AS Rate
  FROM rate_history WHERE RateDate IS NOT NULL GROUP BY Currency, RateDate
)
SELECT o.AccountDB, o.AccountCR, o.DateOp,
       CAST(round(TRY_CAST(replace(o.Amount, ',', '.') AS DECIMAL(10,2)) * r.Rate, 2) AS DECIMAL(38,2)) AS Amount,
       o.Comment
FROM operations o ASOF JOIN dated r ON o.Currency = r.Currency AND o.DateOp >= r.RateDate""",
    "mart_incremental": ORACLE["mart_payments"],
    "sql_text_correlated": ORACLE["mart_payments_sql"],
    "rate_latest_window": ORACLE["rate_latest_rank"],
    "sql_text_payments": ORACLE["mart_payments_sql"],
    "sql_text_account": ORACLE["mart_account_sql"],
    "sql_text_info": ORACLE["mart_info_sql"],
}

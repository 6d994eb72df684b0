"""Registered queries: one per operator of SURVEY §2, over the driver's tables.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
column names match the DuckDB oracle in ``oracle.py``. Sink queries write
to a fresh folder under the shared checkpoint directory and read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures
from .functions.money import CLEARING_CODE, TAX_CODE, balance_code, money
from .operators import measures as M
from .operators.dialects import FRAME, SQL
from .operators.keyword_join import match_counts, match_rows, tag, tag_folded
from .operators.kernel import ledger_ids, ledger_kernel
from .operators.legs import payments_mart
from .operators.marts import account_mart, info_from_payments, info_mart
from .operators.rates import (convert_operations, latest_global, latest_per_currency,
                              latest_per_currency_ranked)
from .operators.incremental import CHANGE, PaymentsState
from .plans.pipeline import ingest_table
from .plans.rejects import ingest_checked, read_good, read_rejects
from .plans.sql_chain import correlated_payments, run_sql_marts
from .session import scratch_path
from .sinks.writers import preview, ranked, write_flat, write_partitioned, write_sorted_csv
from .sources.keywords import long_form
from .sources.readers import json_value, read_csv, read_parquet, read_partitioned, read_wholetext

Query = Callable[[SparkSession, str], DataFrame]

#: Lines in one of the text files that are read whole.
WHOLE_LINES = 20_000

_TABLES: dict[tuple[str, str], object] = {}


def _ingested(spark: SparkSession, sf_dir: str):
    """The ledger tables of one fixture folder, ingested once per session.

    As in the source flow (landing data → ingested parquet → marts), the
    derived operations, accounts and clients are written once under the
    shared checkpoint folder - operations partitioned by DateOp - and every
    query of the session reads those written tables. The small inline rate
    and keyword tables stay as they are.
    """
    t = fixtures.ledger_tables(spark, sf_dir)
    base = scratch_path(spark, "ingested-fixture")
    write_partitioned(fixtures.operations(spark, sf_dir, by_date=True), f"{base}/Operation", "DateOp", dealt=True,
                      compression="zstd")
    write_flat(t.accounts, f"{base}/Account")
    write_flat(t.clients, f"{base}/Client")
    return t.with_(
        operations=read_partitioned(spark, f"{base}/Operation", "operations"),
        accounts=spark.read.schema(t.accounts.schema).parquet(f"{base}/Account"),
        clients=spark.read.schema(t.clients.schema).parquet(f"{base}/Client"),
    )


def _t(spark: SparkSession, sf_dir: str):
    """Ingested tables of a fixture folder, once per application and state of its files."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    state = ",".join(sorted(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}" for f in fs.listStatus(fs_path)))
    key = (spark.sparkContext.applicationId, state)
    if key not in _TABLES:
        _TABLES[key] = _ingested(spark, sf_dir)
    return _TABLES[key]


def _money_ops(df: DataFrame) -> DataFrame:
    return df.withColumn("Amount", money("Amount"))


# --- sources ----------------------------------------------------------------------------

def src_csv(spark, sf_dir):
    """Operations written as header CSV, read back with all-text columns."""
    path = scratch_path(spark, "src_csv")
    fixtures.operations(spark, sf_dir).write.option("header", True).csv(path)
    return read_csv(spark, path, "operations")


def src_parquet(spark, sf_dir):
    """A parquet table read whole (the accounts projection of ``customer``)."""
    c = read_parquet(spark, f"{sf_dir.rstrip('/')}/customer.parquet")
    key = F.col("c_custkey")
    return c.select(key.cast("string").alias("AccountId"),
                    F.concat(F.when(F.col("c_mktsegment") == "BUILDING", "40702")
                             .when(F.col("c_mktsegment") == "MACHINERY", "40802").otherwise("40817"),
                             F.lpad(key.cast("string"), 15, "0")).alias("AccountNum"))


def src_partitioned(spark, sf_dir):
    """Partitioned operations read back for two years: only those date dirs are scanned."""
    path = scratch_path(spark, "src_partitioned")
    write_partitioned(fixtures.operations(spark, sf_dir, by_date=True), path, "DateOp", dealt=True)
    return read_partitioned(spark, path, "operations", "1998-01-01", "1999-12-31")


def src_wholetext(spark, sf_dir):
    """Comments written as text files, read one row per file and split back into lines."""
    path = scratch_path(spark, "src_wholetext")
    # A file is one row: its size must not grow with the table.
    fixtures.operations(spark, sf_dir).select("Comment").write.option("maxRecordsPerFile", WHOLE_LINES).text(path)
    whole = read_wholetext(spark, path)
    return whole.select(F.explode(F.split(F.regexp_replace("value", r"\n\z", ""), r"\n")).alias("line")) \
        .groupBy("line").agg(F.count(F.lit(1)).alias("n"))


def ingest_reordered(spark, sf_dir):
    """A landing file with its columns in another order and one more, ingested by header name."""
    csv_path = scratch_path(spark, "landing")
    ops = fixtures.operations(spark, sf_dir)
    ops.select("Comment", "Amount", F.lit("x").alias("Extra"), "DateOp", "AccountCR", "Currency",
               "AccountDB").write.option("header", True).csv(csv_path)
    out = scratch_path(spark, "ingested")
    ingest_table(spark, csv_path, out, "operations")
    return read_partitioned(spark, out, "operations")


def json_path(spark, sf_dir):
    ev = fixtures.read_table(spark, sf_dir, "events")
    return ev.select("event_id", json_value("props", "k").alias("k"))


def ingest_roundtrip(spark, sf_dir):
    """CSV landing file → ingest (partition by DateOp) → partition discovery."""
    csv_path = scratch_path(spark, "landing")
    fixtures.operations(spark, sf_dir).write.option("header", True).csv(csv_path)
    out = scratch_path(spark, "ingested")
    ingest_table(spark, csv_path, out, "operations")
    return read_partitioned(spark, out, "operations")


def _checked_landing(spark, sf_dir):
    csv_path, out = scratch_path(spark, "landing"), scratch_path(spark, "checked")
    fixtures.faulty_operations(spark, sf_dir).write.option("header", True).csv(csv_path)
    return out, ingest_checked(spark, csv_path, out, "operations")


def ingest_good(spark, sf_dir):
    """The rows of a landing file with faults that pass the ingest's checks."""
    return read_good(spark, _checked_landing(spark, sf_dir)[0], "operations")


def ingest_rejects(spark, sf_dir):
    """The rows that do not, with a column and a reason."""
    cells = "AccountDB string, AccountCR string, DateOp string, Amount string, Currency string, Comment string"
    return read_rejects(spark, _checked_landing(spark, sf_dir)[0], "operations").select(
        F.from_json("row", cells).alias("row"), "column", "reason").select("row.*", "column", "reason")


def ingest_reject_counts(spark, sf_dir):
    """Faults by column and reason, observed while the ingest wrote."""
    counts = _checked_landing(spark, sf_dir)[1]
    return spark.createDataFrame([(c, r, n) for (c, r), n in counts.items() if c and n],
                                 "column string, reason string, n long")


# --- sinks ------------------------------------------------------------------------------

def sink_partitioned(spark, sf_dir):
    path = scratch_path(spark, "mart_payments")
    mart = payments_mart(_t(spark, sf_dir), "frame", by_date=True)
    write_partitioned(mart, path, "CutoffDt", dealt=True, compression="zstd")
    return spark.read.schema(mart.schema).parquet(path).select(*mart.columns)


def sink_flat(spark, sf_dir):
    path = scratch_path(spark, "kernel_flat")
    t = _t(spark, sf_dir)
    k = ledger_kernel(t.operations, t.accounts, keep_orphans=True)
    write_flat(k, path)
    return read_parquet(spark, path)


def sink_csv_sorted(spark, sf_dir):
    path = scratch_path(spark, "info_csv")
    info = mart_info(spark, sf_dir)
    write_sorted_csv(info, path, "ClientId", compression="gzip")
    return spark.read.schema(info.schema).option("header", True).csv(path)


def preview_top(spark, sf_dir):
    """The first 20 rows of the info mart by client number."""
    return preview(mart_info(spark, sf_dir), 20, "ClientId")


def info_ranked(spark, sf_dir):
    """The info mart with its row numbers in the order of the sorted CSV."""
    return ranked(mart_info(spark, sf_dir), "ClientId")


# --- conversion, keywords, accounts -------------------------------------------------------

def ops_converted(spark, sf_dir):
    t = _t(spark, sf_dir)
    return _money_ops(convert_operations(t.operations, t.rates, FRAME.rate_policy))


def ops_converted_sql(spark, sf_dir):
    t = _t(spark, sf_dir)
    return _money_ops(convert_operations(t.operations, t.rates, SQL.rate_policy))


def ops_converted_as_of(spark, sf_dir):
    """Every operation at the rate that held on its date, over the long derived rate history."""
    return _money_ops(convert_operations(_t(spark, sf_dir).operations, fixtures.rate_history(spark, sf_dir), "as_of"))


def _kw(mode: str, trim: bool, large: bool = False):
    """Dictionary flags; ``large``: a dictionary that grows with the tables and stays distributed."""
    def q(spark, sf_dir):
        t = _t(spark, sf_dir)
        made = fixtures.large_patterns if mode == "regex" else fixtures.large_dictionary
        words = made(spark, sf_dir) if large else t.keywords
        ops = t.operations.select("AccountDB", "AccountCR", "DateOp", "Comment")
        return tag(ops, words, {"List_1": mode, "List_2": mode}, trim_comment=trim, trim_words=trim) \
            .withColumnsRenamed({"hit_List_1": "List1Hit", "hit_List_2": "List2Hit"})
    q.__name__ = f"kw_{mode}"
    return q


def kw_folded(spark, sf_dir):
    """Flags of a dictionary in capitals, some of its letters Cyrillic look-alikes, that grows with the tables."""
    ops = _t(spark, sf_dir).operations.select("AccountDB", "AccountCR", "DateOp", "Comment")
    words = fixtures.mixed_letters(fixtures.large_dictionary(spark, sf_dir))
    return tag_folded(ops, words, {"List_1": "contains", "List_2": "contains"}).withColumnsRenamed(
        {"hit_List_1": "List1Hit", "hit_List_2": "List2Hit"})


def kw_match_rows(spark, sf_dir):
    """One row per operation and matching word."""
    t = _t(spark, sf_dir)
    ops = t.operations.select("AccountDB", "AccountCR", "DateOp", "Comment")
    return match_rows(ops, t.keywords, "regex", trim_comment=True, trim_words=True)


def kw_matches(spark, sf_dir):
    """Operations and comments per word of a dictionary that grows with the tables."""
    return match_counts(_t(spark, sf_dir).operations, fixtures.large_dictionary(spark, sf_dir), "contains")


def rate_latest_rank(spark, sf_dir):
    """Newest rate(s) of every currency over a long derived rate history."""
    return latest_per_currency(fixtures.rate_history(spark, sf_dir))


def rate_latest_window(spark, sf_dir):
    """The same rates by the window form (``rank`` over Currency)."""
    return latest_per_currency_ranked(fixtures.rate_history(spark, sf_dir))


def rate_latest_global(spark, sf_dir):
    """Rates dated on the newest date of the whole derived history."""
    return latest_global(fixtures.rate_history(spark, sf_dir))


def kw_list(spark, sf_dir):
    """Dictionary columns → (list, word) rows, NULL padding dropped."""
    return long_form(fixtures.part_dictionary(spark, sf_dir))


def acct_prefix(spark, sf_dir):
    acc = fixtures.accounts(spark, sf_dir)
    code = balance_code("AccountNum")
    return acc.select("AccountId", "AccountNum", code.alias("BalanceCode"),
                      (code == TAX_CODE).alias("IsTax"), (code == CLEARING_CODE).alias("IsClear"))


# --- kernel and legs --------------------------------------------------------------------------

def q_ledger_ids(spark, sf_dir):
    return ledger_ids(fixtures.operations(spark, sf_dir))


def kernel(spark, sf_dir):
    t = _t(spark, sf_dir)
    return ledger_kernel(t.operations, t.accounts, keep_orphans=True)


def kernel_sql(spark, sf_dir):
    t = _t(spark, sf_dir)
    return ledger_kernel(t.operations, t.accounts, keep_orphans=False)


def legs_debit(spark, sf_dir):
    t = _t(spark, sf_dir)
    return _money_ops(M.debit_legs(M.converted_ops(t, "frame"), t.accounts))


def legs_credit(spark, sf_dir):
    t = _t(spark, sf_dir)
    return _money_ops(M.credit_legs(M.converted_ops(t, "frame"), t.accounts))


def ops_not_cars(spark, sf_dir):
    t = _t(spark, sf_dir)
    return _money_ops(M.ops_not_matching(M.converted_ops(t, "frame"), t, FRAME))


# --- measures (DataFrame dialect) --------------------------------------------------------------

def _measure(name: str):
    def q(spark, sf_dir):
        return M.measure(name, _t(spark, sf_dir), "frame")
    return q


def _measure_v1(fn):
    def q(spark, sf_dir):
        return fn(_t(spark, sf_dir))
    return q


# --- marts ------------------------------------------------------------------------------

def mart_payments(spark, sf_dir):
    return payments_mart(_t(spark, sf_dir), "frame")


def mart_payments_sql(spark, sf_dir):
    return payments_mart(_t(spark, sf_dir), "sql")


def mart_payments_v1(spark, sf_dir):
    return payments_mart(_t(spark, sf_dir), "sql_v1")


def mart_account(spark, sf_dir):
    t = _t(spark, sf_dir)
    return account_mart(payments_mart(t, "frame"), t, "frame")


def mart_account_sql(spark, sf_dir):
    t = _t(spark, sf_dir)
    return account_mart(payments_mart(t, "sql"), t, "sql")


def mart_info(spark, sf_dir):
    t = _t(spark, sf_dir)
    return info_mart(info_from_payments(payments_mart(t, "frame"), "frame"), t)


def mart_info_sql(spark, sf_dir):
    t = _t(spark, sf_dir)
    return info_mart(info_from_payments(payments_mart(t, "sql"), "sql"), t)


def mart_incremental(spark, sf_dir):
    """The payments mart after two deltas: operations that came late, and others that are withdrawn."""
    t = _t(spark, sf_dir)
    late = F.col("AccountCR").cast("long") % 7 == 3
    extra = t.operations.where(F.col("AccountDB").cast("long") % 11 == 5).withColumn(
        "Comment", F.concat(F.lit("отмена: "), F.col("Comment")))
    state = PaymentsState(spark, scratch_path(spark, "incremental"))
    state.build(t.with_(operations=t.operations.where(~late).unionByName(extra)))
    state.apply(t.operations.where(late).withColumn(CHANGE, F.lit(1)), t)
    state.apply(extra.withColumn(CHANGE, F.lit(-1)), t)
    return state.mart(t)


def sql_text_correlated(spark, sf_dir):
    return correlated_payments(spark, _t(spark, sf_dir))


def _sql_text(name: str):
    """One mart of the SQL-text chain."""
    def q(spark, sf_dir):
        return run_sql_marts(spark, _t(spark, sf_dir))[name]
    return q


QUERIES: dict[str, Query] = {
    "src_csv": src_csv,
    "src_parquet": src_parquet,
    "src_partitioned": src_partitioned,
    "src_wholetext": src_wholetext,
    "json_path": json_path,
    "ingest_roundtrip": ingest_roundtrip,
    "ingest_reordered": ingest_reordered,
    "ingest_good": ingest_good,
    "ingest_rejects": ingest_rejects,
    "ingest_reject_counts": ingest_reject_counts,
    "sink_partitioned": sink_partitioned,
    "sink_flat": sink_flat,
    "sink_csv_sorted": sink_csv_sorted,
    "preview_top": preview_top,
    "info_ranked": info_ranked,
    "ops_converted": ops_converted,
    "ops_converted_sql": ops_converted_sql,
    "ops_converted_as_of": ops_converted_as_of,
    "kw_regex": _kw("regex", True),
    "kw_token": _kw("token", False),
    "kw_contains": _kw("contains", False),
    "kw_not_any": _kw("not_any", False),
    "kw_token_large": _kw("token", False, large=True),
    "kw_contains_large": _kw("contains", False, large=True),
    "kw_not_any_large": _kw("not_any", False, large=True),
    "kw_regex_large": _kw("regex", True, large=True),
    "kw_folded": kw_folded,
    "kw_match_rows": kw_match_rows,
    "kw_matches": kw_matches,
    "rate_latest_rank": rate_latest_rank,
    "rate_latest_window": rate_latest_window,
    "rate_latest_global": rate_latest_global,
    "kw_list": kw_list,
    "acct_prefix": acct_prefix,
    "ledger_ids": q_ledger_ids,
    "kernel": kernel,
    "kernel_sql": kernel_sql,
    "legs_debit": legs_debit,
    "legs_credit": legs_credit,
    "ops_not_cars": ops_not_cars,
    "amt_payment": _measure("PaymentAmt"),
    "amt_enrollment": _measure("EnrollmentAmt"),
    "amt_tax": _measure("TaxAmt"),
    "amt_clear": _measure("ClearAmt"),
    "amt_cars": _measure("CarsAmt"),
    "amt_food": _measure("FoodAmt"),
    "amt_fl": _measure("FLAmt"),
    "amt_payment_v1": _measure_v1(M.payment_v1),
    "amt_tax_v1": _measure_v1(M.tax_v1),
    "amt_clear_v1": _measure_v1(M.clear_v1),
    "amt_cars_v1": _measure_v1(M.cars_v1),
    "amt_food_v1": _measure_v1(M.food_v1),
    "mart_payments": mart_payments,
    "mart_payments_sql": mart_payments_sql,
    "mart_payments_v1": mart_payments_v1,
    "mart_account": mart_account,
    "mart_account_sql": mart_account_sql,
    "mart_info": mart_info,
    "mart_info_sql": mart_info_sql,
    "mart_incremental": mart_incremental,
    "sql_text_correlated": sql_text_correlated,
    "sql_text_payments": _sql_text("payments"),
    "sql_text_account": _sql_text("account"),
    "sql_text_info": _sql_text("info"),
}

"""Plan shape regression checks (from explain("formatted"))."""

import io
import re
from contextlib import redirect_stdout

import pytest

from conftest import SF001
from ledgerloom import fixtures
from ledgerloom.operators import payments_mart
from ledgerloom.queries import QUERIES


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _shuffle_keys(plan: str) -> list[str]:
    return sorted(re.sub(r"#\d+L?", "", k) for k in
                  re.findall(r"Arguments: hashpartitioning\(([^)]*?), \d+\)", plan))


@pytest.mark.parametrize("name", ["mart_payments", "mart_payments_sql", "mart_payments_v1",
                                  "mart_account", "mart_info", "kernel", "ops_converted"])
def test_no_pairwise_joins(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_payments_mart_shuffles(spark):
    keys = _shuffle_keys(_plan(QUERIES["mart_payments"](spark, SF001)))
    # Three mart shuffles plus the per-currency max over the (small) rate table;
    # operations are never partitioned by Currency.
    assert keys == sorted([
        # The last two: the vehicles flag, and the comment only where it counts for vehicles.
        "AccountDB, AccountCR, DateOp, amt, _groupingexpression, _groupingexpression",
        "AccountDB, AccountCR, DateOp, amt",
        "AccountId, CutoffDt",
        "Currency",
    ])


def test_measures_run_no_needless_jobs(spark):
    """Building a sum measure starts only the count of the reduced rates."""
    QUERIES["amt_payment"](spark, SF001)  # ingests the fixture
    sc = spark.sparkContext
    sc.setJobGroup("amt_payment", "build")
    QUERIES["amt_payment"](spark, SF001)
    jobs = sc.statusTracker().getJobIdsForGroup("amt_payment")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(jobs) <= 4


def test_matched_rows_send_no_comment(spark):
    plan = _plan(QUERIES["mart_payments"](spark, SF001))
    assert re.search(r"CASE WHEN NOT hit_List_1#\d+ THEN Comment#\d+ END", plan)


def test_legs_do_not_join_the_kernel(spark):
    plan = _plan(QUERIES["legs_debit"](spark, SF001))
    assert plan.count("ReadSchema: struct<AccountDB") == 1


def test_info_joins_no_account_attributes(spark):
    plan = _plan(QUERIES["mart_info"](spark, SF001))
    assert "DateOpen" not in plan


def test_kernel_scan_is_pruned(spark):
    plan = _plan(QUERIES["kernel"](spark, SF001))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert "struct<AccountDB:string,AccountCR:string>" in schemas


def test_correlated_subqueries_become_hash_joins(spark):
    """Seven scalar subqueries per kernel row: aggregates joined by key, no nested loop, one scan of the comments' flags."""
    plan = _plan(QUERIES["sql_text_correlated"](spark, SF001))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Subquery:" not in plan or "outer(" not in plan


@pytest.mark.parametrize("name", ["amt_tax", "amt_clear", "amt_fl"])
def test_counterparty_meets_sums_only(spark, name):
    """Operations are summed by (debit, credit, date) before the counterparty join."""
    df = QUERIES[name](spark, SF001)
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [i for i, line in enumerate(plan) if "Join Inner" in line and "AccountDB" in "".join(plan[i:i + 3])]
    assert joins, plan
    first_sum = next(i for i, line in enumerate(plan) if "Aggregate [AccountDB#" in line and "AccountCR#" in line)
    rate_join = max(i for i, line in enumerate(plan) if "Currency#" in line and "Join" in line)
    assert joins[0] < first_sum < rate_join


def test_sql_chain_sends_no_matched_comment(spark):
    keys = _shuffle_keys(_plan(QUERIES["sql_text_payments"](spark, SF001)))
    assert "AccountDB, AccountCR, DateOp, amt, Comment" not in keys


def test_ingest_deals_out_rows_without_their_texts(spark):
    """The shuffle by date carries names and numbers; comments and amounts are made from them after it."""
    dealt = fixtures.operations(spark, SF001, by_date=True)
    plan = dealt._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "RebalancePartitions" in line)
    assert "AS Comment" in "".join(plan[:at]) and "AS Comment" not in "".join(plan[at:])
    rows = fixtures.operations(spark, SF001)
    assert rows.exceptAll(dealt).count() == 0 and dealt.exceptAll(rows).count() == 0


@pytest.mark.parametrize("dialect", ["frame", "sql", "sql_v1"])
def test_mart_is_dealt_out_before_its_decimals(spark, sf001_tables, dialect):
    """The shuffle by date carries sums; the mart's decimals are made after it, and its rows are the same."""
    dealt = payments_mart(sf001_tables, dialect, by_date=True)
    plan = dealt._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "RebalancePartitions" in line)
    assert "AS PaymentAmt" in "".join(plan[:at])
    assert "decimal(38,2)) AS PaymentAmt" not in "".join(plan[at:])
    rows = payments_mart(sf001_tables, dialect)
    assert rows.exceptAll(dealt).count() == 0 and dealt.exceptAll(rows).count() == 0


def test_dealt_mart_with_repeated_accounts(spark, sf001_tables):
    t = sf001_tables.with_(accounts=sf001_tables.accounts.unionAll(sf001_tables.accounts.where("AccountId < 9")))
    rows, dealt = payments_mart(t, "frame"), payments_mart(t, "frame", by_date=True)
    assert rows.exceptAll(dealt).count() == 0 and dealt.exceptAll(rows).count() == 0

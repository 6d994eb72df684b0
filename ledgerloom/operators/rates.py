"""Rate policies and currency conversion (JN1, JN2, WN1, FLT8, FLT9, CM1, D1).

Rates are reduced to at most one row per currency *before* they meet the
operations, so the operations never shuffle by Currency (a handful of keys)
and the reduced table is broadcast behind a row-count check. The ``as_of`` policy
reduces them to one rate per currency and operation date, whatever the number of operations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import converted
from ..schemas import parse_decimal_comma
from ..session import stored
from .broadcast import bounded_broadcast

POLICIES = ("latest_per_currency", "latest_global", "as_of")

# A reduced rate table has one row per currency (more only on tied dates).
MAX_RATE_ROWS = 10_000
# As-of rates: currencies times days of operations.
MAX_AS_OF_ROWS = 1_000_000


def latest_per_currency(rates: DataFrame) -> DataFrame:
    """Newest rate of each currency; tied dates all kept (``rank() = 1``).

    Computed as max-date per currency (partial aggregation, no shuffle of
    the rate rows by their few currency keys) joined back to the rates.
    """
    dated = rates.filter(F.col("RateDate").isNotNull())
    newest = dated.groupBy("Currency").agg(F.max("RateDate").alias("RateDate"))
    return dated.join(newest, ["Currency", "RateDate"]).select(*rates.columns)


def latest_per_currency_ranked(rates: DataFrame) -> DataFrame:
    """The same set written as the window form (``rank`` over Currency)."""
    w = Window.partitionBy("Currency").orderBy(F.col("RateDate").desc())
    return (rates.filter(F.col("RateDate").isNotNull())
            .withColumn("rank", F.rank().over(w))
            .filter(F.col("rank") == 1).drop("rank"))


def latest_global(rates: DataFrame) -> DataFrame:
    """Rates dated on the newest date of the whole table (scalar subquery).

    Currencies without a rate on that date get none.
    """
    newest = rates.agg(F.max("RateDate").alias("RateDate"))  # exactly one row
    return rates.join(F.broadcast(newest), "RateDate").select(*rates.columns)


def as_of_rates(days: DataFrame, rates: DataFrame) -> DataFrame:
    """Currency, DateOp, RateDate, Rate: the newest rate not after each (Currency, DateOp) of ``days``.

    An as-of join without a range join: rates and days meet in buckets of one currency and
    month, where the last rate is carried forward; a bucket starts with the last
    rate of the buckets before it, from one row per bucket. So a currency's history is spread over as
    many tasks as it has months. Of several rates of one date the greatest applies; a newest rate
    whose text does not parse gives a NULL Rate. Days before the first rate, NULL days and NULL
    currencies have no row.
    """
    pick = F.struct(F.col("RateDate").alias("at"), F.col("Rate").alias("rate"))
    dated = rates.filter(F.col("RateDate").isNotNull() & F.col("Currency").isNotNull()).select(
        "Currency", "RateDate", parse_decimal_comma("Rate").alias("Rate")).groupBy("Currency", "RateDate").agg(
        F.max("Rate").alias("Rate"))
    asked = days.select("Currency", "DateOp").filter(F.col("DateOp").isNotNull()).distinct()
    events = dated.select("Currency", F.col("RateDate").alias("day"), pick.alias("pick"), F.lit(False).alias("asked")) \
        .unionByName(asked.select("Currency", F.col("DateOp").alias("day"), F.lit(None).cast(
            "struct<at: date, rate: decimal(10,2)>").alias("pick"), F.lit(True).alias("asked"))) \
        .withColumn("month", F.trunc("day", "MM"))
    earlier = Window.partitionBy("Currency").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    carried = events.groupBy("Currency", "month").agg(F.max("pick").alias("newest")).select(
        "Currency", "month", F.last("newest", ignorenulls=True).over(earlier).alias("carried"))
    inside = Window.partitionBy("Currency", "month").orderBy("day", "asked").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    found = events.withColumn("last", F.last("pick", ignorenulls=True).over(inside)).filter("asked")
    best = F.coalesce("last", "carried")
    return (found.join(carried, ["Currency", "month"]).filter(best.isNotNull())
            .select("Currency", F.col("day").alias("DateOp"), best["at"].alias("RateDate"), best["rate"].alias("Rate")))


def attach_rate_as_of(operations: DataFrame, rates: DataFrame, keep_unrated: bool = False) -> DataFrame:
    """Operations with the ``Rate`` that held on their date; see ``as_of_rates``.

    The rates of the operations' days are stored and broadcast up to ``MAX_AS_OF_ROWS`` rows;
    beyond that the join is Spark's, on (Currency, DateOp).
    """
    reduced = stored(as_of_rates(operations, rates).drop("RateDate"), "as-of-rates")
    reduced = bounded_broadcast(reduced, MAX_AS_OF_ROWS)
    return operations.join(reduced, ["Currency", "DateOp"], "left" if keep_unrated else "inner")


def reduce_rates(rates: DataFrame, policy: str) -> DataFrame:
    if policy == "latest_per_currency":
        return latest_per_currency(rates)
    if policy == "latest_global":
        return latest_global(rates)
    if policy == "as_of":
        raise ValueError("the as_of policy depends on the operations: see as_of_rates")
    raise ValueError(f"unknown rate policy {policy!r}; expected one of {POLICIES}")


def attach_rate(operations: DataFrame, rates: DataFrame, policy: str,
                keep_unrated: bool = False, checked: DataFrame | None = None) -> DataFrame:
    """Operations with the policy's parsed ``Rate`` (broadcast join).

    ``keep_unrated`` keeps operations whose currency has no rate (Rate NULL).
    ``checked`` is an already size-checked reduced rate table.
    """
    if policy == "as_of":
        return attach_rate_as_of(operations, rates, keep_unrated)
    reduced = checked if checked is not None else bounded_broadcast(
        reduced_rates(rates, policy), MAX_RATE_ROWS)
    how = "left" if keep_unrated else "inner"
    return operations.join(reduced, "Currency", how)


def reduced_rates(rates: DataFrame, policy: str) -> DataFrame:
    """(Currency, Rate) rows the policy applies, the text parsed once; not yet broadcast."""
    return reduce_rates(rates, policy).select("Currency", parse_decimal_comma("Rate").alias("Rate"))


def convert_operations(operations: DataFrame, rates: DataFrame,
                       policy: str = "latest_per_currency") -> DataFrame:
    """AccountDB, AccountCR, DateOp, Amount (national currency), Comment."""
    return attach_rate(operations, rates, policy).select(
        "AccountDB", "AccountCR", "DateOp",
        converted("Amount", "Rate").alias("Amount"),
        "Comment",
    )

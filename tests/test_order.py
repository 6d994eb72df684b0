"""Previews and row numbers in global order."""

import random

from ledgerloom.sinks.writers import preview, ranked

ROWS = [(str(i % 40), f"2021-{i % 7}") for i in range(400)] + [(None, "x"), ("abc", "y"), ("abc", None), ("10", "2021-1")]


def order(r):
    i, d = r
    number = int(i) if i is not None and i.isdigit() else None
    return (number is None, number or 0, i is None, i or "", d is None, d or "")


def test_ranked(spark):
    rows = ROWS[:]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, "z") for r in rows], "AccountId string, CutoffDt string, _part string").repartition(7)
    df = df.drop("_part")
    got = sorted(ranked(df).collect(), key=lambda r: r["RowNumber"])
    assert [r["RowNumber"] for r in got] == list(range(1, len(rows) + 1))
    assert [(r[0], r[1]) for r in got] == sorted(rows, key=order)
    assert ranked(df.limit(0)).count() == 0


def test_ranked_splits_a_hot_key(spark):
    df = spark.range(0, 50_000, 1, 8).selectExpr("'7' AS AccountId", "'d' AS CutoffDt")
    out = ranked(df)
    assert sorted(r[0] for r in out.select("RowNumber").collect()) == list(range(1, 50_001))
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]


def test_preview(spark):
    rows = ROWS[:]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "AccountId string, CutoffDt string").repartition(5)
    top = preview(df, 25)
    assert [tuple(r) for r in top.collect()] == sorted(rows, key=order)[:25]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert [r[0] for r in preview(df, 2, numeric=False).collect()] == ["0", "0"]

"""Sources, sinks, ingest and the streaming ingest."""

import csv
import datetime as dt
import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from ledgerloom import fixtures
from ledgerloom.plans.pipeline import _read_back, build_and_write, ingest, load_tables, stale_dates
from ledgerloom.session import local_fs_path, scratch_path
from ledgerloom.sinks.writers import write_partitioned, write_sorted_csv
from ledgerloom.sources.keywords import load_lists_upto, long_form
from ledgerloom.sources.readers import json_value, read_csv, read_partitioned, read_wholetext
from ledgerloom.streaming.ingest import ingest_stream


def _write_csv(df, path):
    df.write.option("header", True).csv(path)


def test_csv_is_all_text_and_keeps_blanks(spark):
    path = local_fs_path(scratch_path(spark, "kw"))
    os.makedirs(path)
    with open(os.path.join(path, "kw.csv"), "w", encoding="utf-8") as fh:
        fh.write("List_1,List_2\nавтомобиль ,сою\n,соя\n")
    df = read_csv(spark, path, "keywords")
    assert dict(df.dtypes) == {"List_1": "string", "List_2": "string"}
    assert load_lists_upto(df, 10)["List_1"] == ["автомобиль "]
    assert load_lists_upto(df, 10, trim=True)["List_1"] == ["автомобиль"]
    assert load_lists_upto(df, 2) is None
    assert long_form(df).count() == 3


def test_partition_pruning(spark):
    path = scratch_path(spark, "ops")
    write_partitioned(fixtures.operations(spark, SF001), path, "DateOp")
    df = read_partitioned(spark, path, "operations", "1998-01-01", "1998-12-31")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "DateOp" in plan
    assert dict(df.dtypes)["DateOp"] == "date"
    days = {r[0] for r in df.select("DateOp").distinct().collect()}
    assert days and all(dt.date(1998, 1, 1) <= d <= dt.date(1998, 12, 31) for d in days)


def test_wholetext_one_row_per_file(spark):
    path = scratch_path(spark, "txt")
    spark.createDataFrame([("a",), ("b",), ("c",)], "v string").repartition(2).write.text(path)
    df = read_wholetext(spark, path)
    files = glob.glob(os.path.join(local_fs_path(path), "part-*"))
    assert df.count() == len(files)
    assert sorted("".join(r["value"] for r in df.collect()).split()) == ["a", "b", "c"]


def test_json_value(spark):
    ev = fixtures.read_table(spark, SF001, "events")
    r = ev.select("props", json_value("props", "k").alias("k")).first()
    assert r["props"].replace(" ", "").startswith('{"k":') and r["k"] is not None


def test_sorted_csv_is_globally_ordered(spark):
    path = scratch_path(spark, "sorted")
    df = spark.range(0, 200).select((F.col("id") * 7 % 200).cast("string").alias("AccountId"))
    write_sorted_csv(df.repartition(5), path, "AccountId")
    parts = sorted(glob.glob(os.path.join(local_fs_path(path), "part-*.csv")))
    values = []
    for p in parts:
        with open(p, encoding="utf-8") as fh:
            values += [int(x) for x in fh.read().split()[1:]]
    assert values == sorted(values) and len(values) == 200


def test_sorted_csv_packed(spark, tmp_path):
    """Packed part files hold the same lines in the same order."""
    df = spark.range(500).select((F.col("id") * 7919 % 500).cast("string").alias("AccountId"), F.lit("a,b").alias("v"))
    path = str(tmp_path / "packed")
    write_sorted_csv(df.repartition(5), path, "AccountId", compression="gzip")
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    assert parts and all(p.endswith(".csv.gz") for p in parts)
    lines = [row for p in parts for row in csv.reader(gzip.open(f"{path}/{p}", "rt")) if row != ["AccountId", "v"]]
    assert lines == [[str(i), "a,b"] for i in range(500)]



def test_ingest_and_chain(spark):
    land = scratch_path(spark, "landing")
    ops = fixtures.operations(spark, SF001)
    acc = fixtures.accounts(spark, SF001)
    cl = fixtures.clients(spark, SF001)
    _write_csv(cl, f"{land}/Clients.csv")
    _write_csv(acc, f"{land}/Accounts.csv")
    _write_csv(ops, f"{land}/Operations.csv")
    _write_csv(fixtures.rates(spark), f"{land}/Rates.csv")
    _write_csv(fixtures.keywords(spark), f"{land}/keywords.csv")
    pq = scratch_path(spark, "parquet")
    paths = ingest(spark, land, pq)
    assert set(paths) == {"clients", "accounts", "operations", "rates"}
    t = load_tables(spark, pq, f"{land}/keywords.csv")
    assert dict(t.operations.dtypes)["DateOp"] == "date"
    out = scratch_path(spark, "marts")
    marts = build_and_write(spark, t, out, "frame")
    pay = spark.read.parquet(marts["payments"])
    assert pay.count() == 5881
    info = spark.read.parquet(marts["info"])
    assert info.count() == 2849
    before = sorted(tuple(r) for r in pay.collect())
    times = {p: os.path.getmtime(p) for p in glob.glob(f"{local_fs_path(out)}/*/CutoffDt=*/part-*")}
    # Reload one cutoff date: only its partition is read and replaced.
    day = dt.date(1996, 5, 1)
    one = load_tables(spark, pq, f"{land}/keywords.csv", day, day)
    plan = one.operations._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    build_and_write(spark, one, out, "frame", dynamic_overwrite=True)
    after = spark.read.parquet(marts["payments"]).select(*pay.columns)
    assert sorted(tuple(r) for r in after.collect()) == before
    now = {p: os.path.getmtime(p) for p in glob.glob(f"{local_fs_path(out)}/*/CutoffDt=*/part-*")}
    same = {p for p, t in now.items() if times.get(p) == t}
    assert {p for p in now if "1996-05-01" not in p} <= same and all("1996-05-01" not in p for p in same)
    assert stale_dates(spark, one, out, day, day) == []
    none = one.with_(operations=one.operations.limit(0))
    assert stale_dates(spark, none, out, day, day) == [day]


def test_reload_reads_back_only_its_dates(spark, sf001_tables):
    from ledgerloom.operators import payments_mart

    mart = payments_mart(sf001_tables, "frame")
    path = scratch_path(spark, "read-back")
    write_partitioned(mart, path, "CutoffDt")
    plan = _read_back(spark, mart, path, [dt.date(1996, 5, 1)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(CutoffDt" in plan or "PartitionFilters: [(CutoffDt" in plan


def _landing(spark, header, row):
    path = local_fs_path(scratch_path(spark, "landing"))
    os.makedirs(path)
    with open(os.path.join(path, "a.csv"), "w", encoding="utf-8") as fh:
        fh.write(f"{header}\n{row}\n")
    return path


def test_csv_columns_go_by_header_name(spark):
    path = _landing(spark, "AccountId,ClientId,Extra,accountnum,DateOpen", "1,C9,z,40702000,2020-01-01")
    row = read_csv(spark, path, "accounts").first()
    assert row.asDict() == {"AccountId": "1", "AccountNum": "40702000", "ClientId": "C9", "DateOpen": "2020-01-01"}
    with pytest.raises(ValueError, match="AccountNum"):
        read_csv(spark, _landing(spark, "AccountId,ClientId,DateOpen", "1,C9,2020-01-01"), "accounts")


def test_stream_refuses_other_headers(spark):
    land = _landing(spark, "AccountId,ClientId,AccountNum,DateOpen", "1,C9,40702000,2020-01-01")
    with pytest.raises(Exception, match="CSV header|FAILED_READ_FILE"):
        ingest_stream(spark, land, scratch_path(spark, "o"), scratch_path(spark, "c"), "accounts")


def test_scratch_is_shared_and_can_be_cleared(spark, monkeypatch):
    from ledgerloom import session

    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session)
    root = local_fs_path(f"{session.checkpoint_root(spark)}/ledgerloom-scratch")
    spark.range(2).write.parquet(scratch_path(spark, "x"))
    keep = {p for p in os.listdir(root)}
    assert any(p.startswith("x-") for p in keep)
    monkeypatch.setattr(session, "checkpoint_root", lambda s, base=f"{root}/own": base)
    spark.range(2).write.parquet(session.scratch_path(spark, "y"))
    session.clear_scratch(spark)
    assert not os.path.exists(f"{root}/own/ledgerloom-scratch") and keep <= set(os.listdir(root))


def test_streaming_ingest_is_incremental(spark):
    land = scratch_path(spark, "stream-landing")
    out = scratch_path(spark, "stream-out")
    ckpt = scratch_path(spark, "stream-ckpt")
    ops = fixtures.operations(spark, SF001)
    first = ops.filter(F.col("DateOp") < F.lit("1998-01-01").cast("date"))
    second = ops.filter(F.col("DateOp") >= F.lit("1998-01-01").cast("date"))
    _write_csv(first, f"{land}/batch=1")
    ingest_stream(spark, land, out, ckpt, "operations")
    n1 = read_partitioned(spark, out, "operations").count()
    _write_csv(second, f"{land}/batch=2")
    ingest_stream(spark, land, out, ckpt, "operations")
    n2 = read_partitioned(spark, out, "operations").count()
    assert n1 == first.count() and n2 == ops.count()


def test_reload_of_chosen_dates_by_dynamic_overwrite(spark, sf001_tables):
    from ledgerloom.operators import payments_mart

    t = sf001_tables
    path = scratch_path(spark, "reload")
    full = payments_mart(t, "frame")
    write_partitioned(full, path, "CutoffDt")
    day = dt.date(1997, 3, 1)
    # Recompute one cutoff date from its own operations and replace only it.
    one = payments_mart(t.with_(operations=t.operations.filter(F.col("DateOp") == F.lit(day))), "frame")
    write_partitioned(one, path, "CutoffDt", dynamic_overwrite=True)
    back = spark.read.schema(full.schema).parquet(path).select(*full.columns)
    assert back.exceptAll(full).count() == 0 and full.exceptAll(back).count() == 0


def test_publish_wiring_without_a_database(spark, monkeypatch):
    """Each written mart goes to its table; no connection is opened here."""
    from ledgerloom.plans import pipeline

    calls = []
    monkeypatch.setattr(pipeline, "write_jdbc",
                        lambda df, url, table, props, driver, num_partitions=None:
                        calls.append((df.count(), url, table, props, driver, num_partitions)))
    paths = {}
    for name in ("payments", "account", "info"):
        p = scratch_path(spark, name)
        spark.range(3).write.parquet(p)
        paths[name] = p
    pipeline.publish(spark, paths, "jdbc:postgresql://db/marts", {"user": "u"}, "org.postgresql.Driver", 4)
    assert sorted(c[2] for c in calls) == ["CorporateAccount", "CorporateInfo", "CorporatePayments"]
    assert all(c[0] == 3 and c[1] == "jdbc:postgresql://db/marts" and c[4] == "org.postgresql.Driver"
               and c[5] == 4 for c in calls)


def test_preview_and_clean_keys(spark, sf001_tables):
    from ledgerloom.schemas import validate
    from ledgerloom.sinks.writers import preview

    validate(sf001_tables)                      # fixture keys are unique: no error
    assert preview(sf001_tables.operations).count() == 20


def test_wholetext_files_are_bounded(spark, tmp_path, monkeypatch):
    """Files do not grow with the table, and every line is kept, empty ones at the end of a file too."""
    from ledgerloom import fixtures, queries

    comments = ["a", None, "", "b", "", None, "b"]
    monkeypatch.setattr(fixtures, "operations", lambda *_: spark.createDataFrame(
        [(c,) for c in comments], "Comment string").coalesce(1))
    monkeypatch.setattr(queries, "WHOLE_LINES", 2)
    path = str(tmp_path / "lines")
    monkeypatch.setattr(queries, "scratch_path", lambda *_: path)
    got = {r["line"]: r["n"] for r in queries.src_wholetext(spark, "").collect()}
    assert got == {"a": 1, "": 4, "b": 2}
    assert spark.read.text(path, wholetext=True).count() == 4

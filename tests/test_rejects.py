"""Ingest with a quarantine: one pass, faults by row, column and reason."""

import json

from ledgerloom.plans import rejects


def test_faults_of_a_landing_file(spark, tmp_path):
    lines = ["AccountDB,AccountCR,DateOp,Amount,Currency,Comment",
             'A,B,2021-03-01,"1,50",RUB,ok', "A,B,2021-03-01,1.50,RUB,point is a decimal too",
             'A,B,2021-03-01,"1.234,56",RUB,thousands', "A,B,01.03.2021,5,RUB,date", "A,B,xx,yy,RUB,both",
             "A,B,,,RUB,empty cells are no faults", "A,B,2021-03-02,7,RUB", "A,B,2021-03-02,7,RUB,c,extra", ",,,,,"]
    src, out = tmp_path / "Operations.csv", str(tmp_path / "out")
    src.write_text("\n".join(lines) + "\n", encoding="utf-8")
    counts = rejects.ingest_checked(spark, str(src), out, "operations")
    assert counts == {("Amount", rejects.NOT_DECIMAL): 2, ("DateOp", rejects.NOT_DATE): 2,
                      (rejects.LINE, rejects.NOT_FIELDS): 2, ("", "rows"): 9}
    good = sorted((str(r["DateOp"]), r["Comment"] or "") for r in rejects.read_good(spark, out, "operations").collect())
    assert good == [("2021-03-01", "ok"), ("2021-03-01", "point is a decimal too"), ("None", ""),
                    ("None", "empty cells are no faults")]
    bad = sorted((r["column"], json.loads(r["row"]).get("Comment", "")) for r in
                 rejects.read_rejects(spark, out, "operations").collect())
    assert bad == [("(line)", ""), ("(line)", "c"), ("Amount", "both"), ("Amount", "thousands"), ("DateOp", "both"),
                   ("DateOp", "date")]


def test_nothing_rejected_and_empty_file(spark, tmp_path):
    for i, body in enumerate(["USD,\"2,00\",2021-01-01\n", ""]):
        src, out = tmp_path / f"r{i}.csv", str(tmp_path / f"out{i}")
        src.write_text("Currency,Rate,RateDate\n" + body, encoding="utf-8")
        counts = rejects.ingest_checked(spark, str(src), out, "rates")
        assert sum(counts.values()) == (1 if body else 0)
        if body:
            assert rejects.read_rejects(spark, out, "rates").count() == 0
            assert [tuple(map(str, r)) for r in rejects.read_good(spark, out, "rates").collect()] == [
                ("USD", "2,00", "2021-01-01")]


def test_one_scan(spark, tmp_path):
    """The file is read once: tests, counts and both outputs share the pass."""
    src = tmp_path / "r.csv"
    src.write_text("Currency,Rate,RateDate\nUSD,x,2021-01-01\n", encoding="utf-8")
    sc = spark.sparkContext
    sc.setJobGroup("one-scan", "ingest")
    rejects.ingest_checked(spark, str(src), str(tmp_path / "out"), "rates")
    jobs = sc.statusTracker().getJobIdsForGroup("one-scan")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(jobs) <= 3  # the header line, and the write's shuffle and write under adaptive execution

import importlib
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_bpe import brute as encoded
from test_simhash import slow_components, slow_fingerprint

#: The smallest table with enough labelled rows for the scorer.
SF = "/root/testdata/sf0.01"
ROOT = str(Path(__file__).resolve().parents[2])


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    sys.path.insert(0, ROOT)
    pipe = importlib.import_module("corpus_pipeline")
    out = tmp_path_factory.mktemp("pipe")
    docs, made = spark.read.parquet(f"{SF}/documents.parquet"), []
    made.append(("documents", docs))
    for name, stage in pipe.STAGES:
        stage(spark, docs, SF).write.parquet(str(out / name))
        docs = spark.read.parquet(str(out / name))
        made.append((name, docs))
    return made


def test_stages_keep_the_columns(stages):
    first = stages[0][1]
    for name, df in stages[1:-1]:
        assert df.columns == first.columns, name
        extra = df.exceptAll(first)
        assert extra.isEmpty(), name  # whole rows, none made up


def test_toxic_documents_go(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = stages[1][1].join(labels, "doc_id")
    all_ = stages[0][1].join(labels, "doc_id")
    bad, clean = (all_.where(F.col("toxic") == v).count() for v in (1, 0))
    assert kept.where("toxic = 0").count() >= 0.97 * clean
    assert bad == 0 or kept.where("toxic = 1").count() <= 0.6 * bad


def test_exact_copies(stages):
    before, after = ([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
                     for _, df in stages[1:3])
    last = {}
    for i, t in before:
        low = "".join(c.lower() if c.isascii() else c for c in t)
        last[low] = max(i, last.get(low, i))
    assert sorted(last.values()) == sorted(i for i, _ in after)


def test_near_copies(stages):
    before, after = ([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
                     for _, df in stages[2:4])
    label = slow_components([slow_fingerprint(t) for _, t in before])
    least = {}
    for (i, _), c in zip(before, label, strict=True):
        least[c] = min(i, least.get(c, i))
    assert sorted(least.values()) == sorted(i for i, _ in after)


def test_mixing_keeps_clean_documents(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    share = [df.join(labels, "doc_id").groupBy("quality").count().collect() for _, df in stages[3:5]]
    n = [{r["quality"]: r["count"] for r in s} for s in share]
    assert n[1][1] >= 0.9 * n[0][1] and n[1].get(0, 0) <= n[0].get(0, 0)


def test_encoding(stages):
    pairs = [(r["doc_id"], r["text"]) for r in stages[4][1].select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in stages[5][1].collect())
    assert got == sorted(encoded(pairs)) and np.all([g[1] > 0 for g in got])

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality, toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_toxicity_on_rows_it_never_saw(spark, corpus):
    docs, labels = corpus
    seen = labels.where("doc_id % 3 <> 0")
    model = toxicity.fit_toxicity(docs, seen)
    got = toxicity.score_toxicity(docs.join(labels.where("doc_id % 3 = 0").withColumnRenamed("toxic", "truth"), "doc_id"), model).toPandas()
    bad, clean = got[got["truth"] == 1], got[got["truth"] == 0]
    assert bad["toxic"].mean() > 0.75 and clean["toxic"].mean() < 0.02
    assert bad["expected_severity"].mean() > 5 * clean["expected_severity"].mean()
    assert got["expected_severity"].between(0, 3).all()


def test_thresholds_share_their_weights():
    texts = ["fine words here"] * 150 + ["a scum line"] * 50 + ["scum and idiot lines"] * 50 + ["scum idiot moron lines"] * 50
    model = toxicity.fit_ordinal([f"{t} w{i}" for i, t in enumerate(texts)], np.array([0] * 150 + [1] * 150))
    assert model.cuts == sorted(model.cuts)
    p = model.grades(np.array([model.score(t) for t in ("fine words", "scum", "scum idiot", "scum idiot moron")]))
    assert np.allclose(p.sum(1), 1)
    severity = p @ np.arange(4)
    assert (np.diff(severity) > 0).all()


def test_toxicity_of_odd_rows(spark, edge, empty, corpus):
    model = toxicity.fit_toxicity(*corpus)
    got = toxicity.score_toxicity(edge, model)
    assert got.columns == [*(c for c in edge.columns if c != "toxic"), "expected_severity", "severity", "toxic", "risk"]
    rows = got.collect()
    assert len(rows) == edge.count() and not any(r.toxic for r in rows)
    assert toxicity.score_toxicity(empty, model).count() == 0
    no_labels = spark.createDataFrame([(1, None), (None, 1), (7, 0)], "doc_id long, toxic int")
    assert not any(r.toxic for r in toxicity.score_toxicity(edge, toxicity.fit_toxicity(edge, no_labels)).collect())
    nothing = toxicity.fit_toxicity(empty, no_labels.limit(0))
    assert toxicity.score_toxicity(edge, nothing).count() == edge.count()


def test_quality_on_held_out_documents(corpus):
    docs, labels = corpus
    model = quality.fit_quality(docs, labels)
    got = quality.score_quality(docs, model).toPandas()
    assert len(got) == docs.count() and got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.3)).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    known = got[got["held_out"]].merge(labels.toPandas(), on="doc_id")
    assert (known["predicted"] == known["quality"]).mean() > 0.97


def test_held_out_labels_change_nothing(corpus):
    docs, labels = corpus
    docs, labels = docs.where("doc_id < 3000"), labels.where("doc_id < 3000")
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit_quality(docs, labels), quality.fit_quality(docs, flipped)
    assert np.allclose(a.weights, b.weights) and (a.scale, a.shift) == (b.scale, b.shift)


def test_risk_stays_non_negative():
    """With a prior far too high the estimate of the negative part would go below zero; the scores still separate."""
    draw = np.random.default_rng(2)
    good, bad = draw.normal(1, 1, (600, 2)), draw.normal(-1.5, 1, (600, 2))
    unlabelled = np.concatenate([good[300:], bad[:300]])
    model = quality.fit_pu(good[:300], unlabelled, 0.9, np.empty((0, 2)), np.empty(0, int))
    assert model.raw(good[300:]).mean() > model.raw(bad[300:]).mean() + 0.5


def test_quality_of_odd_rows(spark, edge, empty, corpus):
    model = quality.fit_quality(*corpus)
    rows = quality.score_quality(edge, model).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    assert len({r.score for r in rows if r.doc_id in (4, 5)}) == 1
    assert quality.score_quality(empty, model).count() == 0
    bare = quality.fit_quality(empty, spark.createDataFrame([], "doc_id long, quality int"))
    assert [r.score for r in quality.score_quality(edge.limit(1), bare).collect()] == [0.5]

"""Factorisation machine: the identity, held-out accuracy, awkward texts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ouzel.llm import quality as Q
from ouzel.llm.common import fold, table
from cases import AWKWARD

SF = "/root/testdata/sf0.01"


def test_sum_of_squares_identity():
    rng = np.random.default_rng(14)
    v = rng.normal(size=(Q.SIZE, Q.RANK))
    w = rng.normal(size=Q.SIZE)
    m = Q.Machine(0.3, w, v)
    idx, x = rng.choice(Q.SIZE, 30, replace=False), rng.normal(size=30)
    pairs = sum(v[idx[i]] @ v[idx[j]] * x[i] * x[j] for i in range(30) for j in range(i))
    assert m.raw(idx, x) == pytest.approx(0.3 + w[idx] @ x + pairs)


def test_gradient_steps_lower_the_loss():
    rng = np.random.default_rng(15)
    rows = [(rng.choice(200, 20, replace=False), np.ones(20) / 5, float(k % 2)) for k in range(60)]
    rows = [(np.append(i, 300 + int(y)), np.append(x, 1.0), y) for i, x, y in rows]
    m = Q.fit(rows)
    assert all((m.score(i, x) > 0.5) == (y > 0.5) for i, x, y in rows)


def test_held_out(spark):
    got = Q.op10_quality(spark, SF)
    labels = table(spark, SF, "labels").select("doc_id", "quality")
    held = got.join(labels, "doc_id").where("held_out")
    rows = held.collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert len(bad) > 3
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc > 0.95
    assert got.where(F.col("held_out") != (fold(F.col("doc_id")) == 0)).count() == 0
    assert got.where((F.col("score") >= 0.3) != (F.col("predicted") == 1)).count() == 0
    assert got.count() == got.select("doc_id").distinct().count() == 1000


def test_labels_of_the_held_out_fold_do_not_matter(spark, docs_of, words):
    docs = docs_of([" ".join(words[i % 50:i % 50 + 9]) + (" !!" * 9 if i % 3 else "") for i in range(60)])
    label = lambda flip: docs.select("doc_id", F.when(flip & (fold(F.col("doc_id")) == 0), 1.0).otherwise((F.col("doc_id") % 3 == 0).cast("double"))
                                     .alias("label")).where(fold(F.col("doc_id")) != 0)
    a, b = (Q.train(docs, label(F.lit(x))) for x in (True, False))
    assert a.w0 == b.w0 and (a.w == b.w).all() and (a.v == b.v).all()


def test_the_sample_bounds_rows(spark, docs_of, monkeypatch):
    """One row of each chosen document is learned from, whatever the order of its copies."""
    docs = docs_of(["good text"] * 3 + [f"row {i}" for i in range(300)]).withColumn("doc_id", F.when(F.col("doc_id") < 250, 1).otherwise(F.col("doc_id")))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("double").alias("label")).distinct()
    monkeypatch.setattr(Q, "fit", lambda rows, **kw: Q.Machine(float(len(rows)), np.zeros(Q.SIZE), np.zeros((Q.SIZE, Q.RANK))))
    assert labels.count() == 54
    assert [Q.train(docs, labels, sample=n).w0 for n in (1000, 20)] == [54.0, 20.0]
    monkeypatch.undo()
    a, b = (Q.train(d, labels) for d in (docs, docs.repartition(7, "text")))
    assert a.w0 == b.w0 and (a.w == b.w).all()


def test_metadata_is_a_feature(spark, docs_of):
    """Equal texts are told apart by their metadata; nulls and missing columns have a bin."""
    docs = docs_of(["same text"] * 200).withColumn("n_chars", F.when(F.col("doc_id") % 2 == 0, 10).when(F.col("doc_id") % 4 == 1, 100_000).cast("long"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2 == 0).cast("double").alias("label"))
    model = Q.train(docs, labels)
    got = {r.doc_id: r.q for r in Q.scored(docs, model, out="q").collect()}
    assert all((q > 0.5) == (i % 2 == 0) for i, q in got.items())
    assert Q.scored(docs.drop("n_chars"), model, out="q").where("q > 0.5").count() == 0
    assert [Q.meta_bin(v) for v in (None, -1, 0, 10, 1e12)] == [0, 1, 1, 4, Q.BINS - 1]
    with pytest.raises(ValueError):
        Q.train(docs, labels, meta=("a", "b", "c", "d", "e"))


def test_awkward_texts_and_missing_labels(spark, docs_of):
    docs = docs_of(AWKWARD)
    none = spark.createDataFrame([(0, None), (None, 1.0), (999, 1.0)], "doc_id long, label double")
    assert Q.train(docs, none) is None
    assert {r.q for r in Q.scored(docs, None, out="q").collect()} == {0.5}
    labels = spark.createDataFrame([(i, float(i % 2)) for i in range(len(AWKWARD))] * 2, "doc_id long, label double")
    out = Q.scored(docs, Q.train(docs, labels), out="q")
    assert out.columns == [*docs.columns, "q"] and out.where("q > 0 and q < 1").count() == len(AWKWARD)
    assert Q.scored(docs.limit(0), None).count() == 0

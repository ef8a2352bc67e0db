"""Nearest labelled examples against dense cosines, held-out accuracy, and odd inputs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowops.llm import toxicity as X
from flowops.llm.toxicity import toxicity


def entries(rng, n, terms, most):
    rows, cols, tf = [], [], []
    for r in range(n):
        own = np.sort(rng.choice(terms, rng.integers(0, most), replace=False))
        rows += [r] * len(own)
        cols += own.tolist()
        tf += rng.integers(1, 5, len(own)).tolist()
    return np.array(rows, np.int64), np.array(cols, np.int64), np.array(tf, np.int64)


def dense(rows, cols, weights, n, terms):
    out = np.zeros((n, terms))
    out[rows, cols] = weights
    return out


@pytest.mark.parametrize("seed", range(8))
def test_neighbours_are_exact(seed):
    rng = np.random.default_rng(seed)
    n_terms, n, m = 30, int(rng.integers(1, 400)), 120
    idf = rng.uniform(1, 5, n_terms)
    rows, cols, tf = entries(rng, n, n_terms, 8)
    labels = (rng.random(n) < 0.3).astype(float)
    model = X.fit(np.arange(n_terms, dtype=np.uint64), idf, list(range(n)), labels, rows, cols, tf)
    examples = dense(rows, cols, X.vectors(rows, cols, tf, idf, n), n, n_terms)[model.ids]
    q_rows, q_cols, q_tf = entries(rng, m, n_terms, 8)
    q_weights = X.vectors(q_rows, q_cols, q_tf, idf, m)
    found, cosine = X.neighbours(model, q_rows, q_cols, q_weights, m, X.NEIGHBOURS)
    every = dense(q_rows, q_cols, q_weights, m, n_terms) @ examples.T
    for q in range(m):
        order = np.lexsort((np.arange(len(examples)), -np.round(every[q], 12)))[: X.NEIGHBOURS]
        want = [k for k in order.tolist() if every[q, k] > 0]
        assert [k for k in found[q].tolist() if k >= 0] == want
        assert np.allclose(cosine[q, : len(want)], every[q, want])
    # each example's votes leave it out; scores are shares that do not fall with the vote
    assert np.all(np.diff(model.values) >= 0) and np.all((model.values >= 0) & (model.values <= 1))


def test_calibration_pools():
    steps, values = X.calibration(np.array([0.1, 0.1, 0.5, 0.6, 0.9, 0.9]), np.array([0, 1.0, 1, 0, 1, 1]), 0.5)
    assert np.all(np.diff(steps) > 0) and np.all(np.diff(values) > 0)
    assert len(steps) == 2


def corpus(spark, n=1500):
    rnd = random.Random(5)
    rows, labels = [], []
    for k in range(n):
        words = [f"w{rnd.randrange(3000)}" for _ in range(rnd.choice([0, 5, 60, 200]))]
        toxic = rnd.random() < 0.15
        if toxic:
            for _ in range(3):
                words.insert(rnd.randint(0, len(words)), rnd.choice(["scum", "LOSER!", "idiot.", "trash"]))
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy_and_evidence(spark):
    docs, labels = corpus(spark)
    scored = toxicity(docs, labels.where("doc_id % 3 > 0"), ["doc_id", "text"]).join(labels, "doc_id")
    wrong = 0
    for row in scored.where("doc_id % 3 = 0").collect():
        assert 0.0 <= row["score"] <= 1.0
        wrong += (row["score"] >= 0.5) != (row["toxic"] == 1)
        near = row["evidence"]
        assert all(a["cosine"] >= b["cosine"] for a, b in zip(near, near[1:], strict=False))
        assert all(e["id"] % 3 > 0 for e in near)
    assert wrong <= 5


def test_sample_is_bounded_and_repeatable(spark):
    docs, labels = corpus(spark, 400)
    runs = [{r["doc_id"]: r["score"] for r in toxicity(d, labels, ["doc_id"], limit=150).collect()} for d in (docs, docs.repartition(7))]
    assert runs[0] == pytest.approx(runs[1])
    near = toxicity(docs, labels, ["doc_id"], limit=150).select(F.explode("evidence.id").alias("id")).distinct().count()
    assert near <= 150


def test_odd_inputs(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, None), (5, 0), (7, 1), (7, 0), (None, 1), (8, 2), (99, 1)], "doc_id long, toxic int")
    labels = labels.selectExpr("*", "'x' AS label", "1 AS text", "2 AS example")
    got = toxicity(odd_docs, labels, ["doc_id", "text"]).collect()
    assert len(got) == odd_docs.count()
    assert all(0 <= r["score"] <= 1 for r in got)
    # without labels, or without terms that tell them apart, every text gets the mean
    assert {r["score"] for r in toxicity(odd_docs, labels.where("false"), ["doc_id"]).collect()} == {0.0}
    empty = toxicity(no_docs, labels, ["doc_id"])
    assert empty.columns == ["doc_id", "score", "evidence"] and empty.count() == 0


def test_terms_are_counted_where_they_lie(spark):
    """Rows that share their terms are counted in their tasks: nothing is made per row and term."""
    from flowops.llm.toxicity import document_frequencies

    rows = spark.createDataFrame([([0, 2, 3],)] * 500 + [([],), ([3],)], "terms array<int>").repartition(3)
    assert document_frequencies(rows, 5).tolist() == [500, 0, 500, 501, 0]
    assert document_frequencies(rows.where("false"), 2).tolist() == [0, 0]

"""Positive-unlabelled learning: held-out accuracy on planted words, bounds, edge rows."""

import random
import zlib

import numpy as np
import pytest

from foliant.llm.toxicity import fit, toxicity, train, training_sample


def planted(n=900):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 60))]
        toxic = i % 8 == 0
        if toxic:
            text += rng.sample(["zzidiot", "zzmoron", "xxscum"], 2)
        rows.append((i, " ".join(text)))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = planted()
    rows += [(None, None), (5000, ""), (5001, "12 34"), (0, rows[0][1])]
    labels += [(0, 1), (0, None), (7000, 1), (None, 1)]
    docs = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, score int")
    told = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity(docs, told).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert np.mean([r.predicted == (r.doc_id % 8 == 0) for r in held]) > 0.97
    assert [r.score for r in toxicity(docs.repartition(3), told).orderBy("doc_id").collect()] == pytest.approx([r.score for r in sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id))])


def test_held_out_labels_do_not_matter(spark):
    rows, labels = planted(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    schema = "doc_id long, toxic int"
    a, b = fit(docs, spark.createDataFrame(labels, schema)), fit(docs, spark.createDataFrame(flipped, schema))
    assert a == b and a[0]


def test_bounds_and_nothing_to_learn(spark):
    rows, labels = planted(300)
    docs, told = spark.createDataFrame(rows * 2, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    sample = training_sample(docs, told, 5, 11).collect()
    assert sum(r.positive for r in sample) == 5 and len(sample) == 16
    assert {r.score for r in toxicity(docs, told.limit(0)).collect()} == {0.0}
    assert toxicity(docs.limit(0), told).count() == 0


def test_risk_does_not_go_below_zero():
    # With a prior far too large the plain estimator would run away; weights stay finite.
    p = [np.array([1, 2])] * 20
    theta, bias = train(p, p, 0.9, epochs=30)
    assert np.isfinite(theta).all() and abs(theta[:3]).max() < 20 and abs(bias) < 20

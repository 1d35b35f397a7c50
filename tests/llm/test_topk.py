"""Exact top-k against brute force."""

import math
import random

import numpy as np
import pytest

from foliant.llm.topk import Block, top_k


@pytest.mark.parametrize("seed", range(20))
def test_block(seed):
    rng = np.random.default_rng(seed)
    n, width, span = int(rng.integers(1, 300)), int(rng.integers(1, 20)), int(rng.choice([1, 2, 60, 3000]))
    rows = rng.integers(-span, span + 1, (n, width))
    rows[rng.random(n) < 0.3] = rows[0]
    block = Block(rows)
    for q in rng.integers(-span, span + 1, (5, width)):
        for without in (None, int(rng.integers(0, n))):
            want = sorted(((-int(rows[i] @ q), i) for i in range(n) if i != without))[:20]
            places, scores = block.top(q, 20, without)
            assert sorted(zip((-scores).tolist(), places.tolist())) == want


def brute(rows):
    kept = [(i, v, [math.floor(64 * float(np.float32(x))) for x in e]) for i, (v, e) in enumerate(rows) if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, v, e in kept:
        if v is None or v % 20:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(e, f)), w is None, w or 0) for j, w, f in kept if j != i))[:20]
        out += [(v, r, None if none else w, -s) for r, (s, none, w) in enumerate(scored, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [7, 50, 10_000])
def test_vectors(spark, block):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(120)]
    rows += [(i, [0.5, 0.25, -0.5]) for i in range(200, 260)] + [(None, [1.0] * 6), (None, [1.0] * 6), (20, [0.1] * 6), (20, [0.1] * 6)]
    rows += [(300, None), (320, [float("nan")] * 6), (340, [float("inf")] + [0.0] * 5), (360, [None] * 6), (380, [])]
    df = spark.createDataFrame([(v, e, "x") for v, e in rows], "vec_id long, embedding array<float>, score string")
    got = sorted((tuple(r) for r in top_k(df.repartition(3), block=block).collect()), key=str)
    assert got == brute(rows)


def test_fewer_than_k_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in top_k(df).collect()] == [(0, 1, 1, 64 * 128)]
    assert top_k(df.where("vec_id = 0")).count() == 0
    assert top_k(df.limit(0)).count() == 0


def test_large_components(spark):
    kind = "vec_id long, embedding array<double>"
    far = [(0, [1.0, 1.0]), (1, [2.0**36, 1.0]), (2, [2.0**48, -1.0]), (3, [-(2.0**48), 0.0]), (4, [2.0**36, 0.0])]
    got = [tuple(r) for r in top_k(spark.createDataFrame(far, kind)).orderBy("rank").collect()]
    assert got == [(0, 1, 2, 64 * (2**54 - 64)), (0, 2, 1, 64 * (2**42 + 64)), (0, 3, 4, 64 * 2**42), (0, 4, 3, -64 * 2**54)]
    with pytest.raises(Exception, match="64 bits"):
        top_k(spark.createDataFrame([(0, [2.0**40]), (1, [2.0**40])], kind)).collect()
    with pytest.raises(Exception, match="64 bits"):
        top_k(spark.createDataFrame([(0, [1.0]), (1, [2.0**60])], kind)).collect()

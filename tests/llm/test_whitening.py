"""The incremental spectrum against a plain one, the query against brute force."""

import math

import numpy as np
import pytest

from foliant.llm.whitening import add, combine, nothing, rank_one, spectrum, whiten, whole

SCHEMA = "vec_id long, embedding array<float>, component string"


def scatter(s):
    return s.vectors @ np.diag(s.values) @ s.vectors.T


@pytest.mark.parametrize("seed", range(25))
def test_rank_one(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 40))
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    d = np.sort(rng.choice([0.0, 1.0, 1.0 + 1e-15, 1.0 + 1e-9, 5.0, 1e6], n) if seed % 2 else np.abs(rng.normal(size=n)))
    v = rng.normal(size=n) * 10.0 ** rng.integers(-6, 6)
    if seed % 3 == 0:
        v = q[:, 0] * 3
    values, vectors = rank_one(d, q, v, 0.7)
    want = q @ np.diag(d) @ q.T + 0.7 * np.outer(v, v)
    size = np.abs(want).max() + 1e-300
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-12
    assert np.abs(vectors @ np.diag(values) @ vectors.T - want).max() / size < 1e-12
    assert np.abs(values - np.linalg.eigvalsh(want)).max() / size < 1e-12 * n


@pytest.mark.parametrize("seed", range(8))
def test_spectrum_of_rows(seed):
    rng = np.random.default_rng(seed)
    n, width = int(rng.integers(2, 200)), int(rng.integers(1, 12))
    rows = rng.integers(-64, 64, (n, width)).astype(float)
    rows[:, -1] = rows[:, 0]
    rows[rng.random(n) < 0.4] = rows[0]
    cut = n // 3
    a, b = nothing(width), nothing(width)
    for r in rows[:cut]:
        a = add(a, r)
    for r in rows[cut:]:
        b = add(b, r)
    s = combine(a, b)
    want = (rows - rows.mean(0)).T @ (rows - rows.mean(0))
    assert s.n == n and np.allclose(s.mean, rows.mean(0))
    assert np.abs(scatter(s) - want).max() <= 1e-9 * max(np.abs(want).max(), 1)
    three = add(nothing(width), rows[0], 3.0)
    assert np.allclose(scatter(three), 0) and three.n == 3


def brute(rows, k=32):
    kept = [(v, e) for v, e in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    width = max((len(e) for _, e in kept), default=0)
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in e] + [1_000_000] * (width - len(e)) for _, e in kept]
    n, total = len(x), [sum(c) for c in zip(*x)]
    t = [[n * a - s for a, s in zip(r, total)] for r in x]
    c = np.array(t, float) / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return [i for i, _ in kept], n, [sum(a * a for a in r) for r in t], c @ u / np.sqrt(e), e / np.trace(v), v


def test_query(spark):
    rng = np.random.default_rng(3)
    made = rng.normal(size=(300, 40)) * np.linspace(0.2, 3, 40)
    rows = [(i, r.tolist()) for i, r in enumerate(made)] + [(5, made[5].tolist())] * 90 + [(None, made[7].tolist()), (900, [0.5] * 3)]
    rows += [(901, None), (902, [float("nan")] * 40), (903, [float("inf")] + [0.0] * 39), (904, [None] * 40), (905, [])]
    df = spark.createDataFrame([(v, e, "x") for v, e in rows], SCHEMA).repartition(11)
    got = whiten(df).collect()
    ids, n, deviation, white, explained, _ = brute(rows)
    assert len(got) == 32 * len(ids) and {r["n"] for r in got} == {n}
    assert got[0]["identity_error"] < 1e-9
    sign = {}
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    for i, v in enumerate(ids):
        for j in range(32):
            found = by[v, j + 1]
            if len(found) == 1 and j not in sign and abs(white[i, j]) > 0.1:
                sign[j] = np.sign(found[0]["whitened"] * white[i, j])
    for i, v in enumerate(ids):
        for j in range(32):
            for r in by[v, j + 1]:
                assert abs(r["whitened"] * sign[j] - white[i, j]) < 1e-9
                assert r["deviation"] == deviation[i]
                assert abs(r["explained"] / explained[j] - 1) < 1e-9


def test_spark_spectrum_needs_little_refinement(spark):
    rng = np.random.default_rng(8)
    made = rng.normal(size=(500, 16))
    df = spark.createDataFrame([(i, r.tolist(), "") for i, r in enumerate(made)], SCHEMA).repartition(20)
    rows = whole(df).cache()
    s = spectrum(rows, 16, fan=3)
    y = np.floor(64 * made.astype(np.float32).astype(float))
    want = np.linalg.eigvalsh((y - y.mean(0)).T @ (y - y.mean(0)))
    assert s.n == 500 and np.abs(s.values / want - 1).max() < 1e-10


def test_no_variance_and_few(spark):
    make = lambda rows: spark.createDataFrame(rows, SCHEMA)
    assert whiten(make([])).collect() == []
    assert whiten(make([(1, [1.0, 2.0], "")])).collect() == []
    assert whiten(make([(1, [1.0, 2.0], "")] * 5)).collect() == []
    assert whiten(make([(1, [], ""), (2, None, "")])).collect() == []
    got = whiten(make([(1, [1.0, 2.0], ""), (2, [1.0, 3.0], ""), (3, [1.0, 7.0], "")])).collect()
    assert [(r["vec_id"], r["component"]) for r in sorted(got)] == [(1, 1), (2, 1), (3, 1)]
    assert all(abs(r["explained"] - 1) < 1e-12 for r in got)
    assert sorted(r["deviation"] for r in got) == [(3 * 64) ** 2, (6 * 64) ** 2, (9 * 64) ** 2]


def test_large_numbers(spark):
    rows = [(i, [float(x)]) for i, x in enumerate([-(2.0**40), 0.0, 2.0**40])]
    df = spark.createDataFrame([(v, e, "") for v, e in rows], "vec_id long, embedding array<double>, component string")
    assert {r["deviation"] for r in whiten(df).collect()} == {None, 0}
    with pytest.raises(Exception, match="too large"):
        whiten(spark.createDataFrame([(1, [1e300], "")], "vec_id long, embedding array<double>, component string")).collect()

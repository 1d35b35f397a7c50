"""Whitening of embeddings by an incremental eigendecomposition.

Components become whole numbers, x = floor(64 c) + 1,000,000. Every task keeps the count,
the mean and the complete spectrum (all eigenpairs of the centred scatter) of the vectors
it has seen. A vector changes the scatter by a matrix of rank one, so its spectrum follows
from the secular equation 1 + rho sum(z_i^2 / (d_i - t)) = 0: one root between each two
neighbouring old eigenvalues, all roots found at once by safeguarded iteration. Entries of
z that vanish and eigenvalues that coincide are deflated first, and the eigenvectors are
formed from the z that fits the computed roots exactly, which keeps them orthogonal. Equal
vectors of a batch make one update of their number. Spectra of tasks are combined, a few
at a time, by the same update: one for each eigenpair of the other spectrum and one for
the distance of the means. What rounding has left is removed at last: the basis is made
orthonormal, the covariance of the vectors projected on it is summed up over all rows on
Spark, and that small matrix is rotated to its own axes (Rayleigh-Ritz).

A spectrum takes width^2 numbers; it and the projected matrix, both bounded by the width of
the vectors and not by their number, are all that comes to the driver.

Defined results: vectors that are NULL or hold NULL or non-finite components take no part;
shorter vectors are filled up with c = 0; directions without variance are no components, so
equal vectors only, a single vector or an empty table give an empty result; eigenvalues
that coincide span the same space in any rotation; repeated rows and NULL vec_ids are rows
of their own; a deviation beyond 64 bits is NULL; components whose floor(64 c) leaves
+-2^51, where doubles end to count by ones, raise an error; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foliant.llm.common import materialize

SCALE, COMPONENTS = 64, 32
# Spectra that one task combines.
FAN = 8
EPS = np.finfo(np.float64).eps


class Spectrum(NamedTuple):
    """Count, mean, and the scatter as ``vectors @ diag(values) @ vectors.T``, values ascending."""

    n: float
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray


def nothing(width: int) -> Spectrum:
    return Spectrum(0.0, np.zeros(width), np.zeros(width), np.eye(width))


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho sum(z^2 / (d - t)) with d strictly ascending, z without zeros, rho > 0.

    A root is returned as the place of its nearest pole and the distance from it, which
    keeps differences between poles and roots exact to the last digits.
    """
    m = len(d)
    weight = rho * z * z
    gap = np.append(np.diff(d), weight.sum())
    # The sign halfway tells which end of its interval a root is nearer to.
    middle = d + gap / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        half = 1 + (weight / (d - middle[:, None])).sum(axis=1)
    near = np.where(half >= 0, np.arange(m), np.minimum(np.arange(m) + 1, m - 1))
    near[-1] = m - 1
    poles = d - d[near][:, None]
    below = near == np.arange(m)
    low = np.where(below, 0.0, -gap / 2)
    high = np.where(below, gap / 2, 0.0)
    if half[-1] < 0:
        low[-1], high[-1] = gap[-1] / 2, gap[-1]
    t = (low + high) / 2
    at = np.arange(m)
    other = np.where(below, np.minimum(at + 1, m - 1), at)
    far = poles[at, other]
    far[-1] = np.inf
    open_ = np.arange(m)
    for _ in range(80):
        u, left = t[open_], poles[open_]
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            inverse = 1 / (left - u[:, None])
            parts = weight * inverse
            f, size = 1 + parts.sum(axis=1), 1 + np.abs(parts).sum(axis=1)
            slope = (parts * inverse).sum(axis=1)
            rising = f > 0
            high[open_], low[open_] = np.where(rising, u, high[open_]), np.where(rising, low[open_], u)
            # Newton on f t (far - t): without its two poles the function is nearly straight.
            step = u - f / (slope + f / u - f / (far[open_] - u))
        good = np.isfinite(step) & (step > low[open_]) & (step < high[open_])
        new = np.where(good, step, (low[open_] + high[open_]) / 2)
        # No digit of f is left, or none of the root changes.
        still = (np.abs(f) > 4 * EPS * size) & (np.abs(new - u) > 4 * EPS * np.abs(u))
        t[open_] = np.where(np.abs(f) > 4 * EPS * size, new, u)
        open_ = open_[still]
        if not len(open_):
            break
    # A root never sits on its pole.
    tiny = np.finfo(np.float64).tiny
    return near, np.where(t == 0, np.where(below, tiny, -tiny), t)


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """The spectrum of ``vectors @ diag(values) @ vectors.T + rho v v^T``, rho >= 0."""
    z = v @ vectors
    norm = float(z @ z)
    if rho <= 0 or norm == 0:
        return values, vectors
    z, rho = z / np.sqrt(norm), rho * norm
    size = max(abs(values[-1]), rho)
    tolerance = 8 * EPS * size
    live = rho * np.abs(z) > tolerance
    # Of eigenvalues that coincide only one takes part: a rotation gives it all of z.
    same = np.flatnonzero(live)
    if len(same) > 1 and (np.diff(values[same]) <= tolerance).any():
        vectors, z, live = vectors.copy(), z.copy(), live.copy()
        keep = same[0]
        for j in same[1:]:
            if values[j] - values[keep] <= tolerance:
                r = np.hypot(z[keep], z[j])
                c, s = z[j] / r, z[keep] / r
                a, b = vectors[:, keep].copy(), vectors[:, j].copy()
                vectors[:, keep], vectors[:, j] = c * a - s * b, s * a + c * b
                z[keep], z[j], live[keep] = 0.0, r, False
            keep = j
    on = np.flatnonzero(live)
    if not len(on):
        return values, vectors
    d, w = values[on], z[on]
    near, t = secular_roots(d, w, rho)
    # distance[i, j]: root i less pole j.
    distance = (d[near][:, None] - d) + t[:, None]
    # The z that has exactly these roots: rho z_j^2 is a product of ratios.
    gaps = d - d[:, None]
    np.fill_diagonal(gaps, 1.0)
    fitted = np.copysign(np.sqrt(np.abs(np.prod(distance.T / gaps, axis=1)) / rho), w)
    rotation = fitted / -distance
    rotation /= np.linalg.norm(rotation, axis=1)[:, None]
    new_values, new_vectors = values.copy(), vectors.copy()
    new_values[on] = d[near] + t
    new_vectors[:, on] = vectors[:, on] @ rotation.T
    order = np.argsort(new_values, kind="stable")
    return new_values[order], new_vectors[:, order]


def add(s: Spectrum, row: np.ndarray, times: float = 1.0) -> Spectrum:
    """``s`` with ``times`` copies of one more vector."""
    delta, n = row - s.mean, s.n + times
    values, vectors = rank_one(s.values, s.vectors, delta, s.n * times / n)
    return Spectrum(n, s.mean + delta * (times / n), values, vectors)


def combine(a: Spectrum, b: Spectrum) -> Spectrum:
    """The spectrum of all vectors of both."""
    if a.n < b.n:
        a, b = b, a
    if not b.n:
        return a
    values, vectors, n, delta = a.values, a.vectors, a.n + b.n, b.mean - a.mean
    for value, vector in zip(b.values, b.vectors.T):
        values, vectors = rank_one(values, vectors, vector, max(value, 0.0))
    values, vectors = rank_one(values, vectors, delta, a.n * b.n / n)
    return Spectrum(n, a.mean + delta * (b.n / n), values, vectors)


def whole(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``_y``, floor(scale c), of the vectors that take part."""
    finite = F.forall("embedding", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) != float("inf")), F.lit(False)))
    kept = vectors.where(F.col("embedding").isNotNull() & finite)
    bound = float(1 << 51)

    def entry(c):
        y = F.floor(c.cast("double") * scale)
        far = F.raise_error(F.lit("a component of an embedding is too large")).cast("bigint")
        return F.when(F.abs(c.cast("double") * scale) < bound, y.cast("bigint")).otherwise(far)

    return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform("embedding", entry).alias("_y"))


def _rows(batch: pa.RecordBatch, width: int, at: int = 0) -> np.ndarray:
    """The lists of a column as rows of whole numbers, zeros where one is shorter."""
    lists = batch.column(at)
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


STATE = "part bigint, n double, mean binary, vals binary, vecs binary"


def _packed(part: int, s: Spectrum) -> dict:
    return {"part": part, "n": s.n, "mean": s.mean.tobytes(), "vals": s.values.tobytes(), "vecs": np.ascontiguousarray(s.vectors).tobytes()}


def _unpacked(row, width: int) -> Spectrum:
    take = lambda b: np.frombuffer(b, np.float64).copy()
    return Spectrum(row["n"], take(row["mean"]), take(row["vals"]), take(row["vecs"]).reshape(width, width))


def spectrum(rows: DataFrame, width: int, fan: int = FAN) -> Spectrum:
    """The spectrum of all ``_y`` of a written table, from one per task."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        s = nothing(width)
        for batch in batches:
            found, times = np.unique(_rows(batch, width), axis=0, return_counts=True)
            for row, n in zip(found.astype(np.float64), times.tolist()):
                s = add(s, row, float(n))
        if s.n:
            yield pa.RecordBatch.from_pylist([_packed(TaskContext.get().partitionId(), s)])

    def together(pdf: pd.DataFrame) -> pd.DataFrame:
        s = nothing(width)
        for _, row in pdf.sort_values("part").iterrows():
            s = combine(s, _unpacked(row, width))
        return pd.DataFrame([_packed(int(pdf["part"].iloc[0]) // fan, s)])

    states = materialize(rows.select("_y").mapInArrow(per_task, STATE), "spectra")
    while (last := states.agg(F.max("part")).head()[0]) is not None and last > 0:
        grouped = states.groupBy(F.floor(F.col("part") / fan).alias("_group")).applyInPandas(together, STATE)
        states = materialize(grouped, "spectra")
    found = states.head()
    return _unpacked(found, width) if found else nothing(width)


def _projected(rows: DataFrame, width: int, total: list[int], n: int, basis: np.ndarray) -> np.ndarray:
    """The covariance of the centred rows times ``basis``, summed up on Spark."""
    k = basis.shape[1]
    upper = np.triu_indices(k)
    whole_part = [t // n for t in total]
    rest = np.array([(t - w * n) / n for t, w in zip(total, whole_part)])
    base = np.array(whole_part, np.int64)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moment, sums = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            p = ((_rows(batch, width) - base).astype(np.float64) - rest) @ basis
            moment += p.T @ p
            sums += p.sum(axis=0)
        # The sums travel beside the moments, in a column -1.
        i, j = np.concatenate([upper[0], np.arange(k)]), np.concatenate([upper[1], np.full(k, -1)])
        found = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.concatenate([moment[upper], sums]))]
        yield pa.RecordBatch.from_arrays(found, ["i", "j", "value"])

    summed = rows.select("_y").mapInArrow(per_task, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    out, sums = np.zeros((k, k)), np.zeros(k)
    for r in summed.collect():
        if r["j"] < 0:
            sums[r["i"]] = r["value"]
        else:
            out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["value"]
    mean = sums / n
    return out / n - np.outer(mean, mean)


class Whitener(NamedTuple):
    """What turns a vector into its whitened components."""

    n: int
    total: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """The components of the written table ``rows`` (``whole``); None if there are none."""
    width = rows.agg(F.max(F.size("_y"))).head()[0] or 0
    n = rows.count()
    if not width or not n:
        return None
    sums = {r["at"]: int(r["s"]) for r in rows.select(F.posexplode("_y").alias("at", "y")).groupBy("at").agg(F.sum(F.col("y").cast("decimal(38,0)")).alias("s")).collect()}
    total = [sums.get(i, 0) for i in range(width)]
    basis, _ = np.linalg.qr(spectrum(rows, width).vectors[:, ::-1])
    covariance = _projected(rows, width, total, n, basis)
    values, turn = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")
    # What rounding leaves of a direction without variance is no component.
    real = values[order] > max(values[order[0]], 0.0) * width * 64 * EPS
    order = order[real][:components]
    if not len(order):
        return None
    axes = basis @ turn[:, order]
    axes /= np.linalg.norm(axes, axis=0)
    values, trace = values[order], float(np.trace(covariance))
    white = _projected(rows, width, total, n, axes / np.sqrt(values))
    return Whitener(n, total, axes, values, trace, float(np.abs(white - np.eye(len(order))).max()))


OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def transform(rows: DataFrame, w: Whitener) -> DataFrame:
    """One row per row of ``rows`` and component."""
    width, k = w.components.shape
    whole_part = [t // w.n for t in w.total]
    base, rest = np.array(whole_part, np.int64), np.array([t - b * w.n for t, b in zip(w.total, whole_part)], object)
    fraction = np.array([r / w.n for r in rest])
    axes, explained = w.components / np.sqrt(w.values), w.values / w.trace

    def deviations(y: np.ndarray) -> list[int | None]:
        """sum((n x - S)^2) per row, exactly: in 64 bits where they do, else in whole numbers of any size."""
        far = int(np.abs(y).max(initial=0)) + 1
        if (far * w.n) ** 2 * width < 2**63:
            t = y * w.n - rest.astype(np.int64)
            return (t * t).sum(axis=1).tolist()
        exact = [int(x) for x in ((y.astype(object) * w.n - rest) ** 2).sum(axis=1)]
        return [x if x < 2**63 else None for x in exact]

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                y = _rows(part, width, 1) - base
                white = (y.astype(np.float64) - fraction) @ axes
                again = np.repeat(np.arange(len(part)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(again)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(part))),
                        pa.array(np.full(len(again), w.n, np.int64)),
                        pa.array(deviations(y), pa.int64()).take(pa.array(again)),
                        pa.array(white.reshape(-1)),
                        pa.array(np.tile(explained, len(part))),
                        pa.array(np.full(len(again), w.identity_error)),
                    ],
                    [c.split()[0] for c in OUT.split(", ")],
                )

    return rows.select("vec_id", "_y").mapInArrow(per_task, OUT)


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    The shift to x moves the mean alone; it cancels in every result and is left out.
    """
    rows = materialize(whole(vectors, scale), "whole-vectors")
    fitted = fit(rows, components)
    return transform(rows, fitted) if fitted else vectors.sparkSession.createDataFrame([], OUT)

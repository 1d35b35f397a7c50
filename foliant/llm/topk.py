"""Exact top-k inner products from a bit-sliced index.

Components are quantised to whole numbers, floor(64 x). The rows are dealt out evenly
into blocks; in a block every bit of every component is a bitmap over the block's rows
(a slice). For a query the slices that the bits of its weights select are added with
bitmap arithmetic alone: three bitmaps of one weight become one of the same weight and
one carry, until each weight has one bitmap left. Those are the score's slices. The top
rows are selected from the most significant slice down; the rows on the boundary, which
tie, are resolved by vec_id, and the scores of the rows selected are computed exactly.

Blocks meet the queries by a key of their own: a task holds one block and streams the
queries past it. The best k of each block are cut to the best k of all by a window.

Defined results: vectors that are NULL or hold NULL or non-finite components take no part;
shorter vectors are filled up with zeros; quantised components and scores must fit 64
bits, else the query raises an error; rows that repeat a vec_id are candidates and queries of their own, and a query's
own row only is left out; a NULL vec_id is a candidate that loses every tie and no
query; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from foliant.llm.common import materialize

SCALE, EVERY, K, BLOCK = 64, 20, 20, 8192


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``_row``, ``vec_id`` and whole components ``_v`` of the vectors that take part."""
    def entry(x: Column) -> Column:
        far = F.raise_error(F.lit("a component of an embedding leaves 64 bits")).cast("bigint")
        return F.when(F.abs(x.cast("double") * scale) < 2.0**63, F.floor(x.cast("double") * scale).cast("bigint")).otherwise(far)

    whole = F.transform("embedding", entry)
    finite = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")), F.lit(False)))
    kept = vectors.where(F.col("embedding").isNotNull() & finite)
    return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("_v")).withColumn("_row", F.monotonically_increasing_id())


class Block:
    """The slices of up to a few thousand rows. ``rows``: whole numbers, one row each, ordered by vec_id."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.n, self.width = rows.shape
        self.least = rows.min(axis=0) if self.n else np.zeros(self.width, np.int64)
        above = (rows - self.least).astype(np.uint64)
        self.bits = max(1, int(above.max(initial=0)).bit_length())
        self.words = -(-self.n // 64)
        padded = np.zeros((self.words * 64, self.width), np.uint64)
        padded[: self.n] = above
        slices = np.empty((2, self.width, self.bits, self.words), np.uint64)
        for j in range(self.bits):
            bit = ((padded >> np.uint64(j)) & np.uint64(1)).astype(np.uint8)
            slices[0, :, j] = np.ascontiguousarray(np.packbits(bit.T, axis=1, bitorder="little")).view(np.uint64)
        # A negative weight takes the complement: -w v = w (2^bits - 1 - v) - w (2^bits - 1).
        slices[1] = ~slices[0]
        self.slices = slices.reshape(2 * self.width * self.bits, self.words)
        self.all = np.zeros(self.words * 64, np.uint8)
        self.all[: self.n] = 1
        self.all = np.packbits(self.all, bitorder="little").view(np.uint64)

    def add(self, weights: np.ndarray) -> list[np.ndarray | None]:
        """The slices of sum(|w| x slice), least significant first."""
        size = np.abs(weights).astype(np.uint64)
        sign = (weights < 0).astype(np.int64)
        levels: dict[int, list[np.ndarray]] = {}
        base = (sign * self.width + np.arange(self.width)) * self.bits
        for i in range(int(size.max(initial=0)).bit_length()):
            on = base[(size >> np.uint64(i)) & np.uint64(1) == 1]
            if len(on):
                for j in range(self.bits):
                    levels.setdefault(i + j, []).append(self.slices[on + j])
        sums: list[np.ndarray | None] = []
        at, top = 0, max(levels, default=-1)
        while at <= top:
            parts = levels.pop(at, [])
            x = np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else None
            while x is not None and len(x) > 1:
                if len(x) == 2:
                    carry, x = x[:1] & x[1:], x[:1] ^ x[1:]
                else:
                    m = len(x) // 3
                    a, b, c = x[:m], x[m : 2 * m], x[2 * m : 3 * m]
                    half = a ^ b
                    carry = (a & b) | (c & half)
                    x = np.concatenate([half ^ c, x[3 * m :]])
                levels.setdefault(at + 1, []).append(carry)
                top = max(top, at + 1)
            sums.append(x[0] if x is not None else None)
            at += 1
        return sums

    def top(self, weights: np.ndarray, k: int, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` best rows, the first ones on ties."""
        sure, open_ = np.zeros(self.words, np.uint64), self.all.copy()
        if without is not None:
            open_[without // 64] &= ~(np.uint64(1) << np.uint64(without % 64))
        found = 0
        if int(np.bitwise_count(open_).sum()) > k:
            for s in reversed(self.add(weights)):
                if s is None:
                    continue
                high = open_ & s
                n = int(np.bitwise_count(high).sum())
                if found + n > k:
                    open_ = high
                else:
                    sure, open_, found = sure | high, open_ & ~s, found + n
                    if found == k:
                        break
        places = self._places(sure)
        if found < k:
            places = np.concatenate([places, self._places(open_)[: k - found]])
        return places, self._scores(places, weights)

    def _scores(self, places: np.ndarray, weights: np.ndarray) -> np.ndarray:
        rows = self.rows[places]
        if (np.abs(rows.astype(np.float64)) @ np.abs(weights.astype(np.float64))).max(initial=0) < 2.0**62:
            return rows @ weights
        # Near the end of 64 bits in numbers without one.
        exact = [int(x) for x in rows.astype(object) @ weights.astype(object)]
        if any(not -(2**63) <= x < 2**63 for x in exact):
            raise OverflowError("a score leaves 64 bits")
        return np.array(exact, np.int64)

    def _places(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


FOUND = "query_row bigint, query_id bigint, row bigint, vec_id bigint, score bigint"


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Rows of equal width, zeros where a list is shorter; longer ones make it wider."""
    sizes = np.diff(lists.offsets.to_numpy())
    width = max(width, int(sizes.max(initial=0)))
    out = np.zeros((len(lists), width), np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in FOUND.split(", ")]
        group, parts, block, ids, rows = None, [], None, None, None

        def build():
            width = max((p[2].shape[1] for p in parts), default=0)
            matrix = np.zeros((sum(len(p[0]) for p in parts), width), np.int64)
            at = 0
            for p in parts:
                matrix[at : at + len(p[0]), : p[2].shape[1]] = p[2]
                at += len(p[0])
            own, number = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            order = np.lexsort([own, number])
            return Block(matrix[order]), number[order], own[order]

        for batch in batches:
            groups, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            own = batch.column(2).to_numpy()
            # A NULL vec_id sorts behind all others.
            number = np.array([2**63 - 1 if x is None else x for x in batch.column(3).to_pylist()], np.int64)
            matrix = _matrix(batch.column(4), 0)
            out: list[list[np.ndarray]] = []
            cuts = [0, *(np.flatnonzero((groups[1:] != groups[:-1]) | (kinds[1:] != kinds[:-1])) + 1).tolist(), len(groups)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if groups[a] != group:
                    group, parts, block = groups[a], [], None
                if kinds[a] == 0:
                    parts.append((own[a:b], number[a:b], matrix[a:b]))
                    continue
                if not parts:
                    continue
                if block is None:
                    block, ids, rows = build()
                    place = {r: i for i, r in enumerate(rows.tolist())}
                wide = np.zeros((b - a, max(block.width, matrix.shape[1])), np.int64)
                wide[:, : matrix.shape[1]] = matrix[a:b]
                for q, q_id, weights in zip(own[a:b].tolist(), number[a:b].tolist(), wide[:, : block.width]):
                    places, scores = block.top(weights, k, place.get(q))
                    n = len(places)
                    out.append([np.full(n, q), np.full(n, q_id), rows[places], ids[places], scores])
            if out:
                columns = [np.concatenate(c) for c in zip(*out)]
                arrays = [pa.array(c, pa.int64()) for c in columns]
                arrays[3] = pa.array(columns[3], pa.int64(), mask=columns[3] == 2**63 - 1)
                yield pa.RecordBatch.from_arrays(arrays, names)

    return search


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, block: int = BLOCK, scale: int = SCALE) -> DataFrame:
    """Per query, the rows whose vec_id is divisible by ``every``: query_id, rank, vec_id, score."""
    rows = materialize(quantised(vectors, scale), "quantised")
    n_blocks = max(1, -(-rows.count() // block))
    # Places, not values, decide the block: equal vectors spread evenly.
    place = F.pmod(F.xxhash64("_row"), F.lit(n_blocks)).cast("int")
    candidates = rows.select(place.alias("_block"), F.lit(0).alias("_kind"), "_row", "vec_id", "_v")
    queries = rows.where(F.col("vec_id") % every == 0)
    queries = queries.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("_block"), F.lit(1).alias("_kind"), "_row", "vec_id", "_v")
    met = candidates.unionByName(queries).repartition(4 * n_blocks, "_block").sortWithinPartitions("_block", "_kind", "_row")
    found = met.mapInArrow(_search(k), FOUND)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


SQL = f"""
WITH rows AS (
  SELECT row_number() OVER () AS r, vec_id, [floor({SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.r AS q, q.vec_id AS query_id, c.vec_id,
    list_sum([a[1] * a[2] FOR a IN list_zip(q.v, c.v)])::BIGINT AS score, c.r
  FROM rows q JOIN rows c ON q.r <> c.r WHERE q.vec_id % {EVERY} = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id NULLS LAST, r) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= {K}
"""

"""Near-duplicates by SimHash, found by joining a binary trie of fingerprints with itself.

A fingerprint has 64 bits; two documents are linked if theirs differ in at most
``budget`` bits. The trie join walks pairs of nodes together, adds up the bits in which
their common prefix differs and gives a pair up as soon as that exceeds the budget. Its
upper levels are dealt out: each pair of subtrees within the budget is one group of a
Spark shuffle. How deep they are cut follows from a histogram of prefixes, so that a
group stays small. Only distinct fingerprints take part, copies cost nothing; a group
gives a spanning forest of its links, never all pairs, and nodes whose leaves are known
to be connected are not compared again. Components are found over those links on Spark.

Defined results: NULL, empty and blank texts have fingerprint zero, which is linked like
any other; repeated rows are documents of the same fingerprint; a component whose rows
all lack a doc_id has none; an empty table gives an empty result. Texts are hashed whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from foliant.llm.common import materialize
from foliant.operators.pinning import pinned

SHINGLE, BUDGET, SEED = 4, 4, 42
GROUP = 1 << 15
DEEPEST = 16


def fingerprint(text: str | None) -> int:
    """The fingerprint of one text, as an unsigned number."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        hashes = [xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends[: -SHINGLE] + 1).tolist()]
        hashes = [xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends[SHINGLE - 1 :].tolist())]
    packed = np.array(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(packed), 1 << 16):
        bits = np.unpackbits(packed[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(packed), bitorder="little").tobytes(), "little")


def _fingerprints(texts: pd.Series) -> pd.Series:
    found = np.fromiter((fingerprint(t) for t in texts), np.uint64, len(texts))
    return pd.Series(found.view(np.int64))


def simhash(text: Column) -> Column:
    """The fingerprint as a signed bigint."""
    return F.pandas_udf(_fingerprints, "bigint")(text)


class Trie:
    """The path-compressed binary trie of sorted distinct fingerprints.

    Node ``i`` below ``len(values)`` is the leaf of ``values[i]``. ``depth`` is the number of
    bits all leaves of a node share, ``first`` and ``last`` their range.
    """

    def __init__(self, values: np.ndarray, bits: int):
        n = len(values)
        self.bits, self.leaves = bits, n
        left, right = np.full(2 * n, -1, np.int32), np.full(2 * n, -1, np.int32)
        depth, first, last = np.full(2 * n, bits, np.int64), np.arange(2 * n), np.arange(2 * n)
        cuts = [int(bits - int(x).bit_length()) for x in values[1:] ^ values[:-1]]
        # A stack of the nodes on the rightmost path, each with the cut above it.
        stack, free = [0] if n else [], n
        above: list[int] = []
        for i in range(1, n + 1):
            cut = cuts[i - 1] if i < n else -1
            while above and above[-1] > cut:
                r, l_, d = stack.pop(), stack.pop(), above.pop()
                left[free], right[free], depth[free] = l_, r, d
                first[free], last[free] = first[l_], last[r]
                stack.append(free)
                free += 1
            if i < n:
                above.append(cut)
                stack.append(i)
        self.root = stack[0] if stack else -1
        self.left, self.right, self.depth, self.first, self.last = left, right, depth, first, last
        self.value = values[np.minimum(first, max(n - 1, 0))] if n else values


def _settle(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of ``a`` and ``b``; ``root`` then names each leaf's smallest one again."""
    pairs = np.unique(np.stack([root[a], root[b]], 1), axis=0)
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    for x, y in pairs.tolist():
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    if parent:
        moved = np.arange(len(root))
        for x in list(parent):
            moved[x] = find(x)
        root[:] = moved[root]


def trie_links(values: np.ndarray, budget: int, bits: int = 64, across: int | None = None, chunk: int = 1 << 15) -> np.ndarray:
    """For each of the sorted distinct ``values`` the index of the smallest one it is connected to.

    ``across``: only pairs of one value below that index and one from it on are compared.
    """
    values = np.asarray(values, np.uint64)
    n = len(values)
    root = np.arange(n)
    if n < 2:
        return root
    trie = Trie(values, bits)
    if across is None:
        inner = np.flatnonzero(trie.left >= 0)
        start = (trie.left[inner], trie.right[inner])
    else:
        at = trie.root
        while trie.last[trie.left[at]] != across - 1:
            at = trie.left[at] if trie.last[trie.left[at]] >= across else trie.right[at]
        start = (trie.left[at : at + 1], trie.right[at : at + 1])
    # No pair holds the root, so at least one bit is shared and no shift reaches 64.
    value, rest = trie.value, (bits - trie.depth).astype(np.uint64)
    for limit in sorted({min(1, budget), budget}):
        changes = np.concatenate([[0], np.cumsum(root[1:] != root[:-1])])
        even = changes[trie.first % n] == changes[trie.last % n]
        label = np.where(even, root[trie.first % n], -1 - np.arange(2 * n))
        todo = [start]
        while todo:
            u, v = todo.pop()
            if len(u) > chunk:
                todo.append((u[chunk:], v[chunk:]))
                u, v = u[:chunk], v[:chunk]
            differ = (value[u] ^ value[v]) >> np.maximum(rest[u], rest[v])
            live = np.flatnonzero(np.bitwise_count(differ) <= limit)
            u, v = u[live], v[live]
            live = np.flatnonzero(label[u] != label[v])
            u, v = u[live], v[live]
            swap = rest[u] < rest[v]
            wide, deep = np.where(swap, v, u), np.where(swap, u, v)
            leaf = wide < n
            if leaf.any():
                x, y = wide[leaf], deep[leaf]
                apart = root[x] != root[y]
                if apart.any():
                    _settle(root, x[apart], y[apart])
                wide, deep = wide[~leaf], deep[~leaf]
            if len(wide):
                todo.append((np.concatenate([trie.left[wide], trie.right[wide]]), np.concatenate([deep, deep])))
    return root


def _cut_depth(prints: DataFrame, group: int) -> int:
    """The least number of leading bits after which no subtree holds more than ``group`` prints.

    At most 65,536 counts come to the driver.
    """
    counts = np.zeros(1 << DEEPEST, np.int64)
    top = F.shiftrightunsigned("_print", 64 - DEEPEST).cast("int")
    for row in prints.groupBy(top.alias("top")).count().collect():
        counts[row["top"]] = row["count"]
    for depth in range(DEEPEST):
        if counts.reshape(1 << depth, -1).sum(axis=1).max() <= group:
            return depth
    return DEEPEST


def links(prints: DataFrame, budget: int = BUDGET, group: int = GROUP) -> DataFrame:
    """(u, v) with u > v in unsigned order: links that connect what is linked. ``prints``: distinct ``_print``."""
    depth = _cut_depth(prints, group)
    top = F.shiftrightunsigned("_print", 64 - depth).cast("int") if depth else F.lit(0)
    masks = [m for m in range(1 << depth) if m.bit_count() <= budget]
    partners = F.transform(F.array(*map(F.lit, masks)), lambda m: top.bitwiseXOR(m))
    rows = prints.select("_print", top.alias("_top"), F.explode(partners).alias("_with"))
    rows = rows.select("_print", F.least("_top", "_with").alias("_a"), F.greatest("_top", "_with").alias("_b"))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        values = np.sort(pdf["_print"].to_numpy().view(np.uint64))
        a, b = int(pdf["_a"].iloc[0]), int(pdf["_b"].iloc[0])
        across = None
        if a != b:
            across = int(np.searchsorted(values, np.uint64(b << (64 - depth))))
            if across in (0, len(values)):
                return pd.DataFrame({"u": [], "v": []}, dtype="int64")
        root = trie_links(values, budget, across=across)
        far = np.flatnonzero(root != np.arange(len(root)))
        return pd.DataFrame({"u": values[far].view(np.int64), "v": values[root[far]].view(np.int64)})

    return rows.groupBy("_a", "_b").applyInPandas(join, "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): the least node it is connected to.

    Alternates the large star (every larger neighbour is tied to the least one) and the
    small star (so is every smaller neighbour); each round is written to the shared folder.
    """
    facts = lambda df: df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).head()
    now, before = materialize(edges.where("u <> v").distinct(), "links"), None
    while (known := facts(now)) != before:
        before = known
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = pinned(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = pinned(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x"))
        small = small.select(F.col("x.v").alias("u"), F.col("x.m").alias("v")).where("u <> v")
        now = materialize(small.distinct(), "stars")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def near_duplicates(docs: DataFrame, budget: int = BUDGET, group: int = GROUP) -> DataFrame:
    """``docs`` (doc_id and text) as doc_id, ``_print`` and component_id, the smallest doc_id reachable."""
    marked = materialize(docs.select("doc_id", simhash(F.col("text")).alias("_print")), "fingerprints")
    return _with_component(marked, budget, group)


def _with_component(marked: DataFrame, budget: int, group: int) -> DataFrame:
    """``component_id`` for rows with doc_id and ``_print``, a written table."""
    prints = materialize(marked.groupBy("_print").agg(F.min("doc_id").alias("_least")), "distinct-prints")
    tree = materialize(components(links(prints.select("_print"), budget, group)), "components")
    rooted = prints.join(tree.select(F.col("node").alias("_print"), "root"), "_print", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "_print"))
    ids = pinned(rooted.groupBy("root").agg(F.min("_least").alias("component_id")))
    named = materialize(rooted.join(ids, "root").select("_print", "component_id", "root"), "named-prints")
    return marked.join(named, "_print")


def simhash_components(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits) and component_id."""
    found = near_duplicates(docs, budget)
    return found.select("doc_id", F.lpad(F.lower(F.hex("_print")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """The document with the smallest doc_id of each component; rows that agree in it are cut to one.

    Where all rows of a component lack a doc_id, the row with the least hash stays.
    """
    marked = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", simhash(F.col("text")).alias("_print"))
    marked = materialize(marked, "fingerprinted")
    found = _with_component(marked, budget, GROUP).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return found.groupBy("root").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row")).select("_row.*")

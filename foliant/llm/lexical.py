"""Ranked lexical search by bag deduplication.

What a query can see of a document is its bag: how often each word of the items'
vocabulary stands in it, and the number m that its length gives. Documents are
restricted to such bags in one pass over the texts. Documents with the same bag and the
same m (copies, texts that differ in other words or in word order, and short texts that
share a few common words) form one class and have the same score for every item. Classes
are found by a hash of bag and m and verified by comparing both in full; each class is
scored once, against all items that share a word with it. The best classes of an item
are then expanded to their members by ascending doc_id. No more than the first k members
of a class can appear in a result of k rows, so a class carries those and its size, and a
hot class costs a few rows per task.

The vocabulary is cut into blocks of bounded size that travel with the tasks; each block
costs one pass over the documents, and their partial bags are joined per document. Items
are dealt in blocks too: classes meet each block of items once.

Defined results: NULL texts hold no words and do not count as documents; items without
words, or NULL, have no rows, nor has an item no document shares a word with; items that
repeat an item_id are ranked each on its own; repeated rows are documents of their own;
a NULL doc_id loses every tie; other columns are ignored; empty tables give an empty
result. Scores and sums must fit 64 bits; texts are read whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from foliant.llm.common import materialize
from foliant.operators.pinning import pinned

K = 10
# Words of one pass over the documents, items scored at a time, score cells and postings a task holds.
VOCABULARY, ITEMS, CELLS, POSTINGS = 1 << 19, 4096, 1 << 22, 1 << 20
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Bytes of words stay, A-Z become a-z, all others of ASCII separate.
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The words of a text in UTF-8, in order."""
    return text.translate(_WORD).split(b" ") if text else []


def counted(text: bytes | None) -> Counter[bytes]:
    found = Counter(terms(text))
    found.pop(b"", None)
    return found


BAG = "doc_id bigint, n bigint, bag binary"


def _bags(docs: DataFrame, words: list[bytes], base: int, key: list[str]) -> DataFrame:
    """Per document its number of words and its bag: (word number, times) as 32-bit pairs, ascending."""
    number = {w: base + i for i, w in enumerate(words)}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, bags = [], []
            for text in batch.column(0).cast(pa.binary()):
                found = counted(text.as_py())
                # The smaller side is walked.
                both = found.keys() & number.keys()
                pairs = sorted((number[w], found[w]) for w in both)
                sizes.append(found.total())
                bags.append(np.array(pairs, "<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())], [*key, "n", "bag"]
            )

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in key), "n bigint", "bag binary"])
    return docs.select("text", *key).mapInArrow(read, schema)


def vocabulary(items: DataFrame) -> DataFrame:
    """(item, item_id, word): the distinct words of each item row, a written table."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, n, w) for i, n, t in zip(*(c.to_pylist() for c in (batch.column(0), batch.column(1), batch.column(2).cast(pa.binary())))) for w in counted(t)]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))] if rows else [pa.array([], k) for k in (pa.int64(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["item", "item_id", "word"])

    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("bigint").alias("item_id"), "text")
    return materialize(rows.mapInArrow(read, "item bigint, item_id bigint, word binary"), "item-words")


def restricted(docs: DataFrame, words: list[bytes], block: int = VOCABULARY) -> DataFrame:
    """``doc_id``, ``n`` and ``bag`` of every document, a written table; one pass per block of words."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if len(words) <= block:
        return materialize(_bags(rows, words, 0, ["doc_id"]), "bags")
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    parts = [_bags(rows, words[at : at + block], at, ["_row", "doc_id"]).withColumn("at", F.lit(at)) for at in range(0, len(words), block)]
    parted = parts[0]
    for p in parts[1:]:
        parted = parted.unionByName(p)
    pieces = F.array_sort(F.collect_list(F.struct("at", "bag")))
    whole = parted.groupBy("_row").agg(F.first("doc_id").alias("doc_id"), F.first("n").alias("n"), pieces.alias("pieces"))
    joined = F.aggregate("pieces", F.lit(b""), lambda a, p: F.concat(a, p["bag"]))
    return materialize(whole.select("doc_id", "n", joined.alias("bag")), "bags")


def bag_classes(bags: DataFrame, k: int = K) -> tuple[DataFrame, int]:
    """Classes (m, bag, size, members: the k least doc_ids) of the documents that share a word with an item, and N."""
    facts = bags.agg(F.count(F.when(F.col("n") > 0, 1)).alias("n"), F.sum("n").alias("l")).head()
    count, total = facts["n"], int(facts["l"] or 0)
    if not total:
        return None, 0
    m = F.lit(100 - 90) + F.expr(f"(90L * n * {count}L) div {total}L")
    marked = bags.where(F.length("bag") > 0).select("doc_id", m.alias("m"), "bag")
    marked = marked.withColumn("h", F.xxhash64("bag", "m"))
    key = ["h", "m", "bag"]
    sizes = marked.groupBy(*key).agg(F.count(F.lit(1)).alias("size"))
    first = Window.partitionBy(*key).orderBy(F.col("doc_id").asc_nulls_last())
    least = marked.withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= k)
    # A NULL would vanish from the list.
    member = F.struct("_at", "doc_id")
    least = least.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(member)), lambda x: x["doc_id"]).alias("members"))
    joined = sizes.join(least, key)
    return materialize(joined.select("m", "bag", "size", "members"), "classes"), count


def document_frequencies(classes: DataFrame, size: int) -> np.ndarray:
    """Documents per word number: summed up in tasks first, at most one number per word comes back."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, np.int64)
        for batch in batches:
            for n, bag in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[np.frombuffer(bag, "<i4")[::2]] += n
        on = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(on), pa.array(sums[on])], ["word", "df"])

    out = np.zeros(size, np.int64)
    for r in classes.select("size", "bag").mapInArrow(read, "word bigint, df bigint").groupBy("word").agg(F.sum("df").alias("df")).toLocalIterator():
        out[r["word"]] = r["df"]
    return out


class Postings:
    """Items by word, for one block of items."""

    def __init__(self, size: int, pairs: list[tuple[int, int]]):
        at = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.items = at[:, 1]
        self.first = np.searchsorted(at[:, 0], np.arange(size + 1))

    def score(self, owners: np.ndarray, words: np.ndarray, parts: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
        """Scores of classes (rows) for items (columns); ``parts`` are the words' shares."""
        begin = self.first[words]
        lengths = self.first[words + 1] - begin
        out = np.zeros(shape[0] * shape[1], np.int64)
        # Postings are unfolded a bounded number at a time.
        cuts = np.searchsorted(np.cumsum(lengths), np.arange(0, lengths.sum() + POSTINGS, POSTINGS))
        for a, b in zip(cuts, [*cuts[1:], len(words)]):
            n, first = lengths[a:b], begin[a:b]
            at = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
            np.add.at(out, np.repeat(owners[a:b], n) * shape[1] + self.items[at], np.repeat(parts[a:b], n))
        return out.reshape(shape)


def best_classes(classes: DataFrame, weights: np.ndarray, pairs: list[tuple[int, int]], n_items: int, k: int) -> DataFrame:
    """Per task and item the best ``k`` classes: (item, score, members). Equal scores: least first member."""
    last = 2**63 - 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        postings = Postings(len(weights), pairs)
        held: list[list[tuple[int, int, list]]] = [[] for _ in range(n_items)]
        # What a class has to reach to be among the best of an item.
        floor = np.zeros(n_items, np.int64)
        step = max(1, CELLS // n_items)
        for whole in batches:
            for start in range(0, len(whole), step):
                batch = whole.slice(start, step)
                m = batch.column(0).to_numpy()
                bags = batch.column(1).to_pylist()
                flat = np.frombuffer(b"".join(bags), "<i4").astype(np.int64)
                owners = np.repeat(np.arange(len(bags)), [len(b) // 8 for b in bags])
                words, times = flat[::2], flat[1::2]
                parts = weights[words] * ((1_000_000_000 * times) // (1000 * times + 8 * m[owners]))
                scores = postings.score(owners, words, parts, (len(bags), n_items))
                members = batch.column(2)
                for item in np.flatnonzero((scores >= np.maximum(floor, 1)).any(axis=0)).tolist():
                    column = scores[:, item]
                    rows = np.flatnonzero(column >= max(floor[item], 1))
                    if len(rows) > 4 * k:
                        # Ties at the border all stay until their members are compared.
                        border = np.partition(column[rows], len(rows) - k)[len(rows) - k]
                        rows = rows[column[rows] >= border]
                    for row in rows.tolist():
                        ids = members[row].as_py()
                        held[item].append((-int(column[row]), last if ids[0] is None else ids[0], ids))
                    held[item] = sorted(held[item], key=lambda x: x[:2])[:k]
                    if len(held[item]) == k:
                        floor[item] = -held[item][-1][0]
        rows = [(i, -s, ids) for i, found in enumerate(held) for s, _, ids in found]
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()))
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds]
        yield pa.RecordBatch.from_arrays(columns, ["item", "score", "members"])

    return classes.select("m", "bag", "members").mapInArrow(read, "item bigint, score bigint, members array<bigint>")


def search(docs: DataFrame, items: DataFrame, k: int = K, block: int = VOCABULARY, items_block: int = ITEMS) -> DataFrame:
    """The ``k`` best documents per item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    empty = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    held = vocabulary(items)
    # The items are the queries: their distinct words come to the driver once.
    words = [bytes(r["word"]) for r in held.select("word").distinct().orderBy("word").toLocalIterator()]
    if not words:
        return empty
    classes, count = bag_classes(restricted(docs, words, block), k)
    if not count:
        return empty
    df = document_frequencies(classes, len(words))
    weights = np.array([math.floor(1000 * math.log((2 * count + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    number = {w: i for i, w in enumerate(words)}
    rows = held.groupBy("item").agg(F.first("item_id").alias("item_id"), F.collect_list("word").alias("words")).orderBy("item")
    found, block_items, part = [], [], []

    def flush():
        if block_items:
            pairs = [(number[w], i) for i, ws in enumerate(part) for w in ws]
            names = spark.createDataFrame([(i, *x) for i, x in enumerate(block_items)], "item bigint, _item bigint, item_id bigint")
            best = pinned(best_classes(classes, weights, pairs, len(block_items), k))
            found.append(best.join(F.broadcast(names), "item").select("_item", "item_id", "score", "members"))
            block_items.clear()
            part.clear()

    for r in rows.toLocalIterator():
        block_items.append((r["item"], r["item_id"]))
        part.append([bytes(w) for w in r["words"]])
        if len(block_items) == items_block:
            flush()
    flush()
    best = found[0]
    for f in found[1:]:
        best = best.unionByName(f)
    order = Window.partitionBy("_item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = best.select("_item", "item_id", "score", F.explode("members").alias("doc_id"))
    ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERMS = f"regexp_extract_all(translate(text, '{_LETTERS}', '{_LETTERS.lower()}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS ws FROM documents),
totals AS (SELECT count(*) FILTER (len(ws) > 0) AS n, sum(len(ws))::BIGINT AS l FROM docs),
tf AS (SELECT d, w, count(*) AS tf FROM (SELECT d, unnest(ws) AS w FROM docs) GROUP BY ALL),
df AS (SELECT w, count(*) AS df FROM tf GROUP BY w),
items AS (SELECT row_number() OVER () AS i, item_id, list_distinct({_TERMS}) AS ws FROM benchmark),
wanted AS (SELECT i, item_id, unnest(ws) AS w FROM items),
sized AS (SELECT d, doc_id, 100 - 90 + ((90 * len(ws)::BIGINT * n) // l) AS m FROM docs, totals WHERE len(ws) > 0),
scored AS (
  SELECT i, item_id, d, doc_id,
    sum(floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM wanted JOIN tf USING (w) JOIN df USING (w) JOIN sized USING (d), totals
  GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, d) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {K}
"""

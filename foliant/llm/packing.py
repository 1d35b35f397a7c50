"""Best-fit packing of tokenised documents, planned over a histogram of lengths.

1. Every document becomes its token ids and one end id; only longer ones are cut into
   pieces of ``capacity``. A task numbers its pieces of each length as it goes.
2. The counts per length, at most ``capacity`` numbers, are all the planner sees. It
   places the lengths from the longest down, each into the fullest kind of sequence it
   fits into, whole groups of equal sequences at a time; the plan's size depends on the
   number of lengths and not on that of the documents.
3. Pieces take the planned slots by their rank within their length: the rank in the task
   plus the count of that length in the tasks before.

No piece is moved to find its rank, and no length, however common, meets in one task.

Defined results: a NULL or empty text is the end id alone; repeated rows are packed each;
a NULL doc_id stays NULL; further columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from foliant.llm.common import materialize

CAPACITY, END = 4096, 1
MEMO = 1 << 19


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def id_bytes(definition: str, memo_size: int = MEMO):
    """A function from the UTF-8 bytes of a text to its ids as little-endian unsigned 32-bit numbers.

    The tokenizer lower-cases and never looks across white space, so A-Z are lowered first and each
    run of other characters is encoded once and remembered; the memory is emptied when it
    holds ``memo_size`` runs. Of a run of plain letters and the punctuation after it, which
    the tokenizer splits there, the letters go straight to its model. Texts with special
    tokens, or with combining marks, which lowering first might join otherwise, are
    encoded whole.
    """
    import re
    import unicodedata
    from array import array

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    model = tokenizer.model
    # Special tokens, and U+0300 to U+036F.
    odd = re.compile(rb"<\||\|>|\xcc[\x80-\xbf]|\xcd[\x80-\xaf]")
    # Letters, then ASCII punctuation without the apostrophe.
    simple = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)")
    # The letter that stands for each byte in the model's vocabulary.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    letter = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}

    def whole(text: str) -> bytes:
        return array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    class Memo(dict):
        def __missing__(self, run: bytes) -> bytes:
            if len(self) >= memo_size:
                self.clear()
            text = run.decode("utf-8", "surrogatepass")
            m = simple.fullmatch(text)
            word = m[1] if m else ""
            if m and word.isascii():
                found = array("I", [t.id for t in model.tokenize(word)]).tobytes()
            elif m and word.isalpha() and word == word.lower() and unicodedata.is_normalized("NFC", word):
                mapped = word.encode().decode("latin-1").translate(letter)
                found = array("I", [t.id for t in model.tokenize(mapped)]).tobytes()
            else:
                found, m = whole(text), None
            if m and m[2]:
                found += self[m[2].encode()]
            self[run] = found
            return found

    memo = Memo()

    def ids(text: bytes | None) -> bytes:
        if not text:
            return b""
        if odd.search(text):
            return whole(text.decode("utf-8", "surrogatepass"))
        return b"".join(map(memo.__getitem__, text.lower().split()))

    return ids


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, _task bigint, _rank bigint"


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece, with its rank among the task's pieces of that length."""
    with open(tokenizer or tokenizer_file(), encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    schema = PIECES + (", ids array<bigint>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from array import array

        ids, end = id_bytes(definition.value), array("I", [END]).tobytes()
        task, seen, names = TaskContext.get().partitionId(), {}, [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            rows: list[tuple] = []
            texts = batch.column(1).cast(pa.binary()) if pa.types.is_string(batch.column(1).type) else batch.column(1).cast(pa.large_binary())
            for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                told = ids(text.as_py()) + end
                for k, at in enumerate(range(0, len(told), 4 * capacity)):
                    part = told[at : at + 4 * capacity]
                    n = len(part) // 4
                    seen[n] = rank = seen.get(n, -1) + 1
                    row = (doc_id, k, at // 4, n, zlib.crc32(part), task, rank)
                    rows.append((*row, array("I", part).tolist()) if with_ids else row)
            if rows:
                kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(cut, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Slots as (length, first rank, items, items per sequence, first sequence, offset).

    Best fit, longest first. Equal sequences form a group (room, first sequence, how many);
    an item goes to the group with the least room that takes it, as often as it fits.
    """
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    slots, fresh = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        at = length
        while left:
            while at <= capacity and not room[at]:
                at += 1
            if at <= capacity:
                first, many = room[at].pop()
                free = at
            else:
                each = capacity // length
                first, many, free = fresh, -(-left // each), capacity
                fresh += many
            each = free // length
            full, rest = min(many, left // each), 0
            if full:
                slots.append((length, rank, full * each, each, first, capacity - free))
                room[free - each * length].append((first, full))
            rank, left = rank + full * each, left - full * each
            if full < many and left:
                # Fewer than one sequence's worth are left.
                rest = left
                slots.append((length, rank, rest, rest, first + full, capacity - free))
                room[free - rest * length].append((first + full, 1))
                rank, left = rank + rest, 0
            used = full + (1 if rest else 0)
            if used < many:
                room[free].append((first + used, many - used))
    return slots


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset (and ids) of every piece."""
    spark: SparkSession = docs.sparkSession
    cut = materialize(pieces(docs, capacity, tokenizer, with_ids), "pieces")
    per_task = cut.groupBy("length", "_task").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = materialize(per_task.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))), "length-counts")
    # At most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    slots = spark.createDataFrame(
        plan(counts, capacity), "length bigint, _first bigint, _items bigint, _each bigint, _sequence bigint, _offset bigint"
    )
    ranked = cut.join(per_task.select("length", "_task", "_before"), ["length", "_task"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before"))
    # The plan is bounded by the number of lengths, not by the table.
    placed = ranked.join(
        F.broadcast(slots), (ranked["length"] == slots["length"]) & F.col("_rank").between(F.col("_first"), F.col("_first") + F.col("_items") - 1)
    ).drop(slots["length"])
    local = F.col("_rank") - F.col("_first")
    result = placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("_sequence") + F.floor(local / F.col("_each"))).alias("sequence_id"),
        (F.col("_offset") + (local % F.col("_each")) * F.col("length")).alias("offset"), *(["ids"] if with_ids else []),
    )
    return result

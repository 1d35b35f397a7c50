"""The elements of JSON arrays of any layout, read by as many tasks as a file has splits.

A split that starts in the middle of an array does not know whether its first byte is
within a text, nor how deep it is nested. But what it does to both is known after one look:
the parity of its quotes, and for either start its change of depth. These are composed
over the splits of a file by two prefix sums, a window over one narrow row per split, and
every split then has its true start. With that it cuts itself into elements at the commas of depth
one. An element that continues in the next splits is put together from its pieces, of
which a split has two at most.

Splits come from the text source with a closing brace for line separator: its rows are
small whatever the layout, and never end within an escape.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from foliant.session import materialize

# Functions that run in Python workers travel by value: no package has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE, COMMA, BACKSLASH, OPEN, CLOSE, BEGIN, END = b'",\\{}[]'
SPLIT = ["fid", "block"]
# How much of what cannot be read is given as a malformed row.
MALFORMED = 1000


def _structural(data: bytes, commas: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places and bytes of quotes and brackets, with or without commas, that no backslash escapes."""
    array = np.frombuffer(data, np.uint8)
    wanted = np.zeros(256, bool)
    wanted[[QUOTE, BACKSLASH, OPEN, CLOSE, BEGIN, END] + [COMMA] * commas] = True
    at = np.flatnonzero(wanted[array])
    kind = array[at]
    slashes = at[kind == BACKSLASH]
    if len(slashes):
        # In a run of backslashes every other one escapes what follows it.
        start = np.concatenate([[True], np.diff(slashes) != 1])
        run = np.maximum.accumulate(np.where(start, np.arange(len(slashes)), 0))
        escaping = (np.arange(len(slashes)) - run) % 2 == 0
        on = (kind != BACKSLASH) & ~np.isin(at, slashes[escaping] + 1)
        at, kind = at[on], kind[on]
    return at, kind


def _steps(kind: np.ndarray) -> np.ndarray:
    """What each byte does to the depth."""
    step = np.zeros(256, np.int64)
    step[[OPEN, BEGIN]], step[[CLOSE, END]] = 1, -1
    return step[kind]


def _segments(batch: pa.RecordBatch, at: int = 1) -> Iterator[tuple[tuple[int, int], int, int]]:
    """(split, first row, end row) of the runs of one split; columns ``at`` and ``at + 1`` name it."""
    fid, block = batch.column(at).to_numpy(), batch.column(at + 1).to_numpy()
    cuts = [0, *(np.flatnonzero((fid[1:] != fid[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), len(fid)]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield (int(fid[a]), int(block[a])), a, b


EFFECTS = "fid bigint, block bigint, bytes bigint, parity int, out_depth bigint, in_depth bigint"


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: its bytes, the parity of its quotes, and its change of depth if it starts out of or in a text."""
    split, size, parity, depth = None, 0, 0, [0, 0]

    def row():
        return pa.RecordBatch.from_pylist(
            [{"fid": split[0], "block": split[1], "bytes": size, "parity": parity, "out_depth": depth[0], "in_depth": depth[1]}],
            pa.schema([("fid", pa.int64()), ("block", pa.int64()), ("bytes", pa.int64()), ("parity", pa.int32()), ("out_depth", pa.int64()), ("in_depth", pa.int64())]),
        )

    for batch in batches:
        for found, a, b in _segments(batch):
            if found != split:
                if split:
                    yield row()
                split, size, parity, depth = found, 0, 0, [0, 0]
            data = b"}".join(batch.column(0).slice(a, b - a).to_pylist()) + b"}"
            _, kind = _structural(data, commas=False)
            quotes = np.cumsum(kind == QUOTE)
            steps, inside = _steps(kind), (quotes + parity) % 2
            depth = [depth[0] + int(steps[inside == 0].sum()), depth[1] + int(steps[inside == 1].sum())]
            parity = (parity + int(quotes[-1] if len(quotes) else 0)) % 2
            size += len(data)
    if split:
        yield row()


def _chunks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    rows = spark.read.option("lineSep", "}").text(path)
    file = F.col("_metadata.file_path")
    return rows.select(
        F.col("value").cast("binary").alias("chunk"), F.xxhash64(file).alias("fid"), F.col("_metadata.file_block_start").alias("block")
    )


def split_starts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """How each split starts: (fid, block, inside a text, depth, first, unended).

    ``unended`` marks the last split of a file that does not end in a closing brace. A
    compressed file, whose size tells nothing, counts as such.
    """
    effects = _chunks(spark, path).mapInArrow(_effects, EFFECTS)
    rows = Window.partitionBy("fid").orderBy("block")
    before, file = rows.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("fid")
    inside = F.pmod(F.coalesce(F.sum("parity").over(before), F.lit(0)), F.lit(2)).cast("int")
    states = effects.withColumn("inside", inside).withColumn("change", F.when(F.col("inside") == 0, F.col("out_depth")).otherwise(F.col("in_depth")))
    # A file's last row is given one byte too many unless the file ends in a separator.
    sizes = _sizes(spark, path)
    states = states.select(
        *SPLIT, "inside",
        F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"),
        (F.row_number().over(rows) == 1).alias("first"),
        (F.max("block").over(file) == F.col("block")).alias("last"),
        F.sum("bytes").over(file).alias("total"),
    ).join(sizes, "fid")
    return states.select(*SPLIT, "file", "inside", "depth", "first", (F.col("last") & (F.col("total") != F.col("size"))).alias("unended"))


def _sizes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(fid, file, size), one row per file; only names and sizes are read."""
    files = spark.read.format("binaryFile").load(path)
    file = F.col("_metadata.file_path")
    return files.select(F.xxhash64(file).alias("fid"), file.alias("file"), F.col("length").alias("size"))


# Kinds of pieces.
WHOLE, TAIL, MIDDLE, HEAD = range(4)
PIECES = "value binary, fid bigint, block bigint, kind int"


class _Cutter:
    """Cuts one split, given in portions, into (kind, piece)."""

    def __init__(self, inside: int, depth: int, first: bool):
        self.inside, self.depth, self.first = inside, depth, first
        self.open: list[bytes] = []
        # A later split at depth zero lies behind the end of the array.
        self.opened, self.done, self.cut = not first, not first and depth <= 0, False

    def feed(self, data: bytes) -> Iterator[tuple[int, bytes]]:
        if self.done or not data:
            return
        at, kind = _structural(data, commas=True)
        quotes = np.cumsum(kind == QUOTE) + self.inside
        steps = np.where(quotes % 2 == 0, _steps(kind), 0)
        depth = self.depth + np.cumsum(steps)
        plain = (quotes % 2 == 0) & (kind != QUOTE)
        comma = plain & (kind == COMMA) & (depth == 1)
        begin = plain & (steps == 1) & (depth == 1)
        end = plain & (steps == -1) & (depth == 0)
        last = 0
        for i in np.flatnonzero(comma | begin | end).tolist():
            place = int(at[i])
            self.open.append(data[last:place])
            piece, self.open, last = b"".join(self.open), [], place + 1
            if not self.opened:
                # What stands before the array may only be blank.
                self.opened = True
                if kind[i] != BEGIN or piece.strip(b"\xef\xbb\xbf \t\r\n"):
                    self.done = True
                    yield WHOLE, (piece + data[place:])[:MALFORMED]
                    return
            else:
                yield (WHOLE if self.cut or self.first else HEAD), piece
            self.cut = True
            if end[i]:
                self.done = True
                if kind[i] != END:
                    yield WHOLE, data[place : place + MALFORMED]
                return
        self.open.append(data[last:])
        self.inside = int(quotes[-1]) % 2 if len(quotes) else self.inside
        self.depth = int(depth[-1]) if len(depth) else self.depth

    def finish(self) -> Iterator[tuple[int, bytes]]:
        rest = b"".join(self.open)
        if self.done or not self.opened:
            if rest.strip() and not self.opened:
                yield WHOLE, rest[:MALFORMED]
        else:
            yield (TAIL if self.cut or self.first else MIDDLE), rest


def _pieces(wanted: tuple[int, ...]):
    """Elements and pieces of elements of each split; its last chunk waits for the end."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("value", pa.binary()), ("fid", pa.int64()), ("block", pa.int64()), ("kind", pa.int32())])
        split, cutter, held, unended = None, None, None, False

        def batch_of(found):
            found = [x for x in found if x[0] in wanted]
            n = len(found)
            columns = [pa.array([x[1] for x in found], pa.binary()), pa.array([split[0]] * n, pa.int64()), pa.array([split[1]] * n, pa.int64()), pa.array([x[0] for x in found], pa.int32())]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        def close():
            return batch_of([*cutter.feed(held + (b"" if unended else b"}")), *cutter.finish()])

        for batch in batches:
            for found, a, b in _segments(batch):
                if found != split:
                    if split:
                        yield close()
                    inside, depth, first, unended = (batch.column(j)[a].as_py() for j in range(3, 7))
                    split, cutter, held = found, _Cutter(inside, depth, first), None
                chunks = batch.column(0).slice(a, b - a).to_pylist()
                if held is not None:
                    chunks.insert(0, held)
                held = chunks.pop()
                if chunks:
                    yield batch_of(list(cutter.feed(b"}".join(chunks) + b"}")))
        if split:
            yield close()

    return cut


def array_elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The texts of the elements of each array, ``(value, file, block)``, in order.

    The input is read three times, twice of it without parsing, and the first time at once: how splits start is
    used by all that follows, so it is written to the shared folder. It is broadcast:
    one row of about a hundred bytes per split, a millionth of the input.
    """
    starts = materialize(split_starts(spark, path), "split-starts")
    known = _chunks(spark, path).join(F.broadcast(starts.drop("file")), SPLIT)
    known = known.select("chunk", *SPLIT, "inside", "depth", "first", "unended")
    whole = known.mapInArrow(_pieces((WHOLE,)), PIECES)
    pieces = known.mapInArrow(_pieces((TAIL, MIDDLE, HEAD)), PIECES)
    # A tail begins an element; what follows up to the next tail continues it. A split gives its head first.
    order = Window.partitionBy("fid").orderBy("block", F.desc("kind"))
    begun = pieces.withColumn("element", F.max(F.when(F.col("kind") == TAIL, F.col("block"))).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", (-F.col("kind")).alias("kind"), "value")))
    joined = begun.groupBy("fid", "element").agg(parts.alias("parts"))
    text = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["value"]))
    whole = whole.select(F.col("value"), *SPLIT)
    rows = whole.unionByName(joined.select(text.alias("value"), "fid", F.col("element").alias("block")))
    files = F.broadcast(starts.select(*SPLIT, "file"))
    return rows.join(files, SPLIT).select(F.col("value").cast("string").alias("value"), "file", "block")

"""Removal of repeated passages by the suffix order of prefix-free parsed texts.

Every byte covered by a string of ``length`` bytes that also starts at another place is
repeated. Texts are parsed into phrases by a hash that rolls over eight bytes: its least value
among the first four fifths of a string triggers the end of the phrase in which the string starts.
Triggers depend on the bytes around them alone, so equal strings are cut alike, and every string
passes one. A string is a suffix of its phrase, of a bytes, and what follows the phrase's end; so
the order of all strings of the corpus is the order of phrase suffixes (the suffix order of
the dictionary), and among equal ones the order of what follows (that of the parse).

What occurs once needs no order, and most of a corpus does:

1. One pass over the texts finds the phrases' ends and a hash of the bytes behind each. No
   repeated string passes an end whose hash stands nowhere else.
2. The other ends are looked up in their texts, a copy of a text once. The phrase and the
   bytes behind it that its strings span are an end's context. Contexts are sorted over
   ranges by hash and 128-bit fingerprint; those equal to a neighbour are repeated as they
   are: copies, and the inside of shared passages.
3. A context found once may still share strings with others behind whose ends the same bytes
   begin, as at the rim of a passage. Each such group is put in order by its phrases read
   backwards and by what follows them. Neighbours' common lengths tell at once which
   strings have an equal with the same phrase or the same follower; what could still have
   one that differs in both is ranked string by string: by phrase suffix, and by the first
   follower that agrees as far as the string goes. Equal ranks are repeated strings.
4. Groups beyond ``GROUP`` contexts, as about a passage that a large share of all documents
   holds, are ranked by range-partitioned sorts instead, in any number of tasks.

A text is known by two 64-bit hashes, a context by a 128-bit one; equal fingerprints
count as equal. No unbounded group is gathered in a task: hot hashes are partially
aggregated, sorts deal ties out over their ranges. What tasks need to know of
their neighbours comes to the driver, a row or two per task.

Defined results: a NULL text is empty; texts shorter than ``length`` keep every byte; copies of
a text of at least ``length`` bytes lose all of it; a cut may fall between the bytes of one
character, so kept texts are binary; rows that repeat a doc_id are documents of
their own; NULL doc_ids and other columns are carried; an empty table gives an empty result.
A run of one character has an end at every byte and costs the more for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from foliant.llm.common import materialize
from foliant.operators.pinning import pinned

LENGTH = 200
WINDOW = 8
# Bytes looked at together; texts a task remembers; contexts that one task puts in order.
SLICE, SEEN, GROUP = 1 << 20, 1 << 17, 20_000
KEY = ["k1", "k2"]


def _reach(length: int) -> int:
    """How far behind its start a string's trigger may lie."""
    return length * 4 // 5


def common(a: bytes, b: bytes) -> int:
    """How many bytes two strings share at their beginning."""
    n = min(len(a), len(b))
    return n - ((int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")).bit_length() + 7) // 8


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def _hashes(part: np.ndarray) -> np.ndarray:
    """A hash of the eight bytes from each place on."""
    words = np.empty(max(len(part) - WINDOW + 1, 0), np.uint64)
    for k in range(min(WINDOW, len(words))):
        aligned = part[k : k + (len(part) - k) // WINDOW * WINDOW].view("<u8")
        words[k::WINDOW] = aligned[: len(words[k::WINDOW])]
    return _mix(words)


def triggers(data: np.ndarray, reach: int, chunk: int = SLICE) -> tuple[np.ndarray, np.ndarray]:
    """Runs of starts with one trigger: each run's first start, and the trigger.

    A start's trigger is the first least hash within ``reach`` places.
    """
    first, found = [], []
    low = np.uint64((1 << 31) - 1)
    starts = len(data) - WINDOW + 1 - reach
    for at in range(0, max(starts, 0), chunk):
        n = min(chunk, starts - at)
        # Hash before place: the least of both is the first of the least.
        keys = _hashes(data[at : at + n + reach + WINDOW - 1]) & ~low
        keys |= np.arange(len(keys), dtype=np.uint64)
        # Least of every window from two runs of minima over blocks of its size.
        blocks = np.full(-(-len(keys) // (reach + 1)) * (reach + 1), ~np.uint64(0))
        blocks[: len(keys)] = keys
        blocks = blocks.reshape(-1, reach + 1)
        ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        back = np.minimum.accumulate(blocks, axis=1).reshape(-1)
        least = (np.minimum(ahead[:n], back[reach : reach + n]) & low).astype(np.int64)
        runs = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        first.append(runs + at)
        found.append(least[runs] + at)
    none = np.zeros(0, np.int64)
    first, found = np.concatenate([none, *first]), np.concatenate([none, *found])
    on = np.concatenate([[True], found[1:] != found[:-1]]) if len(found) else np.zeros(0, bool)
    return first[on], found[on]


class Parse:
    """Phrase ends of adjoining texts, ``data[cuts[i]:cuts[i + 1]]``.

    ``at`` are the ends, ``low`` and ``high`` the least and greatest number of bytes that a
    string which belongs to the end has before it; ``owner`` the text. Every start of a
    string belongs to one end.
    """

    def __init__(self, data: np.ndarray, cuts: np.ndarray, length: int):
        first, at = triggers(data, _reach(length))
        last = np.append(first[1:], max(len(data) - WINDOW + 1 - _reach(length), 0)) - 1
        long = np.flatnonzero(np.diff(cuts) >= length)
        begin, end = cuts[:-1][long], cuts[1:][long] - length
        # The runs that each text's starts overlap.
        a, b = np.searchsorted(last, begin), np.searchsorted(first, end, "right")
        n = b - a
        run = np.arange(n.sum()) + np.repeat(a - (np.cumsum(n) - n), n)
        text = np.repeat(np.arange(len(long)), n)
        self.owner, self.at = long[text], at[run]
        self.high = self.at - np.maximum(first[run], begin[text])
        self.low = self.at - np.minimum(last[run], end[text])


def behind(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes from each place on."""
    h = np.full(len(at), size, np.uint64)
    for off in [*range(0, size - WINDOW, WINDOW), size - WINDOW]:
        words = np.ascontiguousarray(data[(at + off)[:, None] + np.arange(WINDOW)]).view("<u8")[:, 0]
        h = _mix(h ^ words) * np.uint64(0xD6E8FEB86659FD93)
    return _mix(h).view(np.int64)


def _slices(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows from, rows to, their joined bytes and the cuts between; a few megabytes at a time."""
    if not len(batch):
        return
    column = batch.column(at).cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1)
        cuts = offsets[row : to + 1]
        yield row, to, data[cuts[0] : cuts[-1]], (cuts - cuts[0]).astype(np.int64)
        row = to


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumns({"k1": F.xxhash64(text), "k2": F.xxhash64(F.lit(1), text), "_text": text.cast("binary")})


MARKS = "tid bigint, k1 bigint, k2 bigint, hashes array<bigint>, places array<int>"


def parsed(texts: DataFrame, length: int) -> DataFrame:
    """The ends of each text of (k1, k2, _text); a copy in the same task gives its key alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tid = TaskContext.get().partitionId() << 33
        seen: set[tuple[int, int]] = set()
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()))
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for row, to, data, cuts in _slices(batch, 2):
                p = Parse(data, cuts, length)
                hashes = behind(data, p.at, length - _reach(length))
                bounds = np.searchsorted(p.owner, np.arange(to - row + 1))
                columns: list[list] = [[], [], [], [], []]
                for i in range(to - row):
                    k, own = keys[row + i], slice(bounds[i], bounds[i + 1])
                    known = k in seen
                    if not known:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(k)
                    line = (tid, *k, None if known else hashes[own], None if known else (p.at[own] - cuts[i]).astype(np.int32))
                    for column, x in zip(columns, line):
                        column.append(x)
                    tid += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in MARKS.split(", ")])

    return texts.select(*KEY, "_text").mapInArrow(read, MARKS)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, without those that repeat an earlier key of the task."""
    from zstandard import ZstdCompressor

    seen: set[tuple[int, int]] = set()
    pack = ZstdCompressor(level=3).compress
    for batch in batches:
        on, texts = [], []
        for i, k in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            if k not in seen:
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(k)
                on.append(i)
                texts.append(pack(batch.column(2)[i].as_py()))
        kept = batch.select([0, 1]).take(pa.array(on, pa.int64()))
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(texts, pa.binary())], ["k1", "k2", "packed"])


CONTEXTS = "hash bigint, f1 bigint, f2 bigint, tid bigint, place int, low int, high int"


def contexts(suspects: DataFrame, length: int) -> DataFrame:
    """The contexts of the ends named in ``places``, as fingerprints."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest
        from zstandard import ZstdDecompressor

        unpack = ZstdDecompressor().decompress
        names = [c.split()[0] for c in CONTEXTS.split(", ")]
        for batch in batches:
            for tid, packed, places in zip(*(c.to_pylist() for c in batch.columns)):
                text = unpack(packed)
                data = np.frombuffer(text, np.uint8)
                p = Parse(data, np.array([0, len(text)]), length)
                on = np.flatnonzero(np.isin(p.at, np.array(places, np.int64)))
                at, low, high = p.at[on], p.low[on], p.high[on]
                prints = b"".join(xxh3_128_digest(text[a - h : a - lo + length], h * length + lo) for a, h, lo in zip(at.tolist(), high.tolist(), low.tolist()))
                f = np.frombuffer(prints, "<i8").reshape(-1, 2)
                int32 = lambda x: pa.array(x.astype(np.int32))
                columns = [pa.array(behind(data, at, length - _reach(length))), pa.array(f[:, 0].copy()), pa.array(f[:, 1].copy())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(at), tid)), int32(at), int32(low), int32(high)], names)

    return suspects.select("tid", "packed", "places").mapInArrow(read, CONTEXTS)


# What becomes of a context: repeated as it is; to be ordered with others of its hash, being found once or one
# of equal ones; and, in addition, the first and the last of each task.
REPEATED, RIM, FIRST, LAST = range(4)
SORTED = "kind int, part int, hash bigint, f1 bigint, f2 bigint, tid bigint, place int, low int, high int, n int"


def _settled(found: DataFrame) -> DataFrame:
    """Contexts in order, each told by its neighbours. ``n`` is 1 for those found once, else 2.

    A task's first and last context are left to ``_edges`` if no neighbour in the task equals them.
    """
    schema = pa.schema([(c.split()[0], {"int": pa.int32(), "bigint": pa.int64()}[c.split()[1]]) for c in SORTED.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        out: list[tuple] = []
        head = run = None
        size = runs = 0
        beside = False

        def close(next_hash):
            """The run is complete; one of it is ordered if its hash has other contexts, or might have."""
            if size > 1 and (beside or next_hash in (None, run[0]) or runs == 1):
                out.append((RIM, part, run[0], None, None, *run[3:], 2))
            if size == 1 and runs > 1 and next_hash is not None and (beside or next_hash == run[0]):
                out.append((RIM, part, run[0], None, None, *run[3:], 1))

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if run and row[:3] == run[:3]:
                    if size == 1:
                        out.append((REPEATED, None, None, None, None, *run[3:], None))
                    out.append((REPEATED, None, None, None, None, *row[3:], None))
                    size += 1
                    continue
                if run:
                    if runs == 1:
                        head = (FIRST, part, *run, min(size, 2))
                    close(row[0])
                    beside = run[0] == row[0]
                run, size, runs = row, 1, runs + 1
            if out:
                yield batch_of(out)
                out = []
        if run:
            close(None)
            last = (LAST, part, *run, min(size, 2))
            yield batch_of([*out, head or (FIRST, *last[1:]), last])

    order = ["hash", "f1", "f2", "tid", "place"]
    placed = found.repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.mapInArrow(read, SORTED)


def _edges(settled: DataFrame) -> DataFrame:
    """The contexts that only the next task's tell: two rows of each task come to the driver."""
    rows = settled.where(F.col("kind") >= FIRST).orderBy("part", "kind").collect()
    key = lambda r: (r["hash"], r["f1"], r["f2"])
    out = {}
    for i, r in enumerate(rows):
        if r["n"] > 1:
            continue
        near = [rows[j] for j in (i - 1, i + 1) if 0 <= j < len(rows)]
        twice = any(key(x) == key(r) and (x["tid"], x["place"]) != (r["tid"], r["place"]) for x in near)
        # A task's only context is its first and its last.
        same = (r["tid"], r["place"])
        if twice or same not in out:
            kind = REPEATED if twice else RIM
            out[same] = (kind, r["part"], r["hash"], None, None, r["tid"], r["place"], r["low"], r["high"], 1)
    return settled.sparkSession.createDataFrame(list(out.values()), SORTED)


CUT = "hash bigint, tid bigint, place int, low int, high int, n int, phrase binary, follow binary"


def _cut_out(texts: DataFrame, length: int) -> DataFrame:
    """The phrase's bytes before each of ``ends``, last one first, and those behind it."""
    schema = pa.schema(
        [("hash", pa.int64()), ("tid", pa.int64()), ("place", pa.int32()), ("low", pa.int32()), ("high", pa.int32()), ("n", pa.int32()), ("phrase", pa.binary()), ("follow", pa.binary())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdDecompressor

        unpack = ZstdDecompressor().decompress
        for batch in batches:
            for tid, packed, ends in zip(*(c.to_pylist() for c in batch.columns)):
                text = unpack(packed)
                rows = []
                for e in ends:
                    at = e["place"]
                    rows.append({**e, "tid": tid, "phrase": text[at - e["high"] : at][::-1], "follow": text[at : at - e["low"] + length]})
                yield pa.RecordBatch.from_pylist(rows, schema)

    return texts.select("tid", "packed", "ends").mapInArrow(read, CUT)


def followers(follow: list[bytes]) -> Iterator[tuple[list[int], list[int]]]:
    """For each of sorted strings the places from which on all agree with it, by number of bytes.

    (agree, places), ascending: strings from place ``places[i]`` on agree in more than
    ``agree[i]`` bytes. The lists are reused.
    """
    agree, places = [-1], [0]
    for i, x in enumerate(follow):
        if i:
            n = common(follow[i - 1], x)
            while agree[-1] >= n:
                agree.pop()
                places.pop()
            agree.append(n)
            places.append(i)
        yield agree, places


def repeated_starts(group: list[dict], length: int) -> list[tuple[int, int, int]]:
    """(tid, first start, last start) of repeated strings in the contexts of one hash that are found once."""
    found: list[list[tuple[int, int]]] = [[] for _ in group]
    once = [i for i, c in enumerate(group) if c["n"] == 1]
    if not once or len(group) < 2:
        return []
    # The dictionary's order: equal phrases stand together, followers that share most next to each other.
    order = sorted(range(len(group)), key=lambda i: (group[i]["phrase"], group[i]["follow"]))
    most_phrase = most_follow = 0
    for i, j in zip(order, order[1:]):
        a, b = group[i], group[j]
        if a["phrase"] == b["phrase"]:
            least = length - common(a["follow"], b["follow"])
            found[i].append((least, a["high"]))
            found[j].append((least, b["high"]))
        else:
            most_phrase = max(most_phrase, common(a["phrase"], b["phrase"]))
    # The parse's order: the same for equal followers.
    order = sorted(range(len(group)), key=lambda i: (group[i]["follow"], group[i]["phrase"]))
    for i, j in zip(order, order[1:]):
        a, b = group[i], group[j]
        if a["follow"] == b["follow"]:
            most = common(a["phrase"], b["phrase"])
            found[i].append((a["low"], most))
            found[j].append((b["low"], most))
        else:
            most_follow = max(most_follow, common(a["follow"], b["follow"]))
    low, high = length - most_follow, most_phrase

    def open_(i: int) -> Iterator[int]:
        for x in range(max(group[i]["low"], low), min(group[i]["high"], high) + 1):
            if not any(a <= x <= b for a, b in found[i]):
                yield x

    if low <= high and any(next(open_(i), None) is not None for i in once):
        # The corpus order, of strings whose equals may differ in both.
        ranks: dict[tuple[bytes, int], int] = {}
        keys: list[list[tuple[bytes, int]]] = [[] for _ in group]
        for i, (agree, places) in zip(order, followers([group[i]["follow"] for i in order])):
            c, at = group[i], 0
            for x in range(min(c["high"], high), max(c["low"], low) - 1, -1):
                # Ascending number of bytes: the last place that agrees in fewer.
                while at + 1 < len(agree) and agree[at + 1] < length - x:
                    at += 1
                key = (c["phrase"][:x], places[at])
                keys[i].append(key)
                ranks[key] = ranks.get(key, 0) + 1
        for i in once:
            found[i] += [(len(k[0]), len(k[0])) for k in keys[i] if ranks[k] > 1]
    out = []
    for i in once:
        c = group[i]
        ranges = [(max(a, c["low"]), min(b, c["high"])) for a, b in found[i]]
        out += [(c["tid"], c["place"] - b, c["place"] - a) for a, b in ranges if a <= b]
    return out


STARTS = "tid bigint, a int, b int"


def _in_groups(cut: DataFrame, length: int) -> DataFrame:
    """``repeated_starts`` of each hash; the rows of one hash are few."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []
        kinds = (pa.int64(), pa.int32(), pa.int32())

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["tid", "a", "b"])

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if group and group[0]["hash"] != row["hash"]:
                    out += repeated_starts(group, length)
                    group = []
                group.append(row)
            if out:
                yield batch_of(out)
        if out := repeated_starts(group, length) if group else []:
            yield batch_of(out)

    return cut.repartition("hash").sortWithinPartitions("hash").mapInArrow(read, STARTS)


RANK = 40
STRINGS = "part int, tid bigint, place int, n int, a int, suffix binary, rank bigint, first binary, last binary, agree array<int>, rows array<bigint>"


def _parse_order(cut: DataFrame, length: int) -> DataFrame:
    """Those strings of the contexts that agree with a neighbour behind the end, with their follower's rank.

    Rows are sorted by what follows, over any number of tasks. A string takes as rank the row from
    which on all agree with it as far as it goes. Where that lies before the task's first row, the
    rank is NULL and ``_ranked`` fills it in from the last row of each task (``suffix`` NULL).
    Whoever agrees with a row in most bytes is its neighbour: strings that need more have
    no equal. Over the borders of tasks they may have.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        names = [c.split()[0] for c in STRINGS.split(", ")]
        schema = pa.schema(
            list(zip(names, [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]))
        )
        empty = dict.fromkeys(names)
        first = waiting = None
        agree: list[int] = []
        rows: list[int] = []
        place = before = 0

        def strings(row: dict, shared: int) -> Iterator[dict]:
            """What ``row`` may share with a neighbour, ``shared`` bytes behind the end at most."""
            at = 0
            for a in range(row["high"], max(row["low"], length - shared) - 1, -1):
                # Ascending number of bytes: the last row that agrees in fewer.
                while at < len(agree) and agree[at] < length - a:
                    at += 1
                yield {**empty, "part": part, **{c: row[c] for c in ("tid", "place", "n")}, "a": a, "suffix": row["phrase"][:a], "rank": rows[at - 1] if at else None}

        for batch in batches:
            out: list[dict] = []
            for row in batch.to_pylist():
                if waiting is None:
                    # What the task before ends with is not known here.
                    first, shared = row["follow"], length
                else:
                    shared = common(waiting["follow"], row["follow"])
                    out += strings(waiting, max(before, shared))
                    while agree and agree[-1] >= shared:
                        agree.pop()
                        rows.pop()
                    agree.append(shared)
                    rows.append((part << RANK) + place)
                waiting, before = row, shared
                place += 1
            yield pa.RecordBatch.from_pylist(out, schema)
        if waiting is not None:
            out = [*strings(waiting, length), {**empty, "part": part, "first": first, "last": waiting["follow"], "agree": agree, "rows": rows}]
            yield pa.RecordBatch.from_pylist(out, schema)

    # The other columns deal ties out.
    order = ["follow", "tid", "place"]
    return cut.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(read, STRINGS)


def _ranked(found: DataFrame, length: int) -> DataFrame:
    """``found`` with every rank; what tasks pass on to the next comes to the driver, one row each."""
    depths = range(length - _reach(length), length + 1)
    base: dict[int, list[int]] = {}
    before = None
    for r in found.where("suffix IS NULL").orderBy("part").collect():
        own = r["part"] << RANK
        shared = common(before["last"], r["first"]) if before else -1
        values = []
        for i, depth in enumerate(depths):
            if shared < depth:
                values.append(own)
            else:
                inside = [x for x, y in zip(before["rows"], before["agree"]) if y < depth]
                values.append(inside[-1] if inside else base[before["part"]][i])
        base[r["part"]] = values
        before = r
    known = found.sparkSession.createDataFrame(list(base.items()), "part int, base array<bigint>")
    rows = found.where("suffix IS NOT NULL").join(F.broadcast(known), "part")
    rank = F.coalesce("rank", F.get("base", F.lit(length - depths[0]) - F.col("a")))
    return rows.select("tid", "place", "n", "a", "suffix", rank.alias("rank"))


def _dictionary_order(suffixes: DataFrame) -> DataFrame:
    """Distinct phrase suffixes in order: (suffix, suffix_rank)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << RANK
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.arange(at, at + len(batch)))], ["suffix", "suffix_rank"])
            at += len(batch)

    distinct = suffixes.select("suffix").distinct()
    return distinct.repartitionByRange("suffix").sortWithinPartitions("suffix").mapInArrow(read, "suffix binary, suffix_rank bigint")


def _over_ranges(cut: DataFrame, length: int) -> DataFrame:
    """The starts of repeated strings in hot groups, by sorts over all of them."""
    strings = materialize(_ranked(materialize(_parse_order(cut, length), "parse-order"), length), "strings")
    corpus = strings.join(pinned(_dictionary_order(strings)), "suffix").select("tid", "place", "n", "a", "suffix_rank", "rank")
    twice = corpus.groupBy("suffix_rank", "rank").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    found = corpus.where("n = 1").join(pinned(twice.select("suffix_rank", "rank")), ["suffix_rank", "rank"])
    start = F.col("place") - F.col("a")
    return found.select("tid", start.alias("a"), start.alias("b"))


def _rim(rim: DataFrame, suspects: DataFrame, length: int, group: int) -> DataFrame:
    """The starts of repeated strings in contexts found once."""
    sizes = rim.groupBy("hash").agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("least"))
    # A hash whose contexts are all repeated has nothing to find.
    sizes = pinned(sizes.where("size > 1 AND least = 1").select("hash", (F.col("size") > group).alias("hot")))
    rows = rim.join(sizes, "hash")
    end = F.struct("hash", "place", "low", "high", "n")
    texts = suspects.select("tid", "packed")
    cut = lambda rows: _cut_out(texts.join(rows.groupBy("tid").agg(F.collect_list(end).alias("ends")), "tid"), length)
    found = _in_groups(cut(rows.where(~F.col("hot"))), length)
    if rows.where("hot").isEmpty():
        return found
    return found.unionByName(_over_ranges(materialize(cut(rows.where("hot")), "hot-contexts"), length))


def _texts_with_repeats(texts: DataFrame, length: int, group: int) -> tuple[DataFrame, DataFrame]:
    """(k1, k2, spans, kept) of the texts with repeats in them, and the keys of copied texts."""
    if length - _reach(length) < WINDOW:
        raise ValueError(f"strings of {length} bytes are too short to hold a trigger and its context")
    texts = texts.where(F.octet_length("_text") >= length)
    marks = materialize(parsed(texts, length), "phrase-ends")
    copied = marks.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*KEY)
    named = marks.where("hashes IS NOT NULL").groupBy(*KEY).agg(F.min("tid").alias("tid"))
    ends = marks.select("tid", F.inline(F.arrays_zip(F.col("hashes").alias("hash"), F.col("places").alias("place"))))
    often = pinned(ends.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"))
    places = ends.join(often, "hash").groupBy("tid").agg(F.collect_list("place").alias("places"))
    wanted = places.join(pinned(named), "tid")
    packed = texts.select(*KEY, "_text").mapInArrow(_packed, "k1 bigint, k2 bigint, packed binary")
    suspects = packed.join(pinned(wanted), KEY).dropDuplicates(KEY).select("tid", *KEY, "packed", "places")
    suspects = materialize(suspects, "suspects")
    settled = materialize(_settled(contexts(suspects, length)), "settled-contexts")
    settled = settled.where(F.col("kind") < FIRST).unionByName(_edges(settled))
    start = lambda c: (F.col("place") - F.col(c)).alias("a" if c == "high" else "b")
    inside = settled.where(F.col("kind") == REPEATED).select("tid", start("high"), start("low"))
    rim = settled.where(F.col("kind") == RIM).select("hash", "tid", "place", "low", "high", "n")
    starts = inside.unionByName(_rim(rim, suspects, length, group))
    runs = starts.groupBy("tid").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("starts"))
    return _merged(suspects.select("tid", *KEY, "packed").join(runs, "tid"), length), copied


def _merged(texts: DataFrame, length: int) -> DataFrame:
    """Runs of starts as spans, and the bytes outside them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdDecompressor

        unpack = ZstdDecompressor().decompress
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans, kept = [], []
            for packed, starts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                text, merged = unpack(packed), []
                for x in starts:
                    if merged and x["a"] <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], x["b"] + length)
                    else:
                        merged.append({"start": x["a"], "end": x["b"] + length})
                inner = [0, *(x for s in merged for x in (s["start"], s["end"])), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(inner[::2], inner[1::2])))
                spans.append(merged)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(spans, span), pa.array(kept, pa.binary())], ["k1", "k2", "spans", "kept"])

    return texts.select(*KEY, "packed", "starts").mapInArrow(read, "k1 bigint, k2 bigint, spans array<struct<start: bigint, end: bigint>>, kept binary")


def _joined(rows: DataFrame, answers: DataFrame, copied: DataFrame) -> DataFrame:
    """``rows`` with what was found for their text; ``whole`` for copied texts."""
    whole = pinned(copied.withColumn("whole", F.lit(True)))
    return rows.join(pinned(answers), KEY, "left").join(whole, KEY, "left").withColumn("whole", F.coalesce("whole", F.lit(False)))


def without_repeats(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``docs`` with ``spans`` of repeated bytes and ``kept``, the text without them, as binary.

    Columns of these two names are replaced.
    """
    rows = _keyed(docs.select("text", F.struct(*docs.columns).alias("_row")))
    found, copied = _texts_with_repeats(rows.select(*KEY, "_text"), length, group)
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.octet_length("_text").cast("bigint").alias("end")))
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return _joined(rows, found, copied).select(
        *[F.col(f"_row.`{c}`") for c in docs.columns if c not in ("spans", "kept")],
        F.when(F.col("whole"), whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(F.col("whole"), F.lit(b"")).otherwise(F.coalesce("kept", "_text")).alias("kept"),
    )


def repeats_digest(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans and kept_sha256.

    Only texts with repeats are looked at again; the others' digest is taken on the way in.
    """
    rows = _keyed(docs.select("doc_id", "text"))
    found, copied = _texts_with_repeats(rows.select(*KEY, "_text"), length, group)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"])
    found = found.select(*KEY, removed.alias("_removed"), F.size("spans").cast("bigint").alias("_spans"), F.sha2("kept", 256).alias("_sha"))
    narrow = rows.select("doc_id", *KEY, F.octet_length("_text").cast("bigint").alias("n_bytes"), F.sha2("_text", 256).alias("_all"))
    nothing = F.sha2(F.lit(b""), 256)
    whole = F.col("whole")
    return _joined(narrow, found, copied).select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(whole, nothing).otherwise(F.coalesce("_sha", "_all")).alias("kept_sha256"),
    )

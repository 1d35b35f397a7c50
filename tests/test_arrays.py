"""Arrays cut at any byte against the json library."""

import json
import random

import pytest
from pyspark.sql import functions as F

from foliant.checks import edge_queries
from foliant.operators.summaries import parse_summary
from foliant.sources import readers as r
from foliant.sources.arrays import HEAD, MIDDLE, TAIL, WHOLE, _Cutter, _structural, array_elements, split_starts

TEXT = ['a', 'é', '}', '{', '[', ']', ',', '"', '\\', '\\"', 'x}y', '\n', ' ', '\\\\"', '😀', '":"']


def value(rng, depth=0):
    kind = rng.randint(0, 7 if depth < 4 else 3)
    if kind <= 2:
        return "".join(rng.choices(TEXT, k=rng.randint(0, 6)))
    if kind == 3:
        return rng.choice([1, -2.5, None, True])
    if kind == 4:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {"".join(rng.choices(TEXT, k=2)): value(rng, depth + 1) for _ in range(rng.randint(0, 3))}


def made(seed):
    rng = random.Random(seed)
    items = [value(rng, rng.randint(0, 2)) for _ in range(rng.randint(0, 12))]
    text = json.dumps(items, indent=rng.choice([None, None, 0, 1, 2, 4]), ensure_ascii=rng.random() < 0.3)
    return items, rng.choice(["", "\n ", "﻿"]) + text + rng.choice(["", "\n", "  \n "]), rng


def elements(data: bytes, splits: list[list[bytes]], ended: bool) -> list[bytes]:
    """What tasks do, one after the other: each split with the start that those before it leave."""
    out, open_, inside, depth = [], None, 0, 0
    for n, chunks in enumerate(splits):
        last = n == len(splits) - 1
        cutter = _Cutter(inside, depth, n == 0)
        whole = b"}".join(chunks) + (b"" if last and not ended else b"}")
        found = []
        for i in range(0, len(chunks)):
            tail = b"" if last and not ended and i == len(chunks) - 1 else b"}"
            found += cutter.feed(chunks[i] + tail)
        for kind, piece in [*found, *cutter.finish()]:
            if kind == WHOLE:
                out.append(piece)
            elif kind == TAIL:
                open_ = piece
            elif kind == MIDDLE:
                open_ += piece
            elif kind == HEAD:
                out.append(open_ + piece)
                open_ = None
        _, kinds = _structural(whole, commas=False)
        for k in kinds.tolist():
            if k == ord('"'):
                inside ^= 1
            elif not inside:
                depth += {123: 1, 91: 1, 125: -1, 93: -1}[k]
    if open_ is not None:
        out.append(open_)
    return out


@pytest.mark.parametrize("block", range(20))
def test_any_cut_of_any_array(block):
    for seed in range(block * 60, block * 60 + 60):
        items, text, rng = made(seed)
        data = text.encode()
        ended = data.endswith(b"}")
        chunks = data.split(b"}")[: -1 if ended else None]
        splits, at = [], 0
        while at < len(chunks):
            n = rng.randint(1, 4)
            splits.append(chunks[at : at + n])
            at += n
        got = [x for x in elements(data, splits, ended) if x.strip()]
        assert [json.loads(x, strict=False) for x in got] == items, text


def rows(df):
    return [x.value for x in df.withColumn("at", _place()).orderBy("file", "block", "at").collect()]


def _place():
    from pyspark.sql import functions as F

    return F.monotonically_increasing_id()


@pytest.fixture
def small_splits(spark):
    """Splits of a few bytes; each is a task of its own."""
    names = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": None}
    for n in names:
        names[n] = spark.conf.get(n)

    def resize(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield resize
    for n, v in names.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("seed, size", [(1, 37), (11, 200), (17, 1 << 20)])
def test_spark_splits(spark, write, small_splits, seed, size):
    files = [made(s) for s in range(seed * 100, seed * 100 + 3)]
    paths = [write(text, f"f{i}.json") for i, (_, text, _) in enumerate(files)]
    small_splits(size)
    for path, (items, _, _) in zip(paths, files):
        assert [json.loads(x, strict=False) for x in rows(array_elements(spark, path)) if x.strip()] == items
    together = rows(array_elements(spark, paths))
    assert [json.loads(x, strict=False) for x in together if x.strip()] == [x for items, _, _ in files for x in items]


BOOKS = [{"book_id": str(n), "title": f"T{n} }}, {{ \"q\" \\", "authors": [{"author_id": str(n)}], "description": "x" * (n % 90)} for n in range(300)]


@pytest.mark.parametrize("indent", [None, 1, 4])
def test_equals_the_reader_of_whole_files(spark, write, small_splits, indent):
    path = write(json.dumps(BOOKS, indent=indent), f"books{indent}")
    small_splits(1500)
    split = r.read_books_json_array(spark, path, "split")
    assert split_starts(spark, path).count() > 15
    whole = r.read_books_json_array(spark, path, "whole")
    fields = lambda df: [x.plain.book_id + x.plain.title for x in df.orderBy("pos").collect()]
    assert fields(split) == fields(whole) == [b["book_id"] + b["title"] for b in BOOKS]
    assert split.rdd.getNumPartitions() > 15


def test_broken_arrays(spark, write):
    def counts(text):
        row = parse_summary(r.read_books_json_array(spark, write(text, str(abs(hash(text)))), "split", keep_malformed=True)).head()
        return row.records, row.parse_errors

    assert counts('[{"book_id":"1"') == (0, 1)
    assert counts('[{"book_id":"1"}') == (1, 0)
    assert counts('[{"book_id":"1"}, {"book_id":') == (1, 1)
    assert counts('[{"book_id":"1"}, {oops}, 3, "x", {"book_id":"2"}]') == (2, 3)
    assert counts('[{"book_id":"1"}}, {"book_id":"2"}]') == (1, 1)
    assert counts('[{"book_id":"1"}] trailing {"book_id":"2"}') == (1, 0)
    assert counts('x [{"book_id":"1"}]') == (0, 1)
    assert counts("[]") == counts(" \n") == counts("") == (0, 0)


def test_compressed_array(spark, tmp_path):
    import gzip

    path = tmp_path / "books.json.gz"
    path.write_bytes(gzip.compress(json.dumps(BOOKS, indent=2).encode()))
    assert r.read_books(spark, str(path)).count() == len(BOOKS)


def test_array_of_one_giant_element(spark, write, small_splits):
    book = {"book_id": "1", "title": "t", "authors": [{"author_id": str(n)} for n in range(2000)]}
    path = write(json.dumps([book, BOOKS[1]], indent=2), "giant")
    small_splits(4000)
    found = r.read_books_json_array(spark, path, "split").orderBy("pos").collect()
    assert [len(x.plain.authors) for x in found] == [2000, 1]


def test_an_array_file_holds_a_bounded_number_of_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(edge_queries, "FILE_RECORDS", 10, raising=False)
    rows = spark.range(100).select(F.concat(F.lit('{"book_id":"'), F.col("id").cast("string"), F.lit('"}')).alias("json"), F.col("id").alias("n"))
    edge_queries._array_files(rows, str(tmp_path / "a"), "\n")
    assert len(list((tmp_path / "a").glob("part-*.txt"))) >= 9
    assert array_elements(spark, str(tmp_path / "a")).where("value LIKE '%book_id%'").count() == 100


def test_starts_of_splits_are_found_once(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"x": 1}, {"x": 2}]')
    plan = array_elements(spark, str(tmp_path / "a.json"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2

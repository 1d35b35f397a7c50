"""Positions over any number of rows, deep pages, scans that stop early, log bytes, checkpoint repair."""

import json
import random

import pytest
from pyspark.sql import functions as F

from foliant.operators import ranking
from foliant.operators.predicates import SearchSpec
from foliant.operators.ranking import deep_page, positions, result_position, sort_keys
from foliant.plans import crawl, search
from foliant.sources import readers as r, writers as w


def ranked(rows):
    order = sorted(rows, key=lambda x: x[0])
    return [x[0] for x in sorted(order, key=lambda x: (x[1] is None, -(x[1] or 0)))]


def test_positions_of_all_rows(spark):
    rng = random.Random(3)
    rows = [(f"{i:04}", rng.choice([None, 1.0, 1.0, rng.random()])) for i in range(1500)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "book_id string, average_rating double").repartition(7)
    want = {b: n for n, b in enumerate(ranked(rows), 1)}
    assert {x.book_id: x.position for x in positions(df, sort_keys("rating")).collect()} == want
    page = deep_page(df, sort_keys("rating"), 50, 1200).orderBy("position").collect()
    assert [x.book_id for x in page] == ranked(rows)[1200:1250] and page[0].position == 1201
    assert deep_page(df, sort_keys("rating"), 10, 5000).count() == positions(df.limit(0), sort_keys("rating")).count() == 0


def test_pages_beyond_one_task(spark, monkeypatch):
    df = spark.createDataFrame([(str(i), float(i % 5)) for i in range(60)], "book_id string, average_rating double")
    one = result_position(df, sort_keys("rating"), limit=60).collect()
    monkeypatch.setattr(ranking, "ONE_TASK", 10)
    many = result_position(df, sort_keys("rating"), limit=60)
    assert "Window" not in many._jdf.queryExecution().toString()
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, one))


@pytest.fixture
def many_files(tmp_path):
    for n in range(30):
        lines = [json.dumps({"book_id": str(n * 10 + i), "title": "ring" if i % 3 else "other", "is_ebook": "true"}) for i in range(10)]
        (tmp_path / f"part-{n:02}.json").write_text("\n".join(lines))
    return str(tmp_path)


def test_a_scan_reads_the_first_files_only(spark, many_files, monkeypatch):
    read, seen = search.read_books, []
    monkeypatch.setattr(search, "read_books", lambda spark, path, format: seen.extend(path) or read(spark, path, format))
    for spec, files in [({"limit": 5}, 1), ({"limit": 6, "offset": 10}, 5), ({"limit": 1000}, 30), ({"limit": 3, "offset": 500}, 30)]:
        seen.clear()
        spec = SearchSpec(title_query="RING", sort_by=None, **spec)
        got = [(x.position, x.book_id) for x in search.scan_first(spark, many_files, spec).orderBy("position").collect()]
        want = search.scan_search(r.read_books_jsonl(spark, many_files), spec)
        assert got == [(x.position, x.book_id) for x in want.orderBy("position").collect()]
        assert len(seen) == files and sorted(seen) == seen
    assert search.scan_first(spark, many_files, SearchSpec(limit=0, sort_by=None)).count() == 0


def test_undecodable_bytes_are_left_out(spark, tmp_path):
    rng = random.Random(1)
    pieces = [b"a", b"97", "é".encode(), "�".encode(), "😀".encode(), "ࠀ".encode(), b"\xff", b"\xc0\xaf", b"\xed\xa0\x80", b"\xe2\x82", b"\xf0\x9f\x98", b"\x80", b"\xf4\x90\x80\x80", b"\xc3", b"\xef\xbf"]
    lines = [b"".join(rng.choices(pieces, k=rng.randint(0, 9))) for _ in range(600)]
    path = tmp_path / "log"
    path.write_bytes(b"\n".join(lines) + b"\n")
    got = [x.value for x in r.read_crawl_log(spark, str(path)).collect()]
    assert got == [x.decode("utf-8", "ignore") for x in lines]


def test_repair_of_a_stored_checkpoint(spark, tmp_path):
    checkpoint, log = str(tmp_path / "checkpoint"), tmp_path / "log"
    rows = [("978001", "failed"), ("978002", "failed"), ("978003", "duplicate")]
    w.write_checkpoint(spark.createDataFrame(rows, "isbn string, disposition string"), checkpoint, chunks=2)
    log.write_bytes(b"Book '403 Forbidden' for ISBN 978\xff002\n")
    assert crawl.repair_store(spark, checkpoint, str(log), chunks=2) == {"original_failed": 2, "restored": 1, "new_failed": 1}
    left = {(x.isbn, x.disposition) for x in r.read_checkpoint(spark, checkpoint).collect()}
    assert left == {rows[0], rows[2]}
    log.write_text("nothing\n")
    before = sorted(p.name for p in (tmp_path / "checkpoint").iterdir())
    assert crawl.repair_store(spark, checkpoint, str(log), chunks=2)["restored"] == 0
    assert sorted(p.name for p in (tmp_path / "checkpoint").iterdir()) == before

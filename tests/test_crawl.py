import pytest

from foliant.operators.sets import blocked_isbns, collect_dispositions, merge_checkpoint, split_queue
from foliant.operators.summaries import (
    checkpoint_summary, clean_summary, pivot_signals, queue_summary, restore_summary,
)
from foliant.plans.crawl import (
    build_queue, clean_books, flag_books, new_dispositions, removed_isbns, repair_checkpoint, saved_books,
    triage_pages,
)
from foliant.schemas import SCRAPED_FIELDS, ddl
from foliant.sources.writers import rewrite_clean_books

REVIEW = [("A", None, 1, 0, None, False, "t")]


def books(spark):
    rows = [
        # ISBN, Title, Review, Point, Language, bucket
        ("9780000000001", "a", [], 4.0, None, "keep"),
        ("9791000000001", "b", [], 4.0, None, "non_english"),
        (None, "c", [], 4.0, None, "keep"),
        ("9780000000002", "d", [], 0.0, "French", "non_english"),
        ("9780000000003", "e", REVIEW, 0.0, "English", "keep"),
        ("9780000000004", "f", [], 0.0, "English", "failed"),
        ("9780000000005", "a ", None, None, "English", "failed"),
        ("9780000000006", "A", [], 1.0, "English", "keep"),
        (None, "g", [], 0.0, None, "failed"),
        ("", "h", [], 2.0, "", "keep"),
    ]
    full = [(r[0], r[1], "", [], r[2], r[3], r[4], 0, 0, 0, 0) for r in rows]
    return spark.createDataFrame(full, ddl(SCRAPED_FIELDS)), {r[1]: r[5] for r in rows}


def test_clean_books(spark, tmp_path):
    df, want = books(spark)
    assert {x.Title: x.bucket for x in flag_books(df).collect()} == want
    kept = {x.Title: x.Language for x in clean_books(df).collect()}
    assert kept == {"a": "English", "c": None, "e": "English", "A": "English", "h": ""}
    removed = {(x.isbn, x.disposition) for x in removed_isbns(df).collect()}
    assert removed == {
        ("9791000000001", "non_english"), ("9780000000002", "non_english"), ("9780000000004", "failed"),
        ("9780000000005", "failed"),
    }
    assert clean_summary(flag_books(df)).first().asDict() == {"loaded": 10, "removed": 5}
    path = str(tmp_path / "store")
    assert rewrite_clean_books(clean_books(df), 0, path) is False
    assert rewrite_clean_books(clean_books(df), 5, path) is True
    assert spark.read.json(path).count() == 5


def isbns(spark, values):
    return spark.createDataFrame([(v,) for v in values], "isbn string")


def entries(spark, rows):
    return spark.createDataFrame(rows, "isbn string, disposition string")


def test_queue(spark):
    listed = ["9780000000001", "9780000000009", "9780000000009", "9791000000009", "030640615X", "9780000000004"]
    store = clean_books(books(spark)[0])
    checkpoint = entries(spark, [("9780000000004", "failed"), ("5", "duplicate"), ("5", "failed")])
    queue = build_queue(isbns(spark, listed), store, checkpoint)
    assert sorted(x.isbn for x in queue.english.collect()) == ["9780000000009"] * 2
    summary = queue_summary(queue.processed, queue.rows).first().asDict()
    # Processed: three stored ISBNs and two distinct ones of the checkpoint.
    assert summary == {"total": 9, "processed": 5, "remaining_english": 2, "skipped_non_english": 2}
    english = split_queue(isbns(spark, listed)).where("is_english").select("isbn").distinct()
    covered = queue.english.select("isbn").union(queue.processed)
    assert english.exceptAll(covered.distinct()).count() == 0


LOG = [
    "2024 [ERROR] Book '403 Forbidden' for ISBN 111 skipped", "2024 [INFO] saved ISBN 222",
    "2024 [ERROR] 403 Forbidden ISBN: 333", "2024 [ERROR] 403 Forbidden without number",
    "2024 [ERROR] Book '403 Forbidden' for ISBN 111 again",
]


@pytest.mark.parametrize("lines,want", [
    (LOG, {"111"}), (LOG[1:4], {"333"}), ([LOG[1], LOG[3]], set()), ([], set()),
    (["403 Forbidden for ISBN 7", "403 Forbidden ISBN:8", "403 Forbidden ISBN 9x"], {"7", "8", "9"}),
])
def test_blocked_isbns(spark, lines, want):
    log = spark.createDataFrame([(x,) for x in lines], "value string")
    rows = [x.isbn for x in blocked_isbns(log).collect()]
    assert sorted(rows) == sorted(want)


def test_repair(spark):
    checkpoint = entries(spark, [("111", "failed"), ("5", "failed"), ("111", "duplicate"), ("5", "failed")])
    log = spark.createDataFrame([(x,) for x in LOG], "value string")
    repair = repair_checkpoint(checkpoint, log)
    rows = lambda df: sorted((x.isbn, x.disposition) for x in df.collect())
    want = [("111", "duplicate"), ("5", "failed"), ("5", "failed")]
    assert rows(repair.checkpoint) == want
    assert rows(repair_checkpoint(repair.checkpoint, log).checkpoint) == want
    summary = restore_summary(repair.flagged).first().asDict()
    assert summary == {"original_failed": 3, "restored": 1, "new_failed": 2}


def test_checkpoint_sets(spark):
    first = entries(spark, [("1", "failed"), ("2", "failed")])
    merged = merge_checkpoint(first, first, entries(spark, [("2", "duplicate"), ("1", "failed")]))
    assert {x.disposition: x.isbns for x in checkpoint_summary(merged).collect()} == {"failed": 2, "duplicate": 1}
    whole = collect_dispositions(merged, digits=0).collect()
    assert {x.disposition: x.isbns for x in whole} == {"failed": ["1", "2"], "duplicate": ["2"]}
    pieces = collect_dispositions(merged).collect()
    assert sorted((x.disposition, i) for x in pieces for i in x.isbns) == [("duplicate", "2"), ("failed", "1"), ("failed", "2")]
    assert all(len(x.chunk) == 2 for x in pieces)


def test_pivot_signals_last_wins(spark):
    rows = [(1, "R", 5, 1), (1, "R", 6, 3), (1, "W", 7, 2), (2, "X", 1, 1)]
    df = spark.createDataFrame(rows, "page int, name string, count bigint, at int")
    got = pivot_signals(df, "page", "name", "count", "at", {"R": "reading", "W": "wanted"}).orderBy("page").collect()
    assert [tuple(x) for x in got] == [(1, 6, 7), (2, 0, 0)]


def page(title="", rating="4.5", body="", lang=None):
    state = ""
    if lang:
        state = (
            '<script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"apolloState":{"Book:1":'
            '{"details":{"language":{"name":"%s"}}}}}}}</script>' % lang
        )
    return f"<html>{state}<h1>{title}</h1><div class='RatingStatistics__rating'>{rating}</div>{body}</html>"


PAGES = [
    # order, url, page title, html, disposition
    (1, "/book/show/1", "t", page("One"), "saved"),
    (2, "/book/show/2", "t", page(" ONE "), "duplicate"),
    (3, "/book/show/3", "403 Forbidden", page("Two"), "blocked"),
    (4, "/book/show/4", "Access Denied", page("Two"), "blocked"),
    (5, "/book/show/5", "t", page("Two", body="No results"), "saved"),
    (6, "/search", "Showing 1-0 of 0 books", "", "failed"),
    (7, "/search", "t", "No results. 403 Forbidden", "failed"),
    (8, "/search", "t", "403 Forbidden", "blocked"),
    (9, "/search", None, None, "failed"),
    (10, "/book/show/10", "t", page("403 Forbidden"), "blocked"),
    (11, "/book/show/11", "t", page(""), "failed"),
    (12, "/book/show/12", "t", page("Three", lang="French"), "non_english"),
    (13, "/book/show/13", "t", page("Three", lang="English"), "saved"),
    (14, "/book/show/14", "t", page("Four", rating="0"), "failed"),
    (15, "/book/show/15", "t", page("Four", rating="no"), "failed"),
    (16, "/book/show/16", "t", page("Four"), "saved"),
    (17, "/book/show/17", "t", page("Stored"), "duplicate"),
]


@pytest.mark.parametrize("staged", [True, False])
def test_triage(spark, staged):
    rows = [(str(p[0]), *p[:4]) for p in PAGES]
    df = spark.createDataFrame(rows, "isbn string, pos int, url string, page_title string, html string")
    known = spark.createDataFrame([("stored",), ("stored",)], "title_key string")
    stage = {} if staged else {"stage": lambda x: x}
    triaged = triage_pages(df, known, order="pos", **stage)
    assert {x.pos: x.disposition for x in triaged.collect()} == {p[0]: p[4] for p in PAGES}
    saved = {x.ISBN: x.Title for x in saved_books(triaged).collect()}
    assert saved == {"1": "One", "5": "Two", "13": "Three", "16": "Four"}
    assert saved_books(triaged).columns == list(SCRAPED_FIELDS)
    noted = {x.isbn for x in new_dispositions(triaged).collect()}
    assert noted == {"2", "6", "7", "9", "11", "12", "14", "15", "17"}


def test_pages_of_equal_order_are_saved_once(spark):
    rows = [("1", "/book/show/1", "t", page("One"))] * 4
    df = spark.createDataFrame(rows, "isbn string, url string, page_title string, html string")
    got = sorted(x.disposition for x in triage_pages(df).collect())
    assert got == ["duplicate"] * 3 + ["saved"]

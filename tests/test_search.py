import json

import pytest
from pyspark.sql import functions as F

from foliant.operators.predicates import SearchSpec, apply_spec
from foliant.operators.ranking import page_summary
from foliant.operators.cards import book_detail, result_cards
from foliant.plans.catalog import build_catalog
from foliant.plans.search import lookup, next_page, scan_search, search, similar
from foliant.sources import readers as r

BOOKS = [
    {
        "book_id": str(n),
        "title": ["Red Ring", "ÉTÉ 100%", "under_score", "back\\slash", "Plain"][n % 5] + f" {n}",
        "description": ["a tale", "Of Rings"][n % 2],
        "isbn": f"978{n}", "isbn13": "X" if n == 3 else "", "asin": f"B{n}",
        "average_rating": str(n % 6), "ratings_count": str(n % 7), "text_reviews_count": str(n % 4),
        "publication_year": str(1990 + n % 9) if n % 8 else "",
        "publisher": "Ace Books" if n % 2 else "tor", "language_code": ["eng", "fre", ""][n % 3],
        "is_ebook": "true" if n % 2 else "false",
        "authors": [{"author_id": str(n % 5), "role": "Editor" if n % 2 else ""}],
        "popular_shelves": [{"name": "to-read", "count": "3"}, {"name": f"s{n % 3}", "count": ""}],
        "similar_books": [str(n + 1), "404"],
    }
    for n in range(40)
]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("search") / "books.json"
    path.write_text("\n".join(json.dumps(b) for b in BOOKS), encoding="utf-8")
    return r.read_books_jsonl(spark, str(path))


@pytest.fixture(scope="module")
def catalog(raw):
    return build_catalog(raw).cache()


def ids(df):
    return [x.book_id for x in df.orderBy("position").collect()]


def brute(keep, sort=lambda b: int(b["ratings_count"]), limit=1000, offset=0):
    found = sorted((b for b in BOOKS if keep(b)), key=lambda b: b["book_id"])
    found.sort(key=sort, reverse=True)
    return [b["book_id"] for b in found[offset:offset + limit]]


year = lambda b: int(b["publication_year"] or 0)
CLEAN = [
    ({}, lambda b: True),
    ({"title_query": "RING"}, lambda b: "ring" in (b["title"] + b["description"]).lower()),
    ({"title_query": "back\\s"}, lambda b: "back\\s" in b["title"]),
    ({"title_query": "été"}, lambda b: "été" in b["title"].lower()),
    ({"isbn_query": "X"}, lambda b: b["book_id"] == "3"),
    ({"isbn_query": "B7"}, lambda b: b["book_id"] == "7"),
    ({"book_id_query": 12}, lambda b: b["book_id"] == "12"),
    ({"rating_min": 0}, lambda b: True),
    ({"rating_min": 2.0, "rating_max": 4}, lambda b: 2 <= int(b["average_rating"]) <= 4),
    ({"reviews_min": 3}, lambda b: int(b["text_reviews_count"]) >= 3),
    ({"publication_year": 1992}, lambda b: year(b) == 1992),
    ({"publication_year_min": 1995}, lambda b: year(b) >= 1995),
    ({"publication_year_max": 1991}, lambda b: year(b) <= 1991),
    ({"language_code": "fre"}, lambda b: b["language_code"] == "fre"),
    ({"language_code": ""}, lambda b: True),
    ({"is_ebook": True}, lambda b: b["is_ebook"] == "true"),
    ({"is_ebook": False}, lambda b: b["is_ebook"] == "false"),
    ({"publisher_query": "BOOK"}, lambda b: "book" in b["publisher"].lower()),
    ({"author_id": 2}, lambda b: b["authors"][0]["author_id"] == "2"),
    ({"shelf": "S1"}, lambda b: b["popular_shelves"][1]["name"] == "s1"),
    ({"is_ebook": True, "rating_min": 1, "shelf": "to-read"}, lambda b: b["is_ebook"] == "true" and int(b["average_rating"]) >= 1),
]


@pytest.mark.parametrize("fields,keep", CLEAN, ids=[str(c[0]) for c in CLEAN])
def test_catalog_and_scan_agree_with_brute_force(catalog, raw, fields, keep):
    spec = SearchSpec(**fields, limit=1000)
    assert ids(search(catalog, spec)) == brute(keep)
    assert ids(scan_search(raw, spec)) == brute(keep)


def test_wildcards_differ(catalog, raw):
    found = lambda fn, src, q: len(ids(fn(src, SearchSpec(title_query=q, limit=1000))))
    assert found(search, catalog, "r_d") == 8 and found(scan_search, raw, "r_d") == 0
    assert found(search, catalog, "re%ing") > 0 and found(scan_search, raw, "re%ing") == 0
    assert found(search, catalog, "00%") == found(scan_search, raw, "00%") == 8
    assert found(scan_search, raw, "r_s") == 8


@pytest.mark.parametrize("sort,key", [
    ("rating", lambda b: int(b["average_rating"])), ("reviews", lambda b: int(b["text_reviews_count"])),
    ("year", year), ("popularity", lambda b: int(b["ratings_count"])), ("other", lambda b: int(b["ratings_count"])),
])
def test_sorts_and_offsets(catalog, raw, sort, key):
    spec = SearchSpec(sort_by=sort, limit=7, offset=5)
    want = brute(lambda b: True, key, 7, 5)
    assert ids(search(catalog, spec)) == want
    assert ids(scan_search(raw, spec)) == want


def test_pages_add_up_to_the_unpaged_result(catalog):
    spec = SearchSpec(sort_by="rating", limit=9)
    pages = []
    for _ in range(6):
        pages += ids(search(catalog, spec))
        spec = next_page(spec)
    assert pages == ids(search(catalog, SearchSpec(sort_by="rating", limit=1000)))
    assert ids(search(catalog, SearchSpec(offset=100))) == []


def test_scan_without_sort_takes_source_order(raw):
    spec = SearchSpec(is_ebook=True, sort_by=None, limit=3, offset=2)
    assert ids(scan_search(raw, spec)) == ["5", "7", "9"]


def test_more_predicates_never_add_rows(catalog):
    broad = SearchSpec(rating_min=1)
    narrow = SearchSpec(rating_min=1, language_code="eng")
    assert apply_spec(catalog, narrow).exceptAll(apply_spec(catalog, broad)).count() == 0


def test_documented_differences_between_catalog_and_scan(spark, write):
    dirty = [
        {"book_id": "1", "title": "a", "average_rating": "bad", "publication_year": "19xx", "popular_shelves": [{"name": " S "}]},
        {"book_id": "1", "title": "b", "average_rating": "bad", "publication_year": "19xx", "popular_shelves": [{"name": " S "}]},
        {"title": "no id", "average_rating": "nan", "popular_shelves": [{"name": "a,b"}]},
    ]
    raw = r.read_books_jsonl(spark, write("\n".join(json.dumps(d) for d in dirty)))
    catalog = build_catalog(raw)
    count = lambda fn, src, **k: fn(src, SearchSpec(**k)).count()
    assert (count(search, catalog), count(scan_search, raw)) == (1, 3)
    assert (count(search, catalog, rating_max=5), count(scan_search, raw, rating_max=5)) == (1, 1)
    assert scan_search(raw, SearchSpec(rating_max=5)).first().title == "no id"
    assert (count(search, catalog, shelf="s"), count(scan_search, raw, shelf="s")) == (1, 0)
    assert (count(search, catalog, shelf="a"), count(scan_search, raw, shelf="a,b")) == (0, 1)
    assert search(catalog, SearchSpec(sort_by="year")).first().publication_year is None
    assert count(scan_search, raw, sort_by="year") == 3


def test_lookup_and_similar(catalog):
    assert lookup(catalog, 5).first().title == "Plain 4".replace("Plain 4", BOOKS[5]["title"])
    assert lookup(catalog, "404").count() == 0
    books = catalog.select("book_id", "title", F.col("record.similar_books").alias("similar_books"))
    found = similar(books, catalog.select("book_id", "title"))
    assert {(x.book_id, x.similar_id) for x in found.collect()} == {(str(n), str(n + 1)) for n in range(39)}
    one = similar(books, catalog.select("book_id", "title"), "7").collect()
    assert [(x.similar_id, x.similar_title) for x in one] == [("8", BOOKS[8]["title"])]


def test_page_summary(catalog):
    full = page_summary(search(catalog, SearchSpec(offset=10)), 2).first()
    assert (full.label, full.shown, full.has_previous, full.has_next) == ("Page 2", "Showing books 11-20", True, True)
    none = page_summary(search(catalog, SearchSpec(offset=100)), 11).first()
    assert (none.rows, none.shown, none.has_next) == (0, "No matches found", False)


def test_cards_and_detail(raw):
    from foliant.operators.normalize import normalize_books

    records = normalize_books(raw).where("book_id in ('1', '8')")
    listed = {x.book_id: x for x in result_cards(records, "list").collect()}
    assert listed["1"].authors == "ID:1 (Editor)" and listed["1"].shelves == "to-read (3), s1"
    assert listed["1"].format == "Ebook" and listed["8"].format == "N/A" and listed["8"].year == "N/A"
    card = {x.book_id: x for x in result_cards(records, "card").collect()}
    assert card["8"].authors == "Author 3" and card["8"].shelves == "to-read, s2"
    assert card["8"].format == "Paperback/N/A" and card["8"].link is None
    detail = {x.book_id: x for x in book_detail(records).collect()}
    assert detail["1"].shelves == "• to-read (3)\n• s1"
    assert (detail["8"].published, detail["8"].edition, detail["8"].pages) == ("N/A", "Standard", "N/A")
    assert detail["1"].published == "1991"


def test_fields_of_raw_records_are_computed_once_for_all_conditions(spark, write):
    raw = r.read_books_jsonl(spark, write('{"book_id": "1", "is_ebook": "true", "average_rating": "3.5"}'))
    found = scan_search(raw, SearchSpec(is_ebook=True, rating_min=2.0, sort_by="rating"))
    assert "Generate inline" in found._jdf.queryExecution().optimizedPlan().toString()
    assert [x.book_id for x in found.collect()] == ["1"]

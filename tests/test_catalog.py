import json

import pytest
from pyspark.sql import Observation, functions as F

from foliant.operators.normalize import surrogate_id
from foliant.operators.summaries import catalog_status
from foliant.plans.catalog import build_catalog, build_catalog_files
from foliant.plans.search import search_page, search_records
from foliant.operators.predicates import SearchSpec
from foliant.sources import readers as r
from foliant.sources.writers import write_catalog


def build(spark, write, records, name="books"):
    path = write("\n".join(json.dumps(x) for x in records), name)
    return {row.book_id: row for row in build_catalog(r.read_books_jsonl(spark, path)).collect()}


CASES = [
    ({"average_rating": "x"}, "average_rating", 0.0),
    ({"average_rating": "nan"}, "average_rating", None),
    ({"average_rating": 4.25}, "average_rating", 4.25),
    ({}, "average_rating", 0.0),
    ({"publication_year": ""}, "publication_year", 0),
    ({}, "publication_year", 0),
    ({"publication_year": "19xx"}, "publication_year", None),
    ({"publication_year": "1999"}, "publication_year", 1999),
    ({"publication_year": 1999.7}, "publication_year", 1999),
    ({"publication_year": "1999.7"}, "publication_year", None),
    ({"ratings_count": "3.0"}, "ratings_count", 0),
    ({"ratings_count": 3.9}, "ratings_count", 3),
    ({"ratings_count": " 12 "}, "ratings_count", 12),
    ({"text_reviews_count": None}, "text_reviews_count", 0),
    ({"is_ebook": "TRUE"}, "is_ebook", True),
    ({"is_ebook": True}, "is_ebook", True),
    ({"is_ebook": 1}, "is_ebook", False),
    ({}, "is_ebook", False),
    ({"title": "", "title_without_series": "T"}, "title", "T"),
    ({"authors": [{"author_id": " 7 "}, {}, 3, {"author_id": ""}]}, "author_ids", ["7"]),
    ({"authors": "none"}, "author_ids", []),
    ({"popular_shelves": [{"name": " To-Read ", "count": "2"}, {"name": ""}]}, "shelves", ["to-read"]),
    ({"publisher": None}, "publisher", ""),
    ({"language_code": 5}, "language_code", "5"),
]


def test_coercion(spark, write):
    got = build(spark, write, [{"book_id": str(n)} | case[0] for n, case in enumerate(CASES)])
    for n, (record, column, want) in enumerate(CASES):
        assert got[str(n)][column] == want, record


def test_last_record_of_an_id_wins_and_idless_ones_are_counted(spark, write):
    records = [
        {"book_id": "1", "title": "old"}, {"title": "no id"}, {"book_id": "", "title": "empty id"},
        {"book_id": 1, "title": "new"}, {"book_id": "2", "title": "two"},
    ]
    path = write("\n".join(json.dumps(x) for x in records))
    seen = Observation("seen")
    rows = build_catalog(r.read_books_jsonl(spark, path), seen).collect()
    assert {x.book_id: x.title for x in rows} == {"1": "new", "2": "two"}
    assert seen.get == {"read": 5, "indexed": 3, "skipped": 2}


def test_last_wins_across_splits(spark, tmp_path):
    lines = [json.dumps({"book_id": str(n % 50), "title": f"v{n}"}) for n in range(5000)]
    (tmp_path / "b.json").write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = r.read_books_jsonl(spark, str(tmp_path / "b.json"))
        assert raw.rdd.getNumPartitions() > 4
        got = {x.book_id: x.title for x in build_catalog(raw).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {str(n): f"v{4950 + n}" for n in range(50)}


def test_scraped_schema(spark, write):
    scraped = {
        "Title": "A", "title": "b", "Desc": "d", "Genre": ["G", "H"], "Point": 0, "RatingsCount": 5, "ISBN": "978",
        "Language": None,
    }
    row = list(build(spark, write, [scraped, {"Title": None, "book_id": "9"}]).values())
    by_title = {x.title: x for x in row}
    a = by_title["A"]
    assert (a.description, a.isbn, a.average_rating, a.ratings_count) == ("d", "978", 0.0, 5)
    assert (a.shelves, a.language_code, a.is_ebook, a.publication_year) == (["g", "h"], "", False, 0)
    assert a.record.popular_shelves[0].asDict() == {"count": "1", "name": "G"}
    assert a.book_id == spark.range(1).select(surrogate_id_of("A")).first()[0]
    assert int(a.book_id) >= 0
    assert by_title[""].book_id == "9"


def surrogate_id_of(title):
    from pyspark.sql import functions as F

    return surrogate_id(F.lit(title))


def test_files_end_to_end(spark, write, tmp_path):
    records = [
        {"book_id": str(n), "title": f"Book {n}", "ratings_count": str(n), "num_pages": str(n), "similar_books": ["1"]}
        for n in range(30)
    ] + [{"title": "x"}]
    source, target = write(json.dumps(records, indent=2)), str(tmp_path / "catalog")
    assert build_catalog_files(spark, source, target) == {"read": 31, "indexed": 30, "skipped": 1, "parse_errors": 0}
    assert build_catalog_files(spark, source, target)["indexed"] == 30
    status = catalog_status(spark, target).first()
    assert (status.available, status.records) == (True, 30)
    assert catalog_status(spark, str(tmp_path / "none")).first().available is False
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        r.load_catalog(spark, str(tmp_path / "none"))
    catalog = r.load_catalog(spark, target)
    spec = SearchSpec(title_query="book", limit=5, offset=2)
    lazy, eager = search_records(catalog, spec).collect(), search_page(catalog, spec).collect()
    assert [x.num_pages for x in lazy] == ["27", "26", "25", "24", "23"]
    assert lazy == eager
    assert lazy[0].similar_books == ["1"]


def test_files_hold_disjoint_ranges(spark, tmp_path):
    rows = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("book_id"), F.col("id").cast("string").alias("isbn"))
    rows = rows.select("*", F.lit("").alias("isbn13"), F.lit("").alias("asin"))
    path = str(tmp_path / "catalog")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_catalog(rows.repartition(8), path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.min("book_id").alias("lo"), F.max("book_id").alias("hi"))
    spans = [(r.lo, r.hi) for r in files.orderBy("lo").collect()]
    assert len(spans) > 1 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    size = sum(f.stat().st_size for f in (tmp_path / "catalog").glob("*.parquet"))
    assert size < 2_000_000

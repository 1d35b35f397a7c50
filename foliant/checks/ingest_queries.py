"""Dump filter, catalog build, file round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.checks import bindings as b
from foliant.checks.registry import query
from foliant.functions.isbn import is_english_isbn, preferred_isbn
from foliant.functions.jsons import json_path, to_json_text
from foliant.functions.text import digits_only, epoch_ms_to_date
from foliant.operators.dedup import keep_last_by_id
from foliant.operators.normalize import normalize_scraped, surrogate_id
from foliant.operators.sets import append_books
from foliant.operators.subjects import raw_prefilter
from foliant.operators.summaries import distinct_isbn_count, ingest_counters
from foliant.plans.catalog import build_catalog
from foliant.plans.crawl import clean_books, removed_isbns
from foliant.plans.novels import novel_counters, novel_isbns
from foliant.schemas import RECORD_FIELDS
from foliant.session import materialize, scratch
from foliant.sources.counters import append_counted, kept_counts
from foliant.sources import readers as r, writers as w

TERMS = {"include": b.NOVEL_TERMS, "exclude": b.OTHER_TERMS, "prefilter": b.NOVEL_TERMS}

CATALOG_ROW = [
    "book_id", "title", "description", "isbn", "isbn13", "asin", "average_rating", "ratings_count",
    "text_reviews_count", "publication_year", "publisher", "language_code", "is_ebook",
]
CATALOG_ROW_SQL = f"""WITH {b.CATALOG_SQL}
    SELECT {', '.join(CATALOG_ROW)}, array_to_string(author_ids, ',') AS authors,
           array_to_string(shelves, ',') AS shelf_names FROM catalog"""


def _catalog_row(catalog):
    return catalog.select(
        *CATALOG_ROW, F.array_join("author_ids", ",").alias("authors"), F.array_join("shelves", ",").alias("shelf_names")
    )


@query("novel_filter", f"WITH {b.EDITIONS_SQL} SELECT DISTINCT isbn FROM novels")
def novel_filter(spark, d):
    return novel_isbns(r.edition_json(b.edition_lines(spark, d)), **TERMS)


@query("distinct_isbn_count", f"WITH {b.EDITIONS_SQL} SELECT count(DISTINCT isbn) AS isbns FROM novels")
def count_isbns(spark, d):
    return distinct_isbn_count(novel_isbns(r.edition_json(b.edition_lines(spark, d)), **TERMS))


# The last digit of a part's key, which its second ISBN ends with.
MALFORMED_SQL = "(p_partkey % 10 IN (1, 2, 3))"


@query("novel_counters", f"""WITH {b.EDITIONS_SQL}
    SELECT count(*) FILTER (regexp_matches(subjects, 'widget|gear|ring')) AS parsed,
           count(*) FILTER (regexp_matches(subjects, 'widget|gear|ring') AND {MALFORMED_SQL}) AS malformed,
           count(*) FILTER (regexp_matches(subjects, 'widget|gear|ring') AND regexp_matches(subjects, 'rod|promo') AND NOT {MALFORMED_SQL}) AS excluded,
           count(DISTINCT isbn) FILTER (regexp_matches(subjects, 'widget|gear|ring') AND NOT regexp_matches(subjects, 'rod|promo') AND NOT {MALFORMED_SQL}) AS isbns
    FROM editions""")
def counters_of_novels(spark, d):
    """Texts that end early, go on after the object, or quote with apostrophes are malformed."""
    editions = r.edition_json(b.edition_lines(spark, d))
    isbn = F.get_json_object("json", "$.isbn_10[0]")
    kind = F.substring(F.btrim(isbn), -1, 1)
    broken = (
        F.when(kind == "1", F.expr("left(json, length(json) - 1)"))
        .when(kind == "2", F.concat("json", F.lit(' {"more": 1}')))
        .when(kind == "3", F.concat(F.lit("{'a': 1, "), F.expr("substring(json, 2)")))
        .otherwise(F.col("json"))
    )
    return novel_counters(editions.select(broken.alias("json")), **TERMS)


@query("raw_prefilter_json", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
    WHERE contains(props, '"k"') AND (contains(props, '7') OR contains(props, '42'))""")
def prefilter_props(spark, d):
    events = raw_prefilter(b.table(spark, d, "events"), "props", [['"k"', '"j"'], ["{"]], ["7", "42"])
    return events.select("event_id", json_path(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query("english_isbn", f"""WITH {b.CATALOG_SQL}
    SELECT isbn, regexp_replace(asin, '[^0-9]', '', 'g') AS digits, isbn LIKE '9780%' OR isbn LIKE '9781%' AS is_english,
           p_partkey % 4 IN (0, 1) AS short_is_english FROM catalog""")
def english(spark, d):
    """Long numbers, and short ones that begin with 0 to 3."""
    key = F.col("book_id").cast("bigint")
    return b.catalog(spark, d).select(
        "isbn",
        digits_only("asin").alias("digits"),
        is_english_isbn("isbn").alias("is_english"),
        is_english_isbn(F.concat((key % 4).cast("string"), F.lpad("book_id", 9, "0"))).alias("short_is_english"),
    )


@query("dedup_last_id", """
    WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS n FROM lineitem)
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey FROM ranked WHERE n = 1""")
def dedup_last(spark, d):
    rows = keep_last_by_id(
        b.table(spark, d, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"],
    )
    return rows.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey")


@query("catalog_build", CATALOG_ROW_SQL)
def catalog_build(spark, d):
    """Records to JSON Lines with an outdated and an id-less copy each, then the whole build."""
    # Written once: each of the copies would make all records anew.
    records = materialize(b.records(spark, d).drop("pos"), "records")
    path = scratch(spark, "raw-books")
    w.append_books_json(records.withColumn("title", F.lit("outdated")), f"{path}/a", "gzip")
    w.append_books_json(records, f"{path}/b", "gzip")
    w.append_books_json(records.withColumn("book_id", F.lit("")), f"{path}/c", "gzip")
    target = scratch(spark, "catalog")
    raw = r.read_books_jsonl(spark, f"{path}/*")
    w.write_catalog(build_catalog(raw), target)
    return _catalog_row(r.load_catalog(spark, target))


@query("ingest_counters", """
    SELECT 2 * count(*) AS read, count(*) + count(*) FILTER (p_partkey % 9 <> 0) AS indexed,
           count(*) FILTER (p_partkey % 9 = 0) AS skipped FROM part""")
def counters_of_ingest(spark, d):
    records = b.records(spark, d)
    gaps = records.withColumn("book_id", F.when(F.col("pos") % 9 != 0, F.col("book_id")))
    return ingest_counters(records.unionByName(gaps))


@query("normalize_union", f"""WITH {b.CATALOG_SQL}, {b.BOOKS_SQL}
    SELECT title, description, isbn, CAST(average_rating AS VARCHAR) AS average_rating,
           CAST(ratings_count AS VARCHAR) AS ratings_count, language_code,
           array_to_string(list_transform(shelves, lambda s, i: s || ':' || CAST(i AS VARCHAR)), ',') AS shelf_counts
    FROM catalog
    UNION ALL
    SELECT title, text, isbn, CAST(CAST(point AS DOUBLE) AS VARCHAR), CAST(n_chars AS VARCHAR), coalesce(language, ''),
           source || ':1' FROM books""")
def normalize_both(spark, d):
    """Both schemas in one normalised frame."""
    both = append_books(b.records(spark, d).drop("pos"), normalize_scraped(b.books(spark, d)))
    shelf_counts = F.transform("popular_shelves", lambda s: F.concat_ws(":", s["name"], s["count"]))
    return both.select(
        "title", "description", "isbn", "average_rating", "ratings_count", "language_code",
        F.array_join(shelf_counts, ",").alias("shelf_counts"),
    )


@query("surrogate_ids", f"""WITH {b.BOOKS_SQL}
    SELECT isbn AS "ISBN", CAST(CAST('0x' || substring(md5(title), 1, 15) AS BIGINT) AS VARCHAR) AS book_id FROM books""")
def surrogate_ids(spark, d):
    """Ids of records that come without one."""
    return b.books(spark, d).select("ISBN", surrogate_id("Title").alias("book_id"))


@query("epoch_dates", """
    SELECT event_id, CASE WHEN event_id = 0 THEN NULL
           ELSE strftime(make_timestamp(event_id * 86400000 * 1000), '%Y-%m-%d') END AS day FROM events""")
def epoch_dates(spark, d):
    return b.table(spark, d, "events").select(
        "event_id", epoch_ms_to_date(F.col("event_id") * 86_400_000).alias("day")
    )


# --- round trips through files -------------------------------------------------------


@query("books_json_roundtrip", CATALOG_ROW_SQL)
def books_json_roundtrip(spark, d):
    path = scratch(spark, "books-json")
    w.export_results_json(b.records(spark, d).drop("pos"), path)
    return _catalog_row(build_catalog(r.read_books(spark, path)))


@query("array_rows_roundtrip", CATALOG_ROW_SQL)
def array_rows_roundtrip(spark, d):
    """A JSON array with one record per line: brackets and commas around JSON Lines."""
    path = scratch(spark, "books-array")
    record = F.struct(*RECORD_FIELDS)
    b.records(spark, d).select(F.concat(F.lit("["), to_json_text(record), F.lit("]"))).write.text(path)
    return _catalog_row(build_catalog(r.read_books_json_array(spark, path, "rows")))


@query("books_csv_roundtrip", f"""WITH {b.BOOKS_SQL}
    SELECT isbn, title, text, source AS genres, CAST(has_review AS INTEGER)::BIGINT AS reviews, CAST(point AS DOUBLE) AS point,
           language, n_chars AS ratings FROM books""")
def books_csv_roundtrip(spark, d):
    path = scratch(spark, "books-csv")
    w.write_books_csv(b.books(spark, d), path)
    return r.read_scraped_csv(spark, path).select(
        F.col("ISBN").alias("isbn"),
        F.col("Title").alias("title"),
        F.col("Desc").alias("text"),
        F.array_join("Genre", ",").alias("genres"),
        F.size("Review").cast("bigint").alias("reviews"),
        F.col("Point").alias("point"),
        F.col("Language").alias("language"),
        F.col("RatingsCount").alias("ratings"),
    )


@query("clean_rewrite_roundtrip", f"""WITH {b.BOOKS_SQL}
    SELECT isbn, title, coalesce(language, 'English') AS language FROM flagged WHERE bucket = 'keep'""")
def clean_rewrite_roundtrip(spark, d):
    """The store is replaced by its clean records while it is being read."""
    path = scratch(spark, "store")
    w.append_books_json(b.books(spark, d).drop("pos"), path)
    stored = r.read_scraped_books(spark, path)
    w.rewrite_clean_books(clean_books(stored), removed_isbns(stored).count(), path)
    return r.read_scraped_books(spark, path).select(
        F.col("ISBN").alias("isbn"), F.col("Title").alias("title"), F.col("Language").alias("language")
    )


@query("isbn_list_roundtrip", f"WITH {b.EDITIONS_SQL} SELECT DISTINCT isbn FROM editions")
def isbn_list_roundtrip(spark, d):
    path = scratch(spark, "isbns")
    isbns = r.edition_json(b.edition_lines(spark, d)).select(
        F.from_json("json", "isbn_13 array<string>, isbn_10 array<string>").alias("e")
    )
    w.write_isbn_list(isbns.select(preferred_isbn("e.isbn_13", "e.isbn_10").alias("isbn")), path)
    return r.read_isbn_list(spark, path)


@query("dump_roundtrip", f"WITH {b.EDITIONS_SQL} SELECT DISTINCT isbn FROM novels")
def dump_roundtrip(spark, d):
    path = scratch(spark, "dump")
    b.edition_lines(spark, d).write.text(path)
    return novel_isbns(r.read_edition_dump(spark, path), **TERMS)


@query("crawl_log_read", f"""
    SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') || ' [ERROR] ' ||
           CASE event_type WHEN 'error' THEN 'Book ''403 Forbidden'' for ISBN ' || {b.isbn_sql('user_id')} || ' skipped'
                WHEN 'view' THEN '403 Forbidden at ISBN: ' || {b.isbn_sql('user_id')}
                ELSE 'saved ISBN ' || {b.isbn_sql('user_id')} END AS value FROM events""")
def crawl_log_read(spark, d):
    path = scratch(spark, "log")
    b.log_lines(spark, d).write.text(path)
    return r.read_crawl_log(spark, path)


@query("counts_over_appends", f"""
    SELECT 3 AS appends, sum(CASE WHEN p_partkey % 2 = 0 THEN 3 ELSE 2 END)::BIGINT AS rows, count(DISTINCT {b.isbn_sql('p_partkey')}) AS keys FROM part""")
def counts_over_appends(spark, d):
    """Rows and distinct ISBNs after three appends that overlap, from what each append left, counted exactly."""
    store, kept = scratch(spark, "counted-store"), scratch(spark, "counters")
    books = b.table(spark, d, "part").select("p_partkey", b.isbn_of("p_partkey").alias("isbn"), F.col("p_name").alias("title"))
    for part in (books, books.where("p_partkey % 2 = 0"), books):
        append_counted(part.drop("p_partkey"), store, kept, "isbn", exact=True)
    return kept_counts(spark, kept, exact=True).select(F.col("appends").cast("int").alias("appends"), "rows", "keys")

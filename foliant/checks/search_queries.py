"""Catalog search, scan, lookups, cards and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from foliant.checks import bindings as b
from foliant.checks.registry import query
from foliant.operators.cards import book_detail, result_cards
from foliant.operators.predicates import SearchSpec, apply_spec
from foliant.operators.ranking import deep_page, page, page_summary, positions, result_position, sort_keys, sort_results
from foliant.operators.summaries import catalog_status, match_count
from foliant.plans.search import fetch_full_records, lookup, scan_search, search, similar
from foliant.schemas import RECORD_FIELDS, RECORD_NESTED
from foliant.sources.writers import export_rows

WITH = f"WITH {b.CATALOG_SQL}"
HIT = [
    "position", "book_id", "title", "publisher", "average_rating", "ratings_count",
    "text_reviews_count", "publication_year", "language_code", "is_ebook",
]
SORT_SQL = {
    "popularity": "ratings_count", "rating": "average_rating", "reviews": "text_reviews_count",
    "year": "publication_year",
}


def hits_sql(where: str, sort_by: str = "popularity", limit: int = 10, offset: int = 0) -> str:
    order = f"{SORT_SQL[sort_by]} DESC NULLS LAST, book_id"
    columns = ", ".join(HIT[1:])
    return f"""{WITH}, hits AS (
      SELECT {columns} FROM catalog WHERE {where} ORDER BY {order} LIMIT {limit} OFFSET {offset})
    SELECT row_number() OVER (ORDER BY {order}) AS position, {columns} FROM hits"""


def register_search(name: str, spec: SearchSpec, where: str) -> None:
    sort_by = spec.sort_by or "popularity"

    @query(name, hits_sql(where, sort_by, spec.limit, spec.offset))
    def run(spark, d) -> DataFrame:
        return search(b.catalog(spark, d), spec).select(HIT)


register_search(
    "search_title",
    SearchSpec(title_query="RED w_dget"),
    "title ILIKE '%RED w_dget%' OR description ILIKE '%RED w_dget%'",
)
register_search("search_publisher", SearchSpec(publisher_query="brand#1%", limit=25), "publisher ILIKE '%brand#1%%'")
register_search(
    "search_identifier", SearchSpec(isbn_query="B000000042"), "'B000000042' IN (isbn, isbn13, asin)"
)
register_search(
    "search_rating_range", SearchSpec(rating_min=2.4, rating_max=2.6, sort_by="rating", limit=50),
    "average_rating BETWEEN 2.4 AND 2.6",
)
register_search("search_reviews_min", SearchSpec(reviews_min=12, sort_by="reviews", limit=40), "text_reviews_count >= 12")
register_search("search_year_eq", SearchSpec(publication_year=1996, limit=30), "publication_year = 1996")
register_search(
    "search_year_range",
    SearchSpec(publication_year_min=1996, publication_year_max=1998, sort_by="year", limit=30),
    "publication_year BETWEEN 1996 AND 1998",
)
register_search(
    "search_year_max_only", SearchSpec(publication_year_max=1995, sort_by="year", limit=100),
    "publication_year <= 1995",
)
register_search("search_language", SearchSpec(language_code="spa", limit=20), "language_code = 'spa'")
register_search("search_ebook", SearchSpec(is_ebook=False, sort_by="rating", limit=20), "NOT is_ebook")
register_search("search_author", SearchSpec(author_id=7, limit=50), "list_contains(author_ids, '7')")
register_search("search_shelf", SearchSpec(shelf="Promo", limit=50), "list_contains(shelves, 'promo')")
register_search(
    "search_combined_page2",
    SearchSpec(
        title_query="gear", rating_min=0, reviews_min=3, publication_year_min=1, is_ebook=True,
        shelf="gear", sort_by="rating", limit=10, offset=10,
    ),
    """(title ILIKE '%gear%' OR description ILIKE '%gear%') AND average_rating >= 0 AND text_reviews_count >= 3
       AND publication_year >= 1 AND is_ebook AND list_contains(shelves, 'gear')""",
)
register_search("search_match_all", SearchSpec(), "true")
for _sort in SORT_SQL:
    register_search(f"sort_{_sort}", SearchSpec(sort_by=_sort, limit=100, offset=5), "true")


@query("filter_all_matches", f"""{WITH} SELECT book_id, title FROM catalog
    WHERE average_rating >= 2.0 AND (title ILIKE '%ring%' OR description ILIKE '%ring%')""")
def filter_all_matches(spark, d):
    """The conjunction of predicates alone: every match, no page."""
    spec = SearchSpec(title_query="ring", rating_min=2.0)
    return apply_spec(b.catalog(spark, d), spec).select("book_id", "title")


@query("match_count", f"{WITH} SELECT count(*) AS matches FROM catalog WHERE language_code = 'eng' AND is_ebook")
def count_matches(spark, d):
    return match_count(apply_spec(b.catalog(spark, d), SearchSpec(language_code="eng", is_ebook=True)))


@query("search_description_docs", """
    WITH hits AS (SELECT CAST(doc_id AS VARCHAR) AS book_id, n_chars FROM documents
                  WHERE text ILIKE '%THE OF%' ORDER BY n_chars DESC, book_id LIMIT 50)
    SELECT row_number() OVER (ORDER BY n_chars DESC, book_id) AS position, book_id, n_chars FROM hits""")
def search_description_docs(spark, d):
    docs = b.table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("book_id"),
        F.lit("").alias("title"),
        F.col("text").alias("description"),
        F.col("n_chars").alias("ratings_count"),
    )
    hits = search(docs, SearchSpec(title_query="THE OF", limit=50))
    return hits.select("position", "book_id", F.col("ratings_count").alias("n_chars"))


@query("lookup_id", hits_sql("book_id = '17'", limit=1))
def lookup_id(spark, d):
    return lookup(b.catalog(spark, d), "17").select(HIT)


@query("page_three", hits_sql("is_ebook", limit=10, offset=20))
def page_three(spark, d):
    rows = sort_results(apply_spec(b.catalog(spark, d), SearchSpec(is_ebook=True)))
    return result_position(page(rows, 3), sort_keys("popularity")).select(HIT)


@query("deep_page", f"""{WITH}, ranked AS (
      SELECT {", ".join(HIT[1:])}, row_number() OVER (ORDER BY average_rating DESC NULLS LAST, book_id) AS position FROM catalog)
    SELECT {", ".join(HIT)} FROM ranked WHERE position > 700 AND position <= 1100""")
def deep_page_of_all(spark, d):
    """A page far behind the first rows, with places in the whole result."""
    return deep_page(b.catalog(spark, d), sort_keys("rating"), 400, 700).select(HIT)


@query("all_positions", f"""{WITH} SELECT book_id, row_number() OVER (ORDER BY publication_year DESC NULLS LAST, book_id) AS position FROM catalog""")
def all_positions(spark, d):
    return positions(b.catalog(spark, d).select("book_id", "publication_year"), sort_keys("year")).select("book_id", "position")


@query("page_summary", f"""{WITH}, hits AS (
      SELECT book_id FROM catalog WHERE language_code = 'fre' ORDER BY ratings_count DESC, book_id LIMIT 10 OFFSET 10)
    SELECT 'Page 2' AS label, count(*) AS rows,
           CASE WHEN count(*) = 0 THEN 'No matches found'
                ELSE 'Showing books 11-' || CAST(count(*) + 10 AS VARCHAR) END AS shown,
           true AS has_previous, count(*) = 10 AS has_next FROM hits""")
def summary_of_page(spark, d):
    spec = SearchSpec(language_code="fre", offset=10)
    return page_summary(search(b.catalog(spark, d), spec), 2)


@query("catalog_status", """
    SELECT true AS available, count(*) AS records,
           'Catalog exists. Total records: ' || format('{:,}', count(*)) AS message FROM part""")
def status(spark, d):
    return catalog_status(spark, f"{d}/part.parquet")


# Raw text search: '%' and '_' are literal, numbers are text.


@query("scan_search_literal", f"""{WITH}, found AS (
      SELECT book_id, title, average_rating FROM catalog
      WHERE (contains(lower(title), 'd wid') OR contains(lower(description), 'd wid'))
        AND average_rating >= 2.0 AND publication_year <= 1997 AND list_contains(shelves, 'widget')
      ORDER BY average_rating DESC, book_id LIMIT 20 OFFSET 5)
    SELECT row_number() OVER (ORDER BY average_rating DESC, book_id) AS position, book_id, title FROM found""")
def scan_search_literal(spark, d):
    spec = SearchSpec(
        title_query="D WID", rating_min=2.0, publication_year_max=1997, shelf="Widget",
        sort_by="rating", limit=20, offset=5,
    )
    return scan_search(b.records(spark, d), spec).select("position", "book_id", "title")


@query("scan_search_wildcard", f"""{WITH}, found AS (
      SELECT book_id, title, p_partkey FROM catalog WHERE p_partkey % 3 = 0 AND contains(lower(title), 'r'))
    SELECT row_number() OVER (ORDER BY p_partkey) AS position, book_id, replace(title, 'r', 'r_%') AS title
    FROM found ORDER BY p_partkey LIMIT 500""")
def scan_search_wildcard(spark, d):
    """A wildcard character is an ordinary one here: only titles that hold it match."""
    title = F.when(F.col("pos") % 3 == 0, F.replace("title", F.lit("r"), F.lit("r_%"))).otherwise(F.col("title"))
    rows = b.records(spark, d).withColumn("title", title).withColumn("description", F.lit(""))
    return scan_search(rows, SearchSpec(title_query="R_%", sort_by=None, limit=500)).select("position", "book_id", "title")


@query("scan_first_matches", f"""{WITH}, found AS (
      SELECT book_id, title, p_partkey FROM catalog WHERE is_ebook AND list_contains(author_ids, '3')
      ORDER BY p_partkey LIMIT 15 OFFSET 4)
    SELECT row_number() OVER (ORDER BY p_partkey) AS position, book_id, title FROM found""")
def scan_first_matches(spark, d):
    """No sort asked for: the first matches in source order."""
    spec = SearchSpec(is_ebook=True, author_id=3, sort_by=None, limit=15, offset=4)
    return scan_search(b.records(spark, d), spec).select("position", "book_id", "title")


@query("similar_one_hop", f"""{WITH}, edges AS (
      SELECT book_id, unnest(similar_books) AS similar_id, unnest(range(len(similar_books))) AS rank FROM catalog)
    SELECT e.book_id, e.rank, e.similar_id, c.title AS similar_title, c.average_rating AS similar_average_rating
    FROM edges e JOIN catalog c ON c.book_id = e.similar_id""")
def similar_one_hop(spark, d):
    catalog = b.catalog(spark, d)
    found = similar(catalog, catalog)
    return found.select(
        "book_id", F.col("rank").cast("bigint").alias("rank"), "similar_id", "similar_title",
        "similar_average_rating",
    )


@query("fetch_full_records", f"""{WITH}, hits AS (
      SELECT book_id, ratings_count FROM catalog WHERE is_ebook ORDER BY ratings_count DESC, book_id LIMIT 30)
    SELECT row_number() OVER (ORDER BY h.ratings_count DESC, h.book_id) AS position, c.book_id, c.description,
           array_to_string(c.author_ids, ',') AS authors
    FROM hits h JOIN catalog c ON c.book_id = h.book_id""")
def full_records(spark, d):
    catalog = b.catalog(spark, d)
    spec = SearchSpec(is_ebook=True, limit=30)
    found = fetch_full_records(search(catalog, spec), catalog)
    return found.select("position", "book_id", "description", F.array_join("author_ids", ",").alias("authors"))


def _authors_sql(prefix: str) -> str:
    return (
        f"array_to_string(list_transform(author_ids, lambda a: '{prefix}' || a || "
        "CASE WHEN CAST(a AS BIGINT) % 2 = 0 THEN ' (Editor)' ELSE '' END), ', ')"
    )


CARD_SQL = """
    book_id, title, isbn AS identifier, {authors} AS authors, CAST(average_rating AS VARCHAR) AS rating,
    format('{{:,}}', ratings_count) AS ratings, format('{{:,}}', text_reviews_count) AS reviews,
    CASE WHEN language_code = '' THEN 'N/A' ELSE language_code END AS language,
    CASE WHEN length(title) % 3 = 0 THEN 'Hardcover' WHEN is_ebook THEN 'Ebook' ELSE '{no_format}' END AS format,
    publisher, CAST(publication_year AS VARCHAR) AS year, {shelves} AS shelves,
    '/book/show/' || book_id AS link, description"""


@query("result_cards", f"""{WITH}
    SELECT 'list' AS style, {CARD_SQL.format(
        authors=_authors_sql('ID:'), no_format='N/A',
        shelves="array_to_string(list_transform(shelves, lambda s, i: s || ' (' || CAST(i AS VARCHAR) || ')'), ', ')")}
    FROM catalog
    UNION ALL
    SELECT 'card' AS style, {CARD_SQL.format(
        authors=_authors_sql('Author '), no_format='Paperback/N/A', shelves="array_to_string(shelves, ', ')")}
    FROM catalog""")
def cards(spark, d):
    """Both display styles of every record."""
    records = b.records(spark, d)
    styles = [
        result_cards(records, style).select(F.lit(style).alias("style"), "*") for style in ("list", "card")
    ]
    return styles[0].unionByName(styles[1])


@query("cards_cut_and_grouped", f"""{WITH}
    SELECT book_id, format('{{:,}}', ratings_count * 1003) AS ratings,
           array_to_string(list_slice(list_concat(shelves, ['a', 'b', 'c', 'd', 'e']), 1, 5), ', ') AS shelves FROM catalog""")
def cards_cut(spark, d):
    """More than five shelves, and counts beyond a thousand."""
    more = F.array(*[F.struct(F.lit("1").alias("count"), F.lit(x).alias("name")) for x in "abcde"])
    records = b.records(spark, d).withColumns({
        "popular_shelves": F.concat("popular_shelves", more),
        "ratings_count": (F.col("ratings_count").cast("bigint") * 1003).cast("string"),
    })
    return result_cards(records, "card").select("book_id", "ratings", "shelves")


@query("excerpt_documents", f"""
    WITH t AS (SELECT doc_id, {b.strip_sql("replace(text, chr(10), ' ')")} AS flat FROM documents)
    SELECT CAST(doc_id AS VARCHAR) AS book_id,
           nullif(CASE WHEN length(flat) > 200 THEN substring(flat, 1, 200) || '...' ELSE flat END, '') AS description
    FROM t""")
def excerpts(spark, d):
    """The excerpt rule on long texts."""
    docs = b.table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("book_id"), F.col("text").alias("description")
    )
    kinds = {name: RECORD_NESTED.get(name, "string") for name in RECORD_FIELDS}
    rows = docs.select(*[F.col(n) if n in docs.columns else F.lit(None).cast(t).alias(n) for n, t in kinds.items()])
    return result_cards(rows).select("book_id", "description")


@query("book_detail", f"""{WITH}
    SELECT book_id, title, CAST(average_rating AS VARCHAR) AS rating, format('{{:,}}', ratings_count) AS ratings,
           format('{{:,}}', text_reviews_count) AS reviews, isbn, isbn13, asin,
           CASE WHEN language_code = '' THEN 'N/A' ELSE language_code END AS language, publisher,
           CAST(publication_year AS VARCHAR) ||
             CASE WHEN ratings_count % 4 = 0 THEN '-5-9' WHEN ratings_count % 2 = 0 THEN '-5' ELSE '' END AS published,
           CAST(ratings_count AS VARCHAR) AS pages,
           CASE WHEN length(title) % 3 = 0 THEN 'Hardcover' ELSE 'N/A' END AS format,
           CAST(is_ebook AS VARCHAR) AS is_ebook, 'N/A' AS country, 'Standard' AS edition, description,
           array_to_string(list_transform(shelves, lambda s, i: chr(8226) || ' ' || s || ' (' || CAST(i AS VARCHAR) || ')'), chr(10))
             AS shelves,
           array_to_string(similar_books, ',') AS similar_books
    FROM catalog""")
def detail(spark, d):
    rows = book_detail(b.records(spark, d))
    return rows.withColumn("similar_books", F.array_join("similar_books", ","))


@query("export_csv_rows", f"""{WITH}
    SELECT book_id, title, array_to_string(author_ids, ',') AS authors, CAST(average_rating AS VARCHAR) AS average_rating,
           CAST(ratings_count AS VARCHAR) AS ratings_count, isbn, isbn13, asin, language_code,
           CAST(publication_year AS VARCHAR) AS publication_year, publisher,
           CASE WHEN length(title) % 3 = 0 THEN 'Hardcover' ELSE '' END AS format,
           CAST(is_ebook AS VARCHAR) AS is_ebook, '/book/show/' || book_id AS link
    FROM catalog""")
def export(spark, d):
    return export_rows(b.records(spark, d))

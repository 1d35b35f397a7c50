"""Unusual inputs and the stored catalog: layouts, malformed texts, attributes, whole jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from foliant.checks import bindings as b
from foliant.checks.ingest_queries import CATALOG_ROW_SQL, _catalog_row
from foliant.checks.registry import query
from foliant.checks.search_queries import HIT, hits_sql
from foliant.functions.jsons import to_json_text
from foliant.operators import pages as p
from foliant.operators.normalize import normalize_books
from foliant.operators.predicates import SearchSpec
from foliant.operators.sets import blocked_isbns
from foliant.operators.subjects import subjects_lower
from foliant.operators.summaries import parse_summary
from foliant.plans.catalog import build_catalog, build_catalog_files, catalog_of
from foliant.plans.crawl import reload_store, triage_pages
from foliant.plans.search import scan_first, scan_search, search, search_page, search_records, similar
from foliant.schemas import RECORD_FIELDS
from foliant.session import materialize, scratch
from foliant.sources import readers as r, writers as w
from foliant.sources.blocks import search_blocks, write_block_index
from foliant.sources.layout import cluster_catalog


# Records of an array: what one task sorts and writes does not grow with their number.
FILE_RECORDS = 50_000


def _texts(spark, d) -> DataFrame:
    """Every record as one JSON text, with its number; written once, for each use would make all records anew."""
    texts = b.records(spark, d).select(to_json_text(F.struct(*RECORD_FIELDS)).alias("json"), F.col("pos").alias("n"))
    return materialize(texts, "texts")


def _array_files(rows: DataFrame, path: str, gap: str) -> None:
    """Arrays of the records in order, three at least, ``gap`` between two; written row by row."""
    files = max(3, -(-rows.count() // FILE_RECORDS))

    def framed(frames):
        import pandas as pd

        last = None
        for frame in frames:
            records = frame["json"].tolist()
            if not records:
                continue
            yield pd.DataFrame({"json": ["["] if last is None else [last + ","]})
            yield pd.DataFrame({"json": [x + "," for x in records[:-1]]})
            last = records[-1]
        if last is not None:
            yield pd.DataFrame({"json": [last, "]"]})

    ordered = rows.repartitionByRange(files, "n").sortWithinPartitions("n").select("json")
    ordered.mapInPandas(framed, "json string").write.option("lineSep", gap).text(path)


# --- record files ---------------------------------------------------------------------


@query("mixed_folder", CATALOG_ROW_SQL)
def mixed_folder(spark, d):
    """JSON Lines and three layouts of arrays in one folder; each file is read by its own kind."""
    path, rows = scratch(spark, "mixed"), _texts(spark, d)
    rows.where("n % 4 = 0").select("json").write.text(f"{path}/lines")
    _array_files(rows.where("n % 4 = 1"), f"{path}/rows", "\n")
    _array_files(rows.where("n % 4 = 2"), f"{path}/single", " ")
    pretty = rows.where("n % 4 = 3").select(F.replace("json", F.lit(',"'), F.lit(',\n    "')).alias("json"), "n")
    _array_files(pretty, f"{path}/pretty", "\n  ")
    return _catalog_row(build_catalog(r.read_books(spark, f"{path}/*")))


@query("array_line_feeds", CATALOG_ROW_SQL)
def array_line_feeds(spark, d):
    """Raw line feeds within texts, which readers of arrays accept."""
    path = scratch(spark, "feeds")
    rows = _texts(spark, d).select(F.replace("json", F.lit('"title_without_series":"'), F.lit('"title_without_series":"a\nb ')).alias("json"), "n")
    _array_files(rows, path, "\n  ")
    return _catalog_row(build_catalog(r.read_books(spark, path)))


@query("array_any_layout", CATALOG_ROW_SQL)
def array_any_layout(spark, d):
    """Pretty-printed records with brackets, quotes and backslashes in their texts, read by splits."""
    path = scratch(spark, "any-layout")
    odd = F.concat(F.lit('}, {"x": [\\" ] \\'), F.col("title_without_series"))
    records = b.records(spark, d).withColumn("title_without_series", odd)
    pretty = F.to_json(F.struct(*RECORD_FIELDS), {"pretty": "true", "ignoreNullFields": "false"})
    _array_files(materialize(records.select(pretty.alias("json"), F.col("pos").alias("n")), "texts"), path, "\n")
    return _catalog_row(build_catalog(r.read_books_json_array(spark, path, "split")))


BROKEN_SQL = "(p_partkey % 5 IN (1, 2, 3, 4))"


@query("parse_errors", f"""
    SELECT count(*) FILTER (NOT {BROKEN_SQL}) AS records, count(*) FILTER ({BROKEN_SQL}) AS parse_errors FROM part""")
def parse_errors(spark, d):
    """Texts cut off, followed by more, quoted with apostrophes, and no object at all."""
    path, kind = scratch(spark, "broken"), F.col("n") % 5
    text = (
        F.when(kind == 1, F.expr("left(json, length(json) - 1)"))
        .when(kind == 2, F.concat("json", F.lit(" "), "json"))
        .when(kind == 3, F.concat(F.lit("{'a': 1, "), F.expr("substring(json, 2)")))
        .when(kind == 4, F.concat(F.lit("["), "json", F.lit("]")))
        .otherwise(F.col("json"))
    )
    _texts(spark, d).select(text).write.text(path)
    return parse_summary(r.read_books_jsonl(spark, path, keep_malformed=True))


@query("build_catalog_counters", """
    SELECT CAST(count(*) AS BIGINT) AS read, count(*) FILTER (p_partkey % 9 <> 0) AS indexed, count(*) FILTER (p_partkey % 9 = 0) AS skipped,
           count(*) FILTER (p_partkey % 7 = 0) AS parse_errors, count(*) FILTER (p_partkey % 9 <> 0) AS stored FROM part""")
def build_catalog_counters(spark, d):
    """The whole build from files: counters, and what is stored."""
    path, target = scratch(spark, "counted"), scratch(spark, "counted-catalog")
    records = b.records(spark, d)
    named = records.withColumn("book_id", F.when(F.col("pos") % 9 != 0, F.col("book_id")).otherwise(""))
    w.append_books_json(named.drop("pos"), path)
    records.where("pos % 7 = 0").select(F.lit("{oops")).write.mode("append").text(path)
    counters = build_catalog_files(spark, path, target)
    values = [F.lit(counters[k]).cast("bigint").alias(k) for k in ("read", "indexed", "skipped", "parse_errors")]
    return r.load_catalog(spark, target).agg(F.count(F.lit(1)).alias("stored")).select(*values, "stored")


# --- the stored catalog ---------------------------------------------------------------


def _stored(spark, d) -> DataFrame:
    target = scratch(spark, "stored-catalog")
    records = b.records(spark, d).withColumn("pos", F.struct(F.lit("f").alias("file"), F.lit(0).alias("block"), F.col("pos").alias("row")))
    w.write_catalog(catalog_of(records), target)
    return r.load_catalog(spark, target)


@query("similar_stored", f"""WITH {b.CATALOG_SQL}, edges AS (
      SELECT book_id, unnest(similar_books) AS similar_id, unnest(range(len(similar_books))) AS rank FROM catalog)
    SELECT e.book_id, e.rank, e.similar_id, c.title AS similar_title FROM edges e JOIN catalog c ON c.book_id = e.similar_id""")
def similar_stored(spark, d):
    catalog = _stored(spark, d)
    return similar(catalog, catalog).select("book_id", F.col("rank").cast("bigint").alias("rank"), "similar_id", "similar_title")


PAGE_SPEC = SearchSpec(is_ebook=True, rating_min=2.0, sort_by="rating", limit=40, offset=10)
PAGE_SQL = f"""WITH {b.CATALOG_SQL}, hits AS (
      SELECT * FROM catalog WHERE is_ebook AND average_rating >= 2.0 ORDER BY average_rating DESC, book_id LIMIT 40 OFFSET 10)
    SELECT row_number() OVER (ORDER BY average_rating DESC, book_id) AS position, book_id, title, asin,
           array_to_string(similar_books, ',') AS similar_books FROM hits"""


def _page(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("position").cast("bigint").alias("position"), "book_id", "title", "asin", F.array_join("similar_books", ",").alias("similar_books"))


@query("search_page_records", PAGE_SQL)
def search_page_records(spark, d):
    return _page(search_page(_stored(spark, d), PAGE_SPEC))


@query("search_lazy_records", PAGE_SQL)
def search_lazy_records(spark, d):
    return _page(search_records(_stored(spark, d), PAGE_SPEC))


@query("scan_search_raw", f"""WITH {b.CATALOG_SQL}, found AS (
      SELECT book_id, title, average_rating FROM catalog WHERE is_ebook AND average_rating >= 2.0
      ORDER BY average_rating DESC, book_id LIMIT 40 OFFSET 10)
    SELECT row_number() OVER (ORDER BY average_rating DESC, book_id) AS position, book_id, title FROM found""")
def scan_search_raw(spark, d):
    """The same search over a file of raw records."""
    path = scratch(spark, "raw-scan")
    w.append_books_json(b.records(spark, d).drop("pos"), path)
    return scan_search(r.read_books_jsonl(spark, path), PAGE_SPEC).select("position", "book_id", "title")


@query("scan_first_files", f"""WITH {b.CATALOG_SQL}, found AS (
      SELECT book_id, title, p_partkey FROM catalog WHERE is_ebook AND list_contains(author_ids, '3') ORDER BY p_partkey LIMIT 15 OFFSET 4)
    SELECT row_number() OVER (ORDER BY p_partkey) AS position, book_id, title FROM found""")
def scan_first_files(spark, d):
    """The first matches of many record files; reading stops with the page."""
    path = scratch(spark, "many-files")
    b.records(spark, d).repartitionByRange(12, "pos").sortWithinPartitions("pos").drop("pos").write.option("ignoreNullFields", "false").json(path)
    return scan_first(spark, path, SearchSpec(is_ebook=True, author_id=3, sort_by=None, limit=15, offset=4)).select("position", "book_id", "title")


@query("log_undecodable_bytes", f"""
    SELECT DISTINCT {b.isbn_sql('p_partkey')} AS isbn FROM part""")
def log_undecodable(spark, d):
    """ISBNs named as blocked, with bytes in them that are not UTF-8, in several places and kinds."""
    path, n = scratch(spark, "odd-log"), F.col("p_partkey")
    odd = F.get(F.array(*[F.unhex(F.lit(x)) for x in ("FF", "C0AF", "EDA080", "E282", "F5808080", "80")]), (n % 6).cast("int"))
    isbn = b.isbn_of("p_partkey")
    raw = F.concat(F.lit("é Book '403 Forbidden' for ISBN ").cast("binary"), F.substring(isbn, 1, 4).cast("binary"), odd, F.substring(isbn, 5, 99).cast("binary"), odd, F.lit("\ufffd ok").cast("binary"))
    b.table(spark, d, "part").select(raw.cast("string").alias("value")).write.text(path)
    return blocked_isbns(r.read_crawl_log(spark, path))


def _indexed(name: str, spec: SearchSpec, where: str) -> None:
    @query(name, hits_sql(where, spec.sort_by, spec.limit, spec.offset))
    def run(spark, d) -> DataFrame:
        """The stored catalog through its block index."""
        catalog, index = scratch(spark, "indexed-catalog"), scratch(spark, "block-index")
        records = b.records(spark, d).withColumn("pos", F.struct(F.lit("f").alias("file"), F.lit(0).alias("block"), F.col("pos").alias("row")))
        w.write_catalog(catalog_of(records), catalog)
        write_block_index(spark, catalog, index)
        return search_blocks(spark, catalog, index, spec).select(HIT)


_indexed(
    "search_text_indexed", SearchSpec(title_query="RED w_dget", limit=50),
    "title ILIKE '%RED w_dget%' OR description ILIKE '%RED w_dget%'",
)
_indexed(
    "search_conjunction_indexed",
    SearchSpec(title_query="gear", publisher_query="brand#1", language_code="eng", is_ebook=True, author_id=7, shelf="Gear", sort_by="rating", limit=100),
    """(title ILIKE '%gear%' OR description ILIKE '%gear%') AND publisher ILIKE '%brand#1%' AND language_code = 'eng' AND is_ebook
       AND list_contains(author_ids, '7') AND list_contains(shelves, 'gear')""",
)


@query("search_clustered", hits_sql(
    "average_rating >= 2.5 AND publication_year BETWEEN 1993 AND 1996 AND ratings_count >= 0", "rating", 100))
def search_clustered(spark, d):
    """Ranges of several columns over the catalog along the curve."""
    source, target = scratch(spark, "plain-catalog"), scratch(spark, "clustered-catalog")
    records = b.records(spark, d).withColumn("pos", F.struct(F.lit("f").alias("file"), F.lit(0).alias("block"), F.col("pos").alias("row")))
    w.write_catalog(catalog_of(records), source, sort_by=None)
    cluster_catalog(spark, source, target, files=16)
    spec = SearchSpec(rating_min=2.5, publication_year_min=1993, publication_year_max=1996, sort_by="rating", limit=100)
    return search(r.load_catalog(spark, target), spec).select(HIT)


@query("export_results_csv", f"""WITH {b.CATALOG_SQL}
    SELECT book_id, title, array_to_string(author_ids, ',') AS authors, CAST(average_rating AS VARCHAR) AS average_rating,
           isbn, asin, publisher, '/book/show/' || book_id AS link FROM catalog""")
def export_csv(spark, d):
    path = scratch(spark, "export-csv")
    w.export_results_csv(b.records(spark, d), path)
    rows = spark.read.options(header=True, quote='"', escape='"').csv(path)
    return rows.select("book_id", "title", F.coalesce("authors", F.lit("")).alias("authors"), "average_rating", "isbn", "asin", "publisher", "link")


@query("normalize_scraped_file", f"""WITH {b.BOOKS_SQL}
    SELECT CAST(CAST('0x' || substring(md5(title), 1, 15) AS BIGINT) AS VARCHAR) AS book_id, title, isbn, CAST(n_chars AS VARCHAR) AS ratings_count,
           source || ':1' AS shelf_counts FROM books""")
def scraped_file(spark, d):
    """Scraped records in a raw file; some name a key twice, and the last one counts."""
    path = scratch(spark, "scraped")
    text = to_json_text(F.struct(*[c for c in b.books(spark, d).columns if c != "pos"]))
    twice = F.when(F.col("pos") % 3 == 0, F.concat(F.lit('{"ISBN":"0",'), F.expr("substring(text, 2)"))).otherwise(F.col("text"))
    b.books(spark, d).select(text.alias("text"), "pos").select(twice).write.text(path)
    rows = normalize_books(r.read_books_jsonl(spark, path))
    shelf_counts = F.transform("popular_shelves", lambda s: F.concat_ws(":", s["name"], s["count"]))
    return rows.select("book_id", "title", "isbn", "ratings_count", F.array_join(shelf_counts, ",").alias("shelf_counts"))


@query("subjects_lower", "SELECT p_partkey, lower(p_name) || '|' || lower(p_type) AS subjects FROM part")
def lower_subjects(spark, d):
    part = b.table(spark, d, "part")
    return part.select("p_partkey", F.array_join(subjects_lower(F.array("p_name", "p_type")), "|").alias("subjects"))


# --- markup with unusual attributes -----------------------------------------------------


@query("title_fallbacks", f"""
    SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'Tagged > ' || page_id WHEN 1 THEN 'Social > ' || page_id WHEN 2 THEN 'Plain ' || page_id
           ELSE {b.strip_sql(b.unescape_sql("regexp_extract(html, '<title>(.*?)</title>', 1, 's')"))} END AS title FROM pages""")
def title_fallbacks(spark, d):
    """Tagged heading, social title, any heading, page title; closing brackets in attributes, bare attributes."""
    n, html = F.col("page_id"), F.regexp_replace("html", r"(?s)<h1>.*?</h1>", "")
    number = n.cast("string")
    tagged = F.concat(F.lit("<article><h1 data-name='data-testid=bookTitle' title='x > y'>Wrong</h1><h1 title=\"a > b\" data-testid=bookTitle>Tagged &gt; "), number, F.lit("</h1>"))
    social = F.concat(F.lit('<article><meta data-content="no" property="og:title" content="Social > '), number, F.lit('"><h1>Wrong</h1>'))
    plain = F.concat(F.lit("<article><h1 title='a > b'>Plain <b title=\">\">"), number, F.lit("</b></h1>"))
    body = F.when(n % 4 == 0, tagged).when(n % 4 == 1, social).when(n % 4 == 2, plain).otherwise(F.lit("<article>"))
    pages = b.table(spark, d, "pages").select("page_id", F.replace(html, F.lit("<article>"), body).alias("html"))
    return p.extract_books(pages).select("page_id", F.col("Title").alias("title"))


@query("description_attributes", """
    SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'Social -> ' || url WHEN 1 THEN 'Named -> ' || url ELSE 'Block ' || url END AS description FROM pages""")
def description_attributes(spark, d):
    """og:description, description, and a block, all behind closing brackets in attributes."""
    n = F.col("page_id")
    social = F.concat(F.lit("<article><meta content='Social -> "), F.col("url"), F.lit("' property=og:description>"))
    named = F.concat(F.lit('<article><meta data-x="a > b" name=\'description\' content="Named -> '), F.col("url"), F.lit('">'))
    block = F.concat(F.lit("<article><div title='>' data-testid=description><span class=Formatted title='x > y'>Block "), F.col("url"), F.lit("</span></div>"))
    body = F.when(n % 3 == 0, social).when(n % 3 == 1, named).otherwise(block)
    pages = b.table(spark, d, "pages").select("page_id", F.replace("html", F.lit("<article>"), body).alias("html"))
    return p.extract_books(pages).select("page_id", F.col("Desc").alias("description"))


@query("genre_links", "SELECT page_id, 'Fiction ' || page_id || '|Poems|Travel' AS genres FROM pages")
def genre_links(spark, d):
    links = F.concat(
        F.lit("<article><a title=\"a > b\" href=\"/genres/f\">Fiction "), F.col("page_id").cast("string"),
        F.lit("</a><a href='/genres/p'>Poems</a><a data-href=\"/genres/no\">No</a><a class=x href=/genres/t>Travel</a><a href='/genres/p'> Poems </a><a href='/genres/'>...more</a>"),
    )
    pages = b.table(spark, d, "pages").select("page_id", F.replace("html", F.lit("<article>"), links).alias("html"))
    return p.extract_books(pages).select("page_id", F.array_join("Genre", "|").alias("genres"))


@query("stray_quotes", """
    SELECT page_id, 'It''s ' || page_id AS title, 'Don''t' AS description, 'Poems ' || page_id || '|Travel' AS genres, page_id % 5 + 0.5::DOUBLE AS point FROM pages""")
def stray_quotes(spark, d):
    """Quotes that open no value in start tags and texts, tags that never end, an unended script."""
    n = F.col("page_id").cast("string")
    body = F.concat(
        F.lit("<article><h1 data-testid=bookTitle data-x=it's>It's "), n, F.lit("</h1><h1 title=\"5\" tall\">no</h1><div tall\" data-testid=description>Don't</div>"),
        F.lit("<a it's href='/genres/p'>Poems "), n, F.lit("</a><a \" href=/genres/t>Travel</a><div ' class=RatingStatistics__rating>"), (F.col("page_id") % 5 + F.lit(0.5)).cast("string"),
        F.lit("</div>"), F.repeat(F.lit("<a x=\"/genres/ "), F.lit(201)),
    )
    pages = b.table(spark, d, "pages").select("page_id", F.concat(F.lit("<html>"), body, F.lit("<script>")).alias("html"))
    found = p.extract_books(pages)
    return found.select("page_id", F.col("Title").alias("title"), F.col("Desc").alias("description"), F.array_join("Genre", "|").alias("genres"), F.col("Point").alias("point"))


# --- whole crawl jobs -------------------------------------------------------------------


@query("triage_blank_titles", """
    WITH t AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'same' ELSE 'own ' || page_id END AS k FROM pages)
    SELECT page_id, CASE WHEN row_number() OVER (PARTITION BY k ORDER BY page_id) = 1 THEN 'saved' ELSE 'duplicate' END AS disposition FROM t""")
def triage_blank(spark, d):
    """Blank titles in the state: the first such page is saved, as for any title."""
    n = F.col("page_id")
    title = F.when(n % 3 == 0, F.lit("  ")).when(n % 3 == 1, F.when(n % 2 == 0, "Same").otherwise("same ")).otherwise(F.concat(F.lit("own "), n.cast("string")))
    script = F.concat(
        F.lit("<html><script type='application/json' id=__NEXT_DATA__>"),
        F.lit('{"props":{"pageProps":{"apolloState":{"Book:1":{"title":"'), title,
        F.lit('"},"Work:1":{"stats":{"averageRating":4.5,"ratingsCount":3,"textReviewsCount":2}}}}}}</script></html>'),
    )
    pages = b.table(spark, d, "pages").select(
        b.isbn_of("page_id").alias("isbn"), F.concat(F.lit("/book/show/"), n.cast("string")).alias("url"), F.lit("Page").alias("page_title"), script.alias("html"), "page_id",
    )
    return triage_pages(pages, order="page_id").select("page_id", "disposition")


@query("landed_pages", "SELECT page_id, length(html) AS chars FROM pages")
def landed_pages(spark, d):
    return r.read_pages(spark, f"{d}/pages.parquet").select("page_id", F.length("html").cast("bigint").alias("chars"))


@query("reload_store", f"""WITH {b.BOOKS_SQL}, kept AS (SELECT isbn, title FROM flagged WHERE bucket = 'keep')
    SELECT 'json' AS part, isbn, title AS value FROM kept UNION ALL SELECT 'csv', isbn, title FROM kept
    UNION ALL SELECT DISTINCT 'checkpoint', isbn, bucket FROM flagged WHERE bucket <> 'keep'""")
def reload(spark, d):
    """Clean the store, rewrite both of its forms and note what went."""
    store = scratch(spark, "reload")
    w.append_books_json(b.books(spark, d).drop("pos"), f"{store}/books")
    reload_store(spark, f"{store}/books", f"{store}/csv", f"{store}/checkpoint", chunks=4)
    books = r.read_scraped_books(spark, f"{store}/books").select(F.lit("json").alias("part"), F.col("ISBN").alias("isbn"), F.col("Title").alias("value"))
    rows = r.read_scraped_csv(spark, f"{store}/csv").select(F.lit("csv").alias("part"), F.col("ISBN").alias("isbn"), F.col("Title").alias("value"))
    noted = r.read_checkpoint(spark, f"{store}/checkpoint").select(F.lit("checkpoint").alias("part"), "isbn", F.col("disposition").alias("value"))
    return books.unionByName(rows).unionByName(noted)

"""The given tables seen as catalog, editions, stored books, pages, lists and logs.

Each binding has its SQL twin in ``*_SQL``, a list of CTEs to put behind ``WITH``.
All arithmetic is on whole numbers so that both engines agree exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foliant.functions.text import WHITESPACE
from foliant.operators.pages import flat_element, markup_text
from foliant.schemas import RECORD_FIELDS, RECORD_NESTED, REVIEW

# The strip of both engines, as a DuckDB expression.
BLANKS_SQL = "(" + " || ".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"


def strip_sql(expr: str) -> str:
    return f"trim({expr}, {BLANKS_SQL})"


def title_key_sql(expr: str) -> str:
    return f"nullif(lower({strip_sql(expr)}), '')"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def isbn_of(number: Column | str) -> Column:
    """A made-up ISBN-13, two thirds of them English."""
    n = F.col(number) if isinstance(number, str) else number
    prefix = F.get(F.array(F.lit("9780"), F.lit("9781"), F.lit("9791")), (n % 3).cast("int"))
    return F.concat(prefix, F.lpad(n.cast("string"), 9, "0"))


def isbn_sql(n: str) -> str:
    return f"(CASE {n} % 3 WHEN 0 THEN '9780' WHEN 1 THEN '9781' ELSE '9791' END || lpad(CAST({n} AS VARCHAR), 9, '0'))"


# --- catalog: part and lineitem ---------------------------------------------------

LANGUAGES = ["eng", "en-US", "spa", "fre", ""]


def catalog(spark: SparkSession, d: str) -> DataFrame:
    """Typed catalog rows. Aggregates a query does not use are pruned by Catalyst."""
    items = (
        table(spark, d, "lineitem")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("l_returnflag") == "R").alias("returned"),
            F.min(F.year("l_shipdate")).cast("bigint").alias("first_year"),
            F.collect_set("l_suppkey").alias("suppliers"),
        )
    )
    key = F.col("p_partkey")
    zero = F.lit(0).cast("bigint")
    rows = table(spark, d, "part").join(items, "p_partkey", "left")
    return rows.select(
        key.cast("string").alias("book_id"),
        F.col("p_name").alias("title"),
        F.concat_ws(" ", "p_brand", "p_type", "p_name").alias("description"),
        isbn_of(key).alias("isbn"),
        F.lit("").alias("isbn13"),
        F.concat(F.lit("B"), F.lpad(key.cast("string"), 9, "0")).alias("asin"),
        F.coalesce(F.expr("(quantity * 10) div n") / F.lit(100.0), F.lit(0.0)).alias("average_rating"),
        F.coalesce("n", zero).alias("ratings_count"),
        F.coalesce("returned", zero).alias("text_reviews_count"),
        F.when(key % 11 == 0, zero).otherwise(F.coalesce("first_year", zero)).alias("publication_year"),
        F.col("p_brand").alias("publisher"),
        F.get(F.array(*[F.lit(x) for x in LANGUAGES]), (key % 5).cast("int")).alias("language_code"),
        (F.col("p_size") % 2 == 0).alias("is_ebook"),
        F.coalesce(F.array_sort(F.col("suppliers").cast("array<string>")), F.array().cast("array<string>")).alias("author_ids"),
        F.concat(F.array(F.lower("p_type")), F.split("p_name", " ")).alias("shelves"),
        F.array((key + 1).cast("string"), (key + 7).cast("string")).alias("similar_books"),
    )


CATALOG_SQL = f"""
items AS (
  SELECT l_partkey, sum(CAST(l_quantity AS BIGINT)) AS quantity, count(*) AS n,
         count(*) FILTER (l_returnflag = 'R') AS returned, min(year(l_shipdate)) AS first_year,
         list_sort(list_distinct(list(CAST(l_suppkey AS VARCHAR)))) AS suppliers
  FROM lineitem GROUP BY l_partkey),
catalog AS (
  SELECT CAST(p_partkey AS VARCHAR) AS book_id, p_name AS title,
         p_brand || ' ' || p_type || ' ' || p_name AS description,
         {isbn_sql('p_partkey')} AS isbn, '' AS isbn13,
         'B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS asin,
         coalesce(CAST((quantity * 10) // n AS BIGINT) / 100.0::DOUBLE, 0.0::DOUBLE) AS average_rating,
         coalesce(n, 0) AS ratings_count, coalesce(returned, 0) AS text_reviews_count,
         CASE WHEN p_partkey % 11 = 0 THEN 0 ELSE coalesce(first_year, 0) END AS publication_year,
         p_brand AS publisher,
         CASE p_partkey % 5 WHEN 0 THEN 'eng' WHEN 1 THEN 'en-US' WHEN 2 THEN 'spa' WHEN 3 THEN 'fre' ELSE '' END
           AS language_code,
         p_size % 2 = 0 AS is_ebook, coalesce(suppliers, []) AS author_ids,
         list_concat([lower(p_type)], string_split(p_name, ' ')) AS shelves,
         [CAST(p_partkey + 1 AS VARCHAR), CAST(p_partkey + 7 AS VARCHAR)] AS similar_books,
         p_partkey
  FROM part LEFT JOIN items ON l_partkey = p_partkey)"""


def records(spark: SparkSession, d: str) -> DataFrame:
    """The catalog as normalised records: all scalars text, ``pos`` the part number."""
    rows = catalog(spark, d)
    blank = F.lit("")
    values = {
        "title_without_series": F.col("title"),
        "is_ebook": F.col("is_ebook").cast("string"),
        "authors": F.transform(
            "author_ids",
            lambda a: F.struct(
                a.alias("author_id"),
                F.when(a.try_cast("bigint") % 2 == 0, F.lit("Editor"))
                .otherwise(blank).alias("role"),
            ),
        ),
        "popular_shelves": F.transform(
            "shelves", lambda s, i: F.struct((i + 1).cast("string").alias("count"), s.alias("name"))
        ),
        "similar_books": F.col("similar_books"),
        "series": F.array().cast("array<string>"),
        "link": F.concat(F.lit("/book/show/"), "book_id"),
        "format": F.when(F.length("title") % 3 == 0, F.lit("Hardcover")).otherwise(blank),
        "publication_month": F.when(F.col("ratings_count") % 2 == 0, F.lit("5")).otherwise(blank),
        "publication_day": F.when(F.col("ratings_count") % 4 == 0, F.lit("9")).otherwise(blank),
        "num_pages": F.col("ratings_count").cast("string"),
    }
    typed = {"average_rating", "ratings_count", "text_reviews_count", "publication_year"}

    def field(name: str) -> Column:
        if name in values:
            return values[name].alias(name)
        if name in RECORD_NESTED or name not in rows.columns:
            return blank.alias(name)
        return (F.col(name).cast("string") if name in typed else F.col(name)).alias(name)

    return rows.select(*[field(name) for name in RECORD_FIELDS], F.col("book_id").cast("bigint").alias("pos"))


# --- editions: part ---------------------------------------------------------------

NOVEL_TERMS = ["widget", "gear", "ring"]
OTHER_TERMS = ["rod", "promo"]


def edition_lines(spark: SparkSession, d: str) -> DataFrame:
    """Dump lines, five tab-separated fields, the last one JSON."""
    key = F.col("p_partkey")
    none = F.array().cast("array<string>")
    body = F.struct(
        F.when(key % 7 == 0, none).otherwise(F.array(isbn_of(key))).alias("isbn_13"),
        F.array(F.concat(F.lit(" 0"), F.lpad(key.cast("string"), 9, "0"), F.lit(" "))).alias("isbn_10"),
        F.concat(F.split("p_name", " "), F.array("p_type")).alias("subjects"),
    )
    return table(spark, d, "part").select(
        F.concat_ws(
            "\t", F.lit("/type/edition"), F.concat(F.lit("/books/E"), key.cast("string")),
            F.lit("1"), F.lit("2020-01-01"), F.to_json(body),
        ).alias("value")
    )


EDITIONS_SQL = f"""
editions AS (
  SELECT CASE WHEN p_partkey % 7 = 0 THEN '0' || lpad(CAST(p_partkey AS VARCHAR), 9, '0')
              ELSE {isbn_sql('p_partkey')} END AS isbn,
         lower(p_name || ' ' || p_type) AS subjects, p_partkey
  FROM part),
novels AS (
  SELECT isbn FROM editions
  WHERE regexp_matches(subjects, 'widget|gear|ring') AND NOT regexp_matches(subjects, 'rod|promo'))"""


# --- stored books: documents and labels -------------------------------------------


def books(spark: SparkSession, d: str) -> DataFrame:
    """Scraped books; a document's label gives its rating and its review."""
    doc = F.col("doc_id")
    labels = table(spark, d, "labels")
    rows = table(spark, d, "documents").join(labels, "doc_id", "left")
    language = (
        F.when(doc % 6 == 0, F.lit(None).cast("string"))
        .when(F.col("lang") == "en", "English")
        .when(F.col("lang") == "fr", "French")
        .when(F.col("lang") == "de", "German")
        .otherwise("Spanish")
    )
    review = F.struct(
        F.lit("Anonymous").alias("Author"), F.lit(None).cast("string").alias("AuthorUrl"),
        F.lit(1).alias("Rating"), F.lit(0).cast("bigint").alias("Likes"),
        F.lit(None).cast("string").alias("Date"), F.lit(False).alias("Spoiler"),
        F.col("source").alias("Text"),
    )
    chars = F.col("n_chars")
    return rows.select(
        isbn_of(doc).alias("ISBN"),
        F.col("text").alias("Title"),
        F.col("text").alias("Desc"),
        F.array("source").alias("Genre"),
        F.when(F.col("toxic") == 1, F.array(review))
        .otherwise(F.array().cast(f"array<{REVIEW}>"))
        .alias("Review"),
        F.coalesce(F.col("quality") * 4, F.lit(0)).cast("double").alias("Point"),
        language.alias("Language"),
        chars.alias("RatingsCount"),
        (chars % 100).alias("ReviewsCount"),
        (chars % 10).alias("CurrentlyReadingCount"),
        (chars % 7).alias("WantToReadCount"),
        doc.alias("pos"),
    )


BOOKS_SQL = f"""
books AS (
  SELECT {isbn_sql('d.doc_id')} AS isbn, text AS title, text, source, n_chars,
         coalesce(toxic, 0) = 1 AS has_review, coalesce(quality * 4, 0) AS point,
         CASE WHEN d.doc_id % 6 = 0 THEN NULL WHEN lang = 'en' THEN 'English' WHEN lang = 'fr' THEN 'French'
              WHEN lang = 'de' THEN 'German' ELSE 'Spanish' END AS language,
         d.doc_id AS pos
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
flagged AS (
  SELECT *, CASE WHEN language <> 'English' OR (language IS NULL AND isbn LIKE '9791%') THEN 'non_english'
                 WHEN point = 0 AND NOT has_review THEN 'failed' ELSE 'keep' END AS bucket
  FROM books)"""


# --- resume: customer, part and orders ------------------------------------------------


def isbn_list(spark: SparkSession, d: str) -> DataFrame:
    """ISBNs of customers and of parts; most occur twice."""
    customers = table(spark, d, "customer").select(isbn_of("c_custkey").alias("isbn"))
    return customers.union(table(spark, d, "part").select(isbn_of("p_partkey").alias("isbn")))


def order_sets(spark: SparkSession, d: str) -> DataFrame:
    """Processed ISBNs by outcome; the outcomes overlap."""
    outcome = (
        F.when(F.col("o_orderstatus") == "F", "saved")
        .when(F.col("o_orderstatus") == "O", "failed")
        .otherwise("duplicate")
    )
    return table(spark, d, "orders").select(isbn_of("o_custkey").alias("isbn"), outcome.alias("disposition"))


RESUME_SQL = f"""
listed AS (SELECT {isbn_sql('c_custkey')} AS isbn FROM customer
           UNION ALL SELECT {isbn_sql('p_partkey')} FROM part),
processed AS (SELECT DISTINCT {isbn_sql('o_custkey')} AS isbn FROM orders),
queue AS (
  SELECT isbn, isbn LIKE '9780%' OR isbn LIKE '9781%' AS is_english
  FROM listed WHERE isbn NOT IN (SELECT isbn FROM processed))"""


# --- crawl log: events --------------------------------------------------------------


def log_lines(spark: SparkSession, d: str) -> DataFrame:
    """Log lines of both message forms and of neither."""
    isbn = isbn_of("user_id")
    message = (
        F.when(
            F.col("event_type") == "error",
            F.concat(F.lit("Book '403 Forbidden' for ISBN "), isbn, F.lit(" skipped")),
        )
        .when(F.col("event_type") == "view", F.concat(F.lit("403 Forbidden at ISBN: "), isbn))
        .otherwise(F.concat(F.lit("saved ISBN "), isbn))
    )
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, d, "events").select(F.concat(stamp, F.lit(" [ERROR] "), message).alias("value"))


def failed_list(spark: SparkSession, d: str) -> DataFrame:
    """A checkpoint whose failed list holds users the log does and does not know."""
    users = table(spark, d, "events").select((F.col("user_id") * 2).alias("n")).distinct()
    return users.select(isbn_of("n").alias("isbn"), F.lit("failed").alias("disposition"))


LOG_SQL = f"""
blocked AS (SELECT DISTINCT {isbn_sql('user_id')} AS isbn FROM events WHERE event_type = 'error'),
blocked_loose AS (SELECT DISTINCT {isbn_sql('user_id')} AS isbn FROM events WHERE event_type = 'view'),
failed AS (SELECT DISTINCT {isbn_sql('(user_id * 2)')} AS isbn FROM events)"""


# --- pages ---------------------------------------------------------------------------


def crawled_pages(spark: SparkSession, d: str) -> DataFrame:
    """The raw pages as crawl results; some carry a rating, some were refused."""
    n = F.col("page_id")
    html = F.col("html")
    rating = F.concat(F.lit('<article><div class="x RatingStatistics__rating"> 3.'), (n % 10).cast("string"), F.lit("</div>"))
    html = F.when(n % 3 != 0, F.replace(html, F.lit("<article>"), rating)).otherwise(html)
    html = F.when(n % 17 == 4, F.concat(html, F.lit("<p>403 Forbidden</p>"))).otherwise(html)
    html = F.when(n % 19 == 8, F.concat(html, F.lit("<p>No results</p>"))).otherwise(html)
    return table(spark, d, "pages").select(
        isbn_of(n).alias("isbn"),
        F.when(n % 4 == 0, F.concat(F.lit("/search?q="), n.cast("string")))
        .otherwise(F.concat(F.lit("/book/show/"), n.cast("string")))
        .alias("url"),
        F.when(n % 23 == 1, "403 Forbidden")
        .when(n % 23 == 2, "Access Denied")
        .when(n % 23 == 4, "Showing 1-0 of 0 books")
        .otherwise(markup_text(flat_element(F.col("html"), "title")))
        .alias("page_title"),
        html.alias("html"),
        n.alias("pos"),
    )


def unescape_sql(expr: str) -> str:
    """The entities the raw pages hold; all of them also count without the semicolon."""
    for entity, code in [("copy", 169), ("middot", 183), ("quot", 34), ("lt", 60), ("gt", 62), ("amp", 38)]:
        expr = f"regexp_replace({expr}, '&{entity};?', chr({code}), 'g')"
    return expr


PAGES_SQL = f"""
crawled AS (
  SELECT page_id, {isbn_sql('page_id')} AS isbn,
         {strip_sql(unescape_sql("regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'), '<[^>]*>', '', 'g')"))} AS title,
         CASE WHEN page_id % 23 IN (1, 2) THEN 'blocked' WHEN page_id % 4 <> 0 THEN 'book'
              WHEN page_id % 23 = 4 OR page_id % 19 = 8 THEN 'not_found'
              WHEN page_id % 17 = 4 THEN 'blocked' ELSE 'timeout' END AS status,
         page_id % 3 <> 0 AS rated
  FROM pages),
judged AS (
  SELECT *, CASE WHEN status = 'blocked' THEN 'blocked' WHEN status <> 'book' OR title = '' OR NOT rated THEN 'failed' END
           AS early
  FROM crawled),
triaged AS (
  SELECT *, coalesce(early,
           CASE WHEN row_number() OVER (PARTITION BY early, lower(title) ORDER BY page_id) = 1 THEN 'saved'
                ELSE 'duplicate' END) AS disposition
  FROM judged)"""


# Turns per page: longer conversations go over several pages, so that no page grows without bound.
TURNS = 30


def state_pages(spark: SparkSession, d: str) -> DataFrame:
    """A page with embedded state per document and ``TURNS`` turns of its conversation.

    Documents without a conversation have one page without reviews. The turns are the reviews. System turns are edges that cannot be resolved, and
    assistants have no author node.
    """
    turns = table(spark, d, "conversations").withColumn("sheet", F.floor(F.col("turn") / TURNS))
    ref = lambda kind, *parts: F.concat(F.lit(kind), *parts)
    turn_no = F.col("turn").cast("string")
    edge = F.to_json(F.struct(F.struct(ref("Review:", turn_no).alias("__ref")).alias("node")))
    review = F.to_json(
        F.struct(
            F.col("text"),
            (F.col("turn") % 5 + 1).alias("rating"),
            F.when(F.col("turn") % 2 == 1, F.col("turn")).alias("likeCount"),
            ((F.col("turn") + 1) * 86_400_000).alias("createdAt"),
            F.struct(ref("User:", F.col("role")).alias("__ref")).alias("creator"),
        )
    )
    quoted = lambda key: F.concat(F.lit('"'), key, F.lit('":'))
    per_conv = (
        turns.select(
            "conv_id",
            "sheet",
            F.struct(
                "turn",
                edge.alias("edge"),
                F.when(F.col("role") != "system", F.concat(quoted(ref("Review:", turn_no)), review)).alias("node"),
            ).alias("t"),
        )
        .groupBy("conv_id", "sheet")
        .agg(F.array_sort(F.collect_list("t")).alias("turns"))
    )
    docs = table(spark, d, "documents").join(per_conv, F.col("doc_id") == F.col("conv_id"), "left")
    none = F.array().cast("array<struct<turn:bigint,edge:string,node:string>>")
    docs = docs.withColumn("turns", F.coalesce("turns", none)).withColumn("sheet", F.coalesce("sheet", F.lit(0).cast("bigint")))
    doc = F.col("doc_id")
    language = F.when(doc % 6 == 0, F.lit(None).cast("string")).otherwise(
        F.when(F.col("lang") == "en", "English").otherwise(F.upper("lang"))
    )
    book = F.to_json(
        F.struct(
            F.col("text").alias("title"),
            F.col("text").alias("description"),
            F.struct(F.struct(language.alias("name")).alias("language")).alias("details"),
            F.array(
                F.struct(F.struct(F.col("source").alias("name")).alias("genre")),
                F.struct(F.struct(F.lit("").alias("name")).alias("genre")),
            ).alias("bookGenres"),
        )
    )
    work = F.to_json(
        F.struct(
            F.struct(
                (doc % 50 / F.lit(10.0)).alias("averageRating"), F.col("n_chars").alias("ratingsCount"),
                (F.col("n_chars") % 100).alias("textReviewsCount"),
            ).alias("stats")
        )
    )
    signal = lambda name, count: F.to_json(
        F.struct(F.lit("SocialSignal").alias("__typename"), F.lit(name).alias("name"), count.alias("count"))
    )
    nodes = F.concat(
        F.array(
            F.concat(
                F.lit('"ROOT_QUERY":{"other":1,"getReviews(first)":{"edges":['),
                F.array_join(F.transform("turns", lambda t: t["edge"]), ","),
                F.lit("]}}"),
            ),
            F.concat(quoted(ref("Book:", doc.cast("string"))), book),
            F.concat(quoted(ref("Work:", doc.cast("string"))), work),
            F.concat(quoted(F.lit("S1")), signal("CURRENTLY_READING", doc + 1)),
            F.concat(quoted(F.lit("S2")), signal("TO_READ", doc + 2)),
            F.concat(quoted(F.lit("S3")), signal("TO_READ", doc + 3)),
            F.lit('"User:user":{"name":"Reader","webUrl":"/user/1"}'),
        ),
        F.filter(F.transform("turns", lambda t: t["node"]), lambda x: x.isNotNull()),
    )
    script = F.concat(
        F.lit('<html><head><title>Page</title><script id="__NEXT_DATA__" type="application/json">'),
        F.lit('{"props":{"pageProps":{"apolloState":{'),
        F.array_join(nodes, ","),
        F.lit("}}}}</script></head><body></body></html>"),
    )
    return docs.select(
        isbn_of(doc).alias("isbn"),
        F.concat(F.lit("/book/show/"), doc.cast("string")).alias("url"),
        F.lit("Page").alias("page_title"),
        script.alias("html"),
        doc.alias("pos"),
        "sheet",
    )

"""Page extraction, triage, store cleaning, queue and checkpoint."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.checks import bindings as b
from foliant.checks.registry import query
from foliant.functions.text import clean_html, digits_only, html_unescape, title_key
from foliant.operators import pages as p
from foliant.operators.dedup import first_n, keep_first_by_title, known_titles
from foliant.operators.sets import (
    blocked_isbns, collect_dispositions, merge_checkpoint, processed_isbns,
)
from foliant.operators.summaries import (
    checkpoint_summary, clean_summary, pivot_signals, queue_summary, restore_summary,
)
from foliant.operators.triage import page_status
from foliant.plans.crawl import (
    build_queue, clean_books, flag_books, new_dispositions, removed_isbns, repair_checkpoint,
    saved_books, triage_pages,
)
from foliant.session import scratch
from foliant.sources import readers as r, writers as w

# Sets are split by the first hex digits of a digest, which both engines compute.
CHUNK_SQL = "substring(md5(isbn), 1, 2)"


# --- queue ---------------------------------------------------------------------------


def _queue(spark, d):
    books = b.order_sets(spark, d).where(F.col("disposition") == "saved").select(F.col("isbn").alias("ISBN"))
    rest = b.order_sets(spark, d).where(F.col("disposition") != "saved")
    return build_queue(b.isbn_list(spark, d), books, rest)


@query("resume_queue", f"WITH {b.RESUME_SQL} SELECT isbn, is_english FROM queue")
def resume(spark, d):
    return _queue(spark, d).rows


@query("queue_summary", f"""WITH {b.RESUME_SQL}
    SELECT (SELECT count(*) FROM processed) + count(*) AS total, (SELECT count(*) FROM processed) AS processed,
           count(*) FILTER (is_english) AS remaining_english, count(*) FILTER (NOT is_english) AS skipped_non_english
    FROM queue""")
def summary_of_queue(spark, d):
    queue = _queue(spark, d)
    return queue_summary(queue.processed, queue.rows)


@query("processed_isbns", f"WITH {b.RESUME_SQL} SELECT isbn FROM processed")
def processed(spark, d):
    sets = b.order_sets(spark, d)
    return processed_isbns(*[sets.where(F.col("disposition") == x) for x in ("saved", "failed", "duplicate")])


# --- titles --------------------------------------------------------------------------

DOC_KEY = b.title_key_sql("text")


@query("dedup_first_title", f"""
    SELECT doc_id, CASE WHEN {DOC_KEY} IS NOT NULL THEN
           row_number() OVER (PARTITION BY {DOC_KEY} ORDER BY doc_id) = 1 END AS is_first FROM documents""")
def dedup_first(spark, d):
    docs = b.table(spark, d, "documents").select("doc_id", F.col("text").alias("title"))
    return keep_first_by_title(docs, "title", "doc_id").select("doc_id", "is_first")


KNOWN_SQL = f"""WITH known AS (
      SELECT {b.title_key_sql("text")} AS k FROM benchmark
      UNION SELECT {DOC_KEY} FROM documents JOIN labels USING (doc_id))
    SELECT doc_id FROM documents WHERE {DOC_KEY} {{test}} (SELECT k FROM known WHERE k IS NOT NULL)"""


def _known(spark, d, keep):
    docs = b.table(spark, d, "documents").select("doc_id", F.col("text").alias("title"))
    labelled = docs.join(b.table(spark, d, "labels"), "doc_id", "left_semi").select("title")
    known = b.table(spark, d, "benchmark").select(F.col("text").alias("title")).union(labelled)
    return known_titles(docs, known.select(title_key("title").alias("title_key")), "title", keep).select("doc_id")


@query("known_title_semi", KNOWN_SQL.format(test="IN"))
def known_semi(spark, d):
    return _known(spark, d, True)


@query("known_title_anti", KNOWN_SQL.format(test="NOT IN"))
def known_anti(spark, d):
    return _known(spark, d, False)


# --- stored books --------------------------------------------------------------------


@query("clean_books", f"""WITH {b.BOOKS_SQL}
    SELECT isbn, coalesce(language, 'English') AS language, CAST(point AS DOUBLE) AS point FROM flagged WHERE bucket = 'keep'""")
def clean(spark, d):
    return clean_books(b.books(spark, d)).select(
        F.col("ISBN").alias("isbn"), F.col("Language").alias("language"), F.col("Point").alias("point")
    )


@query("clean_summary", f"""WITH {b.BOOKS_SQL}
    SELECT count(*) AS loaded, count(*) FILTER (bucket <> 'keep') AS removed FROM flagged""")
def summary_of_clean(spark, d):
    return clean_summary(flag_books(b.books(spark, d)))


REMOVED_SQL = f"{b.BOOKS_SQL}, removed AS (SELECT DISTINCT isbn, bucket AS disposition FROM flagged WHERE bucket <> 'keep')"


@query("merge_checkpoint", f"WITH {REMOVED_SQL} SELECT isbn, disposition FROM removed")
def merge(spark, d):
    """Merging the same entries twice changes nothing."""
    removed = removed_isbns(b.books(spark, d))
    return merge_checkpoint(removed, removed)


@query("checkpoint_summary", f"WITH {REMOVED_SQL} SELECT disposition, count(*) AS isbns FROM removed GROUP BY ALL")
def summary_of_checkpoint(spark, d):
    return checkpoint_summary(removed_isbns(b.books(spark, d)).distinct())


@query("collect_dispositions", f"""WITH {REMOVED_SQL}
    SELECT disposition, {CHUNK_SQL} AS chunk, array_to_string(list_sort(list(isbn)), ',') AS isbns FROM removed GROUP BY ALL""")
def collected(spark, d):
    sets = collect_dispositions(removed_isbns(b.books(spark, d)))
    return sets.withColumn("isbns", F.array_join("isbns", ","))


@query("checkpoint_roundtrip", f"WITH {REMOVED_SQL} SELECT isbn, disposition FROM removed")
def checkpoint_roundtrip(spark, d):
    path = scratch(spark, "checkpoint")
    w.write_checkpoint(removed_isbns(b.books(spark, d)), path, chunks=4)
    return r.read_checkpoint(spark, path).select("isbn", "disposition")


# --- crawl log -----------------------------------------------------------------------


@query("blocked_isbns", f"WITH {b.LOG_SQL} SELECT isbn FROM blocked")
def blocked(spark, d):
    return blocked_isbns(b.log_lines(spark, d))


@query("blocked_isbns_fallback", f"WITH {b.LOG_SQL} SELECT isbn FROM blocked_loose")
def blocked_fallback(spark, d):
    """A log in which the usual message has another form."""
    lines = b.log_lines(spark, d)
    return blocked_isbns(lines.select(F.replace("value", F.lit("Book '403 Forbidden'"), F.lit("Book refused")).alias("value")))


@query("restore_blocked", f"""WITH {b.LOG_SQL}
    SELECT isbn, 'failed' AS disposition FROM failed WHERE isbn NOT IN (SELECT isbn FROM blocked)""")
def restore(spark, d):
    return repair_checkpoint(b.failed_list(spark, d), b.log_lines(spark, d)).checkpoint


@query("restore_summary", f"""WITH {b.LOG_SQL}
    SELECT count(*) AS original_failed, count(*) FILTER (isbn IN (SELECT isbn FROM blocked)) AS restored,
           count(*) FILTER (isbn NOT IN (SELECT isbn FROM blocked)) AS new_failed FROM failed""")
def summary_of_restore(spark, d):
    return restore_summary(repair_checkpoint(b.failed_list(spark, d), b.log_lines(spark, d)).flagged)


# --- pages ---------------------------------------------------------------------------


@query("clean_html_text", f"""
    SELECT page_id, {b.strip_sql(b.unescape_sql("regexp_replace(html, '<.*?>', '', 'g')"))} AS text FROM pages""")
def clean_text(spark, d):
    """Tags out, all entities decoded, stripped."""
    return b.table(spark, d, "pages").select("page_id", clean_html("html").alias("text"))


@query("html_unescape_full", f"SELECT page_id, {b.unescape_sql('html')} AS html FROM pages")
def unescape_full(spark, d):
    return b.table(spark, d, "pages").select("page_id", html_unescape("html").alias("html"))


def _markup_sql(pattern: str) -> str:
    inner = f"regexp_replace(regexp_extract(html, '{pattern}', 1, 's'), '<[^>]*>', '', 'g')"
    return b.strip_sql(b.unescape_sql(inner))


@query("page_title", f"SELECT page_id, {_markup_sql('<h1>(.*?)</h1>')} AS title FROM pages")
def page_title(spark, d):
    books = p.extract_books(b.table(spark, d, "pages").select("page_id", "html"), fields=["Title"])
    return books.select("page_id", F.col("Title").alias("title"))


@query("link_texts", """
    WITH links AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="/t[^"]*">(.*?)</a>', 1)) AS link FROM pages),
    firsts AS (SELECT page_id, link FROM links WHERE link <> '' GROUP BY ALL)
    SELECT p.page_id, coalesce(string_agg(link, '|' ORDER BY link), '') AS links
    FROM pages p LEFT JOIN firsts USING (page_id) GROUP BY ALL""")
def links(spark, d):
    found = F.array_sort(p.link_texts(p.without_scripts(F.col("html")), "/t"))
    pages = b.table(spark, d, "pages")
    # The sample links are the relative ones only.
    return pages.select("page_id", F.array_join(found, "|").alias("links"))


@query("count_fallbacks", """
    SELECT page_id, page_id * 1003 AS ratings, page_id * 7 AS reviews, page_id AS reading, page_id % 5 * 11 AS wanted
    FROM pages""")
def count_fallbacks(spark, d):
    """Counters by markup, put into the raw pages."""
    n = F.col("page_id")
    span = lambda testid, value: F.concat(F.lit(f'<span class="a" data-testid="{testid}">'), value, F.lit("</span>"))
    markup = F.concat(
        F.lit("<article>"),
        span("ratingsCount", F.concat(F.format_number(n * 1003, 0), F.lit(" <b>ratings</b>"))),
        span("reviewsCount", F.concat(F.lit("about "), F.format_number(n * 7, 0))),
        F.lit('<div data-testid="currentlyReadingSignal"><div>'), n.cast("string"), F.lit(" people</div></div>"),
        F.when(n % 5 != 0, F.concat(F.lit("<div class=w data-testid=toReadSignal title='a > b'>"), (n % 5 * 11).cast("string"), F.lit(" want</div>")))
        .otherwise(F.lit("")),
    )
    html = F.replace("html", F.lit("<article>"), markup)
    return b.table(spark, d, "pages").select(
        "page_id",
        p.count_markup(html, "span", "ratingsCount").alias("ratings"),
        p.count_markup(html, "span", "reviewsCount").alias("reviews"),
        p.count_markup(html, "div", "currentlyReadingSignal").alias("reading"),
        p.count_markup(html, "div", "toReadSignal").alias("wanted"),
    )


@query("description_fallback", """
    SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'Formatted ' || url WHEN page_id % 3 = 1 THEN 'Head Plain ' || url
                    ELSE 'Meta & ' || url END AS description FROM pages""")
def description_fallback(spark, d):
    """Nested description block, block without a formatted part, and meta tag."""
    n = F.col("page_id")
    formatted = F.concat(
        F.lit('<article><div data-testid="description"><div>Head<div><span class="Formatted x">Formatted <i>'),
        F.col("url"), F.lit("</i></span></div></div></div><div>Tail</div>"),
    )
    plain = F.concat(
        F.lit('<article><div data-testid="description">Head <div>Plain '), F.col("url"),
        F.lit("</div></div><div>Tail</div>"),
    )
    meta = F.concat(F.lit('<article><meta name="description" content="Meta &amp; '), F.col("url"), F.lit('">'))
    html = F.replace("html", F.lit("<article>"), F.when(n % 3 == 0, formatted).when(n % 3 == 1, plain).otherwise(meta))
    books = p.extract_books(b.table(spark, d, "pages").select("page_id", html.alias("html")), fields=["Desc"])
    return books.select("page_id", F.col("Desc").alias("description"))


@query("rating_fallback", """
    SELECT page_id, CASE WHEN page_id % 3 = 2 THEN 0.0 ELSE (page_id % 50) / 10.0::DOUBLE END AS point FROM pages""")
def rating_fallback(spark, d):
    """Rating block, a block that is no number followed by the rated span, and neither."""
    n = F.col("page_id")
    value = (n % 50 / F.lit(10.0)).cast("string")
    block = F.concat(F.lit('<article><div class="a RatingStatistics__rating b"> '), value, F.lit(" </div>"))
    span = F.concat(
        F.lit('<article><div class="RatingStatistics__rating">none</div><span itemprop="ratingValue">'), value, F.lit("</span>")
    )
    html = F.replace("html", F.lit("<article>"), F.when(n % 3 == 0, block).when(n % 3 == 1, span).otherwise(F.lit("<article>")))
    books = p.extract_books(b.table(spark, d, "pages").select("page_id", html.alias("html")), fields=["Point"])
    return books.select("page_id", F.col("Point").alias("point"))


STATE_SQL = f"""
    SELECT d.doc_id, coalesce(c.sheet, 0) AS sheet, {b.strip_sql('d.text')} AS title_text, {b.strip_sql('d.text')} AS description,
           d.source AS genres,
           CASE WHEN d.doc_id % 6 = 0 THEN NULL WHEN lang = 'en' THEN 'English' ELSE upper(lang) END AS language,
           CAST((d.doc_id % 50) AS DOUBLE) / 10.0::DOUBLE AS point, n_chars AS ratings, n_chars % 100 AS reviews,
           d.doc_id + 1 AS reading, d.doc_id + 3 AS wanted, coalesce(c.authors, '') AS authors, coalesce(c.stars, 0) AS stars,
           coalesce(c.likes, 0) AS likes, coalesce(c.days, '') AS days, coalesce(c.chars, 0) AS chars
    FROM documents d LEFT JOIN (
      SELECT conv_id, sheet,
             coalesce(string_agg(CASE role WHEN 'user' THEN 'Reader@/user/1' ELSE 'Anonymous@' END, ',' ORDER BY turn) FILTER (role <> 'system'), '') AS authors,
             CAST(coalesce(sum(turn % 5 + 1) FILTER (role <> 'system'), 0) AS BIGINT) AS stars,
             CAST(coalesce(sum(CASE WHEN turn % 2 = 1 THEN turn ELSE 0 END) FILTER (role <> 'system'), 0) AS BIGINT) AS likes,
             coalesce(string_agg(strftime(make_timestamp((turn + 1) * 86400000000), '%Y-%m-%d'), ',' ORDER BY turn) FILTER (role <> 'system'), '') AS days,
             CAST(coalesce(sum(length({b.strip_sql('text')})) FILTER (role <> 'system'), 0) AS BIGINT) AS chars
      FROM (SELECT *, turn // {b.TURNS} AS sheet, row_number() OVER (PARTITION BY conv_id, turn // {b.TURNS} ORDER BY turn) AS n
            FROM conversations)
      WHERE n <= {p.MAX_REVIEWS} GROUP BY conv_id, sheet) c ON c.conv_id = d.doc_id"""


@query("embedded_state_books", STATE_SQL)
def embedded_state_books(spark, d):
    """All fields from embedded state; ten reviews a page, cut before unresolved ones go."""
    books = p.extract_books(b.state_pages(spark, d))
    total = lambda values: F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return books.select(
        F.col("pos").alias("doc_id"),
        "sheet",
        F.btrim("Title", F.lit(b.WHITESPACE)).alias("title_text"),
        F.col("Desc").alias("description"),
        F.array_join("Genre", ",").alias("genres"),
        F.col("Language").alias("language"),
        F.col("Point").alias("point"),
        F.col("RatingsCount").alias("ratings"),
        F.col("ReviewsCount").alias("reviews"),
        F.col("CurrentlyReadingCount").alias("reading"),
        F.col("WantToReadCount").alias("wanted"),
        F.array_join(
            F.transform("Review", lambda x: F.concat_ws("@", x["Author"], F.coalesce(x["AuthorUrl"], F.lit("")))), ","
        ).alias("authors"),
        total(F.transform("Review", lambda x: x["Rating"].cast("bigint"))).alias("stars"),
        total(F.transform("Review", lambda x: x["Likes"])).alias("likes"),
        F.array_join(F.transform("Review", lambda x: x["Date"]), ",").alias("days"),
        total(F.transform("Review", lambda x: F.length(x["Text"]).cast("bigint"))).alias("chars"),
    )


@query("page_status", f"WITH {b.PAGES_SQL} SELECT isbn, status AS page_status FROM crawled")
def status_of_pages(spark, d):
    return page_status(b.crawled_pages(spark, d)).select("isbn", "page_status")


@query("triage_pages", f"WITH {b.PAGES_SQL} SELECT isbn, disposition FROM triaged")
def triage(spark, d):
    return triage_pages(b.crawled_pages(spark, d), order="pos").select("isbn", "disposition")


@query("triage_saved_books", f"""WITH {b.PAGES_SQL}
    SELECT isbn, title, (30 + page_id % 10) / 10.0::DOUBLE AS point FROM triaged WHERE disposition = 'saved'""")
def triage_saved(spark, d):
    saved = saved_books(triage_pages(b.crawled_pages(spark, d), order="pos"))
    return saved.select(F.col("ISBN").alias("isbn"), F.col("Title").alias("title"), F.col("Point").alias("point"))


@query("triage_checkpoint", f"""WITH {b.PAGES_SQL}
    SELECT isbn, disposition FROM triaged WHERE disposition IN ('failed', 'duplicate', 'non_english')""")
def triage_checkpoint(spark, d):
    return new_dispositions(triage_pages(b.crawled_pages(spark, d), order="pos"))


@query("first_n_reviews", """
    SELECT conv_id, turn FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations)
    WHERE n <= 3""")
def first_reviews(spark, d):
    return first_n(b.table(spark, d, "conversations"), "conv_id", "turn", 3).select("conv_id", "turn")


@query("pivot_signals", """
    SELECT user_id,
           coalesce(arg_max(CAST(json_extract(props, '$.k') AS BIGINT), event_id) FILTER (event_type = 'view'), 0) AS reading,
           coalesce(arg_max(CAST(json_extract(props, '$.k') AS BIGINT), event_id) FILTER (event_type = 'click'), 0) AS wanted
    FROM events GROUP BY user_id""")
def signals(spark, d):
    events = b.table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    return pivot_signals(
        events, "user_id", "event_type", "k", "event_id", {"view": "reading", "click": "wanted"}
    )

"""The streaming operators, run over what has landed and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliant.checks import bindings as b
from foliant.checks.registry import query
from foliant.functions.text import title_key
from foliant.plans.crawl import judge_pages
from foliant.session import scratch
from foliant.streaming import crawl as s
from foliant.streaming.progress import ProgressLog, observed, read_progress
from foliant.streaming.titles import flag_first_titles, state_on_disk


def _landed(spark, rows):
    """The stream of a folder after each of four landings and once more with nothing new.

    Every landing is written by as many tasks as the rows have, and makes one batch of the query
    that is then run over the folder; each run but the first is a restart.
    """
    folder = scratch(spark, "landed")
    for part in range(4):
        rows.where(F.pmod(F.col("pos"), F.lit(4)) == part).write.mode("append").parquet(folder)
        yield s.stream_pages(spark, folder, rows.schema)
    yield s.stream_pages(spark, folder, rows.schema)


def _finish(query) -> None:
    query.awaitTermination()


@query("stream_dedup_titles", f"""
    SELECT DISTINCT {b.title_key_sql("text")} AS title_key FROM documents
    WHERE {b.title_key_sql("text")} IS NOT NULL""")
def stream_dedup(spark, d):
    out, state = scratch(spark, "titles"), scratch(spark, "titles-state")
    docs = b.table(spark, d, "documents").select(F.col("doc_id").alias("pos"), F.col("text").alias("Title"))
    for stream in _landed(spark, docs):
        with state_on_disk(spark):
            query = s.run(s.stream_dedup_titles(stream).select("title_key"), state, out)
        _finish(query)
    return spark.read.parquet(out)


@query("stream_dispositions", f"""WITH {b.PAGES_SQL}
    SELECT coalesce(early, 'open') AS disposition, count(*) AS isbns FROM judged GROUP BY ALL""")
def stream_counts(spark, d):
    """Running counts in complete mode; the last state is the result."""
    out, state = scratch(spark, "counts"), scratch(spark, "counts-state")

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(out)

    for stream in _landed(spark, b.crawled_pages(spark, d)):
        judged = judge_pages(stream).select(F.coalesce("disposition", F.lit("open")).alias("disposition"))
        _finish(s.run(s.stream_dispositions(judged), state, batch=keep, mode="complete"))
    return spark.read.parquet(out)


@query("stream_triage_store", f"""WITH {b.PAGES_SQL}, landed AS (
      SELECT *, row_number() OVER (PARTITION BY early, lower(title) ORDER BY page_id % 4, page_id) AS n FROM judged)
    SELECT isbn, title FROM landed WHERE early IS NULL AND n = 1""")
def stream_store(spark, d):
    """Landed pages through the stateless triage into the store of books."""
    store, state = scratch(spark, "store"), scratch(spark, "store-state")
    for stream in _landed(spark, b.crawled_pages(spark, d)):
        _finish(s.run(s.stream_triage(stream), state, batch=s.store_sink(store, order="pos")))
    books = spark.read.schema("ISBN string, Title string").json(f"{store}/books")
    return books.select(F.col("ISBN").alias("isbn"), F.col("Title").alias("title"))


FIRST_SQL = f"""
    WITH t AS (SELECT doc_id, {b.title_key_sql("text")} AS k FROM documents)
    SELECT doc_id, CASE WHEN k IS NOT NULL THEN row_number() OVER (PARTITION BY k ORDER BY doc_id % 4, doc_id) = 1 END AS is_first FROM t"""


@query("stream_first_titles", FIRST_SQL)
def stream_first(spark, d):
    """The first document of each text by order of arrival, over four batches and restarts."""
    out, state = scratch(spark, "first-titles"), scratch(spark, "first-titles-state")
    docs = b.table(spark, d, "documents").select("doc_id", F.col("doc_id").alias("pos"), title_key("text").alias("title_key"))
    for stream in _landed(spark, docs):
        with state_on_disk(spark):
            query = s.run(flag_first_titles(stream, "pos").select("doc_id", "is_first"), state, out)
        _finish(query)
    return spark.read.parquet(out)


@query("stream_settled_store", f"""WITH {b.PAGES_SQL}, landed AS (
      SELECT *, row_number() OVER (PARTITION BY early, lower(title) ORDER BY page_id % 4, page_id) AS n FROM judged)
    SELECT 'book' AS part, isbn, title FROM landed WHERE early IS NULL AND n = 1
    UNION ALL SELECT 'duplicate', isbn, NULL FROM landed WHERE early IS NULL AND n > 1""")
def stream_settled_store(spark, d):
    """Landed pages settled by the state of their titles; what was saved and what was a duplicate."""
    store, state = scratch(spark, "settled-store"), scratch(spark, "settled-state")
    for stream in _landed(spark, b.crawled_pages(spark, d)):
        _finish(s.run_settled(s.stream_triage(stream), store, state, order="pos"))
    books = spark.read.schema("ISBN string, Title string").json(f"{store}/books")
    noted = spark.read.parquet(f"{store}/checkpoint").where("disposition = 'duplicate'")
    saved = books.select(F.lit("book").alias("part"), F.col("ISBN").alias("isbn"), F.col("Title").alias("title"))
    return saved.unionByName(noted.select(F.lit("duplicate").alias("part"), "isbn", F.lit(None).cast("string").alias("title")))


@query("stream_progress", f"""WITH {b.PAGES_SQL}, landed AS (
      SELECT *, row_number() OVER (PARTITION BY early, lower(title) ORDER BY page_id % 4, page_id) AS n FROM judged)
    SELECT page_id % 4 AS batch, count(*) AS read, count(*) FILTER (early IS NULL AND n = 1) AS saved, count(*) FILTER (early = 'failed') AS failed,
      count(*) FILTER (early IS NULL AND n > 1) AS duplicate, count(*) FILTER (early = 'non_english') AS non_english,
      count(*) FILTER (early = 'blocked') AS blocked FROM landed GROUP BY ALL""")
def stream_progress(spark, d):
    """Counts of every batch, landed by a listener while the crawl ran; the last restart finds nothing new."""
    store, state, log = scratch(spark, "progress-store"), scratch(spark, "progress-state"), scratch(spark, "progress")
    listener = ProgressLog(spark, log)
    spark.streams.addListener(listener)
    try:
        for stream in _landed(spark, b.crawled_pages(spark, d)):
            with state_on_disk(spark):
                started = s.run(observed(s.stream_settled(s.stream_triage(stream), "pos")), state, batch=s.settled_sink(store))
            _finish(started)
            listener.wait(started)
    finally:
        spark.streams.removeListener(listener)
    return read_progress(spark, log).drop("query")

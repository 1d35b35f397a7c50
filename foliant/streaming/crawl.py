"""Pages are triaged as they land; restarts resume from the query checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from foliant.functions.text import title_key
from foliant.operators import triage as t
from foliant.operators.pages import GENRE_HREF
from foliant.plans.crawl import judge_pages, new_dispositions, numbered, saved_books, settle_duplicates, stored_title_keys
from foliant.sources.writers import CSV, scraped_csv_rows
from foliant.streaming.titles import flag_first_titles, state_on_disk


def stream_pages(
    spark: SparkSession, folder: str, schema, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of a folder into which page files land."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def stream_triage(pages: DataFrame, genre_href: str = GENRE_HREF) -> DataFrame:
    """Stateless part of the triage: fields and all dispositions but ``duplicate``."""
    return judge_pages(pages, genre_href)


def stream_dedup_titles(
    books: DataFrame, title: str = "Title", event_time: str | None = None, delay: str | None = None
) -> DataFrame:
    """One row per title over the whole life of the query.

    Of several rows that come in one micro-batch any may be the one kept; ``flag_first_titles``
    keeps the first by an order. The state grows with the number of distinct titles. With ``event_time`` and
    ``delay`` it only spans that interval and stays bounded, at the price of
    letting a title through again after it.
    """
    keyed = books.withColumn("title_key", title_key(title)).where(F.col("title_key").isNotNull())
    if event_time and delay:
        return keyed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["title_key"])
    return keyed.dropDuplicates(["title_key"])


def stream_dispositions(dispositions: DataFrame) -> DataFrame:
    """Running count per disposition; counts are combined before the shuffle."""
    return dispositions.groupBy("disposition").agg(F.count(F.lit(1)).alias("isbns"))


def stream_settled(judged: DataFrame, order: str, known: DataFrame | None = None, ttl_ms: int | None = None) -> DataFrame:
    """Judged pages with every disposition filled in: the first page of a title is saved.

    First by micro-batch, within one by ``order``; see ``flag_first_titles``. ``known`` lists
    the title keys of books stored before the query's first batch.
    """
    flagged = flag_first_titles(judged, order, known, ttl_ms)
    verdict = F.when(F.col("is_first"), t.SAVED).otherwise(F.lit(t.DUPLICATE))
    return flagged.withColumn("disposition", F.coalesce("disposition", verdict)).drop("is_first", "title_key")


def settled_sink(store: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer of settled pages: books as JSON and CSV, checkpoint.

    Every batch owns one partition of each dataset and overwrites it. The state of the query
    knows the titles, so no batch reads what earlier ones have written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        part = f"batch={batch_id}"
        settled_at = f"{store}/settled/{part}"
        batch.write.mode("overwrite").parquet(settled_at)
        _write_store(batch.sparkSession.read.parquet(settled_at), store, part)

    return write


def _write_store(settled: DataFrame, store: str, part: str) -> DataFrame:
    books = saved_books(settled)
    books.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{store}/books/{part}")
    scraped_csv_rows(books).write.mode("overwrite").options(**CSV).csv(f"{store}/books_csv/{part}")
    new_dispositions(settled).write.mode("overwrite").parquet(f"{store}/checkpoint/{part}")
    return books


def run_settled(judged: DataFrame, store: str, checkpoint: str, order: str, known: DataFrame | None = None, **options) -> StreamingQuery:
    """Start the crawl into ``store``: titles settled by state, then written batch by batch."""
    with state_on_disk(judged.sparkSession):
        return run(stream_settled(judged, order, known), checkpoint, batch=settled_sink(store), **options)


def store_sink(store: str, order: str = "isbn") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer of judged pages: books as JSON and CSV, titles, checkpoint.

    Every batch owns one partition of each dataset and overwrites it, so a batch
    that is run again after a failure leaves the store as if it had run once. The
    known titles are a narrow dataset of earlier batches, joined by key, which every batch
    reads: ``run_settled`` keeps them as state instead.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        part = f"batch={batch_id}"
        settled_at = f"{store}/settled/{part}"
        rows = numbered(batch).persist()
        settled = settle_duplicates(rows, order, _titles_before(spark, store, batch_id))
        settled.write.mode("overwrite").parquet(settled_at)
        rows.unpersist()
        books = _write_store(spark.read.parquet(settled_at), store, part)
        stored_title_keys(books).write.mode("overwrite").parquet(f"{store}/titles/{part}")

    return write


def _titles_before(spark: SparkSession, store: str, batch_id: int) -> DataFrame | None:
    try:
        titles = spark.read.parquet(f"{store}/titles")
    except AnalysisException as error:
        # Only a missing folder means that there are no titles yet.
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return titles.where(F.col("batch") < batch_id).select("title_key")


def run(
    stream: DataFrame,
    checkpoint: str,
    path: str | None = None,
    batch: Callable[[DataFrame, int], None] | None = None,
    mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a query into Parquet files at ``path`` or into ``batch``.

    The default trigger works off what has landed and stops.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    if batch is not None:
        return writer.foreachBatch(batch).start()
    return writer.format("parquet").option("path", path).start()

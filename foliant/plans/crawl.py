"""Triage of landed pages, cleaning of the store, work queue and checkpoint repair."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foliant.functions.text import blank_to_null, title_key
from foliant.operators import triage as t
from foliant.operators.dedup import flag_first
from foliant.operators.normalize import backfill_language
from foliant.operators.pages import GENRE_HREF, RECORD, extract_books
from foliant.operators.sets import (
    blocked_isbns, merge_checkpoint, processed_isbns, restore_blocked, resume_queue, split_queue, still_failed,
)
from foliant.operators.summaries import restore_summary
from foliant.session import materialize
from foliant.sources.readers import read_checkpoint, read_crawl_log, read_scraped_books
from foliant.sources.writers import CSV, checkpoint_objects, path_exists, replace_table, rewrite_clean_books, scraped_csv_rows


def judge_pages(pages: DataFrame, genre_href: str = GENRE_HREF) -> DataFrame:
    """Pages -> book fields, ``title_key`` and a disposition, duplicates aside.

    ``disposition`` is NULL for rows that are saved unless their title is taken.
    A projection only, so it runs on streams as well.
    """
    staged = t.page_status(pages)
    html = F.when(F.col("page_status") == "book", F.col("html"))
    books = extract_books(staged.withColumn("html", html), genre_href=genre_href)
    disposition = (
        F.when(F.col("page_status") == "blocked", t.BLOCKED)
        .when(F.col("page_status") != "book", t.FAILED)
        .when(F.col("Title").isNull(), t.FAILED)
        .when(F.contains("Title", F.lit(t.FORBIDDEN)), t.BLOCKED)
        .when(t.non_english_crawl(), t.NON_ENGLISH)
        .when(t.zero_data(), t.FAILED)
    )
    return books.withColumns(
        {
            "disposition": disposition,
            # A blank title is a title of its own: only the first such page is saved.
            "title_key": F.when(disposition.isNull(), F.coalesce(title_key("Title"), F.lit(""))),
        }
    )


def numbered(judged: DataFrame) -> DataFrame:
    """Add ``_row``, which tells pages of equal ``order`` apart."""
    return judged.withColumn("_row", F.monotonically_increasing_id())


def settle_duplicates(judged: DataFrame, order: str, known: DataFrame | None = None) -> DataFrame:
    """Fill in the open dispositions: the first new title is saved, the rest are duplicates.

    Takes ``numbered`` rows. Only rows still open carry a title key, so a title seen
    on a rejected page does not take it.
    """
    flagged = flag_first(judged, "title_key", [order, "_row"], known)
    settled = F.coalesce(
        F.col("disposition"), F.when(F.col("is_first"), t.SAVED).otherwise(F.lit(t.DUPLICATE))
    )
    return flagged.withColumn("disposition", settled).drop("is_first", "title_key", "_row")


def triage_pages(
    pages: DataFrame,
    known: DataFrame | None = None,
    order: str = "isbn",
    genre_href: str = GENRE_HREF,
    stage: Callable[[DataFrame], DataFrame] = materialize,
) -> DataFrame:
    """``(isbn, url, page_title, html)`` -> book fields and ``disposition`` per page.

    ``known`` lists the title keys already stored. ``order`` is the arrival order.
    Page parsing is the costly part and feeds both branches of the deduplication,
    so its result is written to the shared folder first; pass ``stage`` to keep it
    elsewhere, or the identity to leave it lazy.
    """
    return settle_duplicates(stage(numbered(judge_pages(pages, genre_href))), order, known)


def saved_books(triaged: DataFrame) -> DataFrame:
    """The records to store, in the shape of the scraped book."""
    return triaged.where(F.col("disposition") == t.SAVED).select(F.col("isbn").alias("ISBN"), *RECORD)


def new_dispositions(triaged: DataFrame) -> DataFrame:
    """Checkpoint entries of a triage; blocked pages get none and are crawled again."""
    noted = [t.FAILED, t.DUPLICATE, t.NON_ENGLISH]
    return triaged.where(F.col("disposition").isin(noted)).select("isbn", "disposition")


def flag_books(books: DataFrame) -> DataFrame:
    """Add ``bucket`` to stored books: keep, failed or non_english (which wins)."""
    return books.withColumn("bucket", flag_bucket())


def flag_bucket() -> Column:
    return F.when(t.non_english_reload(), t.NON_ENGLISH).when(t.zero_data(), t.FAILED).otherwise("keep")


def clean_books(books: DataFrame) -> DataFrame:
    """Stored books that stay, their language filled in where the ISBN tells it."""
    return backfill_language(flag_books(books).where(F.col("bucket") == "keep").drop("bucket"))


def removed_isbns(books: DataFrame) -> DataFrame:
    """Checkpoint entries for the books ``clean_books`` drops."""
    flagged = flag_books(books).where((F.col("bucket") != "keep") & blank_to_null("ISBN").isNotNull())
    return flagged.select(F.col("ISBN").alias("isbn"), F.col("bucket").alias("disposition"))


def reload_store(spark: SparkSession, books: str, csv: str, checkpoint: str, chunks: int) -> int:
    """Clean a stored crawl: JSON and CSV are written anew, what goes is noted in the checkpoint.

    Returns how many books went; if none did, nothing is touched. ``chunks`` as for ``write_checkpoint``. The checkpoint is
    written first and the stores are swapped whole, so that a job that fails in between
    can simply be run again.
    """
    stored = read_scraped_books(spark, books)
    removed = materialize(removed_isbns(stored), "removed")
    n = stored.agg(F.count_if(flag_bucket() != "keep")).head()[0]
    if not n:
        return 0
    old = read_checkpoint(spark, checkpoint).select("isbn", "disposition") if path_exists(spark, checkpoint) else removed.limit(0)
    noted = merge_checkpoint(old, removed)
    replace_table(checkpoint_objects(noted, chunks), checkpoint, format="json")
    kept = materialize(clean_books(stored), "kept-books")
    replace_table(scraped_csv_rows(kept), csv, CSV, format="csv")
    rewrite_clean_books(kept, n, books)
    return n


def stored_title_keys(books: DataFrame) -> DataFrame:
    keys = books.select(F.coalesce(title_key("Title"), F.when(F.col("Title").isNotNull(), F.lit(""))).alias("title_key"))
    return keys.where(F.col("title_key").isNotNull()).distinct()


@dataclass(frozen=True)
class Queue:
    processed: DataFrame
    rows: DataFrame

    @property
    def english(self) -> DataFrame:
        return self.rows.where("is_english").drop("is_english")


def build_queue(isbns: DataFrame, books: DataFrame, checkpoint: DataFrame) -> Queue:
    """What is left to crawl: listed, not processed; ``rows`` are flagged ``is_english``."""
    stored = books.select(blank_to_null("ISBN").alias("isbn")).where(F.col("isbn").isNotNull())
    processed = processed_isbns(stored, checkpoint)
    return Queue(processed, split_queue(resume_queue(isbns, processed)))


@dataclass(frozen=True)
class Repair:
    checkpoint: DataFrame
    flagged: DataFrame


def repair_store(spark: SparkSession, checkpoint: str, log: str, chunks: int) -> dict[str, int]:
    """``repair_checkpoint`` of a stored checkpoint, written back; returns what ``restore_summary`` counts.

    Nothing is written if no entry is restored.
    """
    repair = repair_checkpoint(read_checkpoint(spark, checkpoint).select("isbn", "disposition"), read_crawl_log(spark, log))
    counts = restore_summary(repair.flagged).head().asDict()
    if counts["restored"]:
        replace_table(checkpoint_objects(repair.checkpoint, chunks), checkpoint, format="json")
    return counts


def repair_checkpoint(checkpoint: DataFrame, log: DataFrame) -> Repair:
    """Take ISBNs out of the failed list that the log shows as blocked.

    ``checkpoint`` is the repaired one; ``flagged`` the failed entries with ``restored``.
    """
    blocked = blocked_isbns(log)
    failed = checkpoint.where(F.col("disposition") == t.FAILED)
    others = checkpoint.where(F.col("disposition") != t.FAILED)
    return Repair(
        others.unionByName(still_failed(failed, blocked)), restore_blocked(failed, blocked)
    )

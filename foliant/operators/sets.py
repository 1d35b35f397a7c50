"""Set operators over ISBN lists, checkpoints and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from foliant.functions.isbn import (
    BLOCKED_MARK, blocked_isbn, blocked_isbn_fallback, is_english_isbn,
)
from foliant.operators.pinning import pinned


def processed_isbns(*sets: DataFrame) -> DataFrame:
    """Distinct union of ``isbn`` frames."""
    union = sets[0].select("isbn")
    for other in sets[1:]:
        union = union.union(other.select("isbn"))
    return union.distinct()


def merge_checkpoint(checkpoint: DataFrame, *updates: DataFrame) -> DataFrame:
    """Add ``(isbn, disposition)`` rows to the sets; adding twice changes nothing."""
    merged = checkpoint.select("isbn", "disposition")
    for update in updates:
        merged = merged.unionByName(update.select("isbn", "disposition"))
    return merged.distinct()


def append_books(books: DataFrame, *more: DataFrame) -> DataFrame:
    """Bag union by column name: repeats are kept, missing columns become NULL."""
    for other in more:
        books = books.unionByName(other, allowMissingColumns=True)
    return books


def resume_queue(isbns: DataFrame, processed: DataFrame) -> DataFrame:
    """ISBNs not processed yet; repeats in the list are kept.

    The processed side is made distinct first, so only the list can hold hot keys,
    and that is the side an adaptive skew join may split.
    """
    return isbns.join(pinned(processed.select("isbn").distinct()), "isbn", "left_anti")


def split_queue(queue: DataFrame) -> DataFrame:
    """Add ``is_english``: only those are crawled."""
    return queue.withColumn("is_english", is_english_isbn("isbn"))


def blocked_isbns(log: DataFrame, line: str = "value") -> DataFrame:
    """Distinct ISBNs a crawl log names as blocked.

    The looser message form counts only if the usual one occurs nowhere in the log;
    that check is an uncorrelated subquery that stops at its first hit, while both
    forms are taken in one scan.
    """
    usual = blocked_isbn(line)
    # Both forms hold the mark, and few lines do: no other line meets a pattern.
    marked = log.where(F.contains(F.col(line), F.lit(BLOCKED_MARK)))
    named = marked.select(
        F.coalesce(usual, blocked_isbn_fallback(line)).alias("isbn"), usual.isNotNull().alias("usual")
    ).where(F.col("isbn").isNotNull())
    only_loose = ~named.where("usual").exists()
    return named.where(F.col("usual") | only_loose).select("isbn").distinct()


def restore_blocked(failed: DataFrame, blocked: DataFrame) -> DataFrame:
    """Add ``restored`` to the failed entries: true where the page was only blocked."""
    hits = blocked.select("isbn").distinct().withColumn("_hit", F.lit(True))
    rows = failed.join(pinned(hits), "isbn", "left")
    return rows.select(*failed.columns, F.coalesce("_hit", F.lit(False)).alias("restored"))


def still_failed(failed: DataFrame, blocked: DataFrame) -> DataFrame:
    """Failed entries that were not merely blocked; order columns and repeats are kept."""
    return failed.join(pinned(blocked.select("isbn").distinct()), "isbn", "left_anti")


def collect_dispositions(dispositions: DataFrame, digits: int = 2) -> DataFrame:
    """Distinct ISBNs per disposition as sorted lists, each set in ``16 ** digits`` pieces.

    A set may outgrow one task, so a row holds the ISBNs whose digest starts with
    its ``chunk``. ``digits=0`` gives one list per disposition, for small sets only.
    """
    chunk = F.substring(F.md5("isbn"), 1, digits).alias("chunk")
    return dispositions.groupBy("disposition", chunk).agg(
        F.sort_array(F.collect_set("isbn")).alias("isbns")
    )

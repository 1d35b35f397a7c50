"""One-row and per-group summaries; all partially aggregated before any shuffle."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from foliant.operators.normalize import has_book_id


def catalog_status(spark: SparkSession, path: str) -> DataFrame:
    """``(available, records, message)`` of a stored catalog, also if there is none."""
    try:
        counted = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("records"))
    except AnalysisException as error:
        reason = error.getCondition() or "unreadable"
        return spark.range(1).select(
            F.lit(False).alias("available"),
            F.lit(0).cast("bigint").alias("records"),
            F.lit(f"Catalog does not exist or is invalid: {reason}").alias("message"),
        )
    return counted.select(
        F.lit(True).alias("available"),
        "records",
        F.concat(F.lit("Catalog exists. Total records: "), F.format_number("records", 0)).alias("message"),
    )


def distinct_isbn_count(isbns: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return isbns.agg(count("isbn").alias("isbns"))


def observe_ingest(records: DataFrame, observation: Observation | str) -> DataFrame:
    """Count records read and skipped while they flow past, at no extra pass."""
    return records.observe(
        observation,
        F.count(F.lit(1)).alias("read"),
        F.count_if(has_book_id()).alias("indexed"),
        F.count_if(~has_book_id()).alias("skipped"),
    )


def observe_parsing(raw: DataFrame, observation: Observation | str) -> DataFrame:
    """Count the texts that were no record, and drop them; for readers with ``keep_malformed``."""
    counted = raw.observe(observation, F.count_if(F.col("plain").isNull()).alias("parse_errors"))
    return counted.where(F.col("plain").isNotNull())


def parse_summary(raw: DataFrame) -> DataFrame:
    """``records`` and ``parse_errors`` of what a reader with ``keep_malformed`` gives."""
    return raw.agg(
        F.count_if(F.col("plain").isNotNull()).alias("records"), F.count_if(F.col("plain").isNull()).alias("parse_errors")
    )


def ingest_counters(records: DataFrame) -> DataFrame:
    return records.agg(
        F.count(F.lit(1)).alias("read"),
        F.count_if(has_book_id()).alias("indexed"),
        F.count_if(~has_book_id()).alias("skipped"),
    )


def checkpoint_summary(dispositions: DataFrame) -> DataFrame:
    return dispositions.groupBy("disposition").agg(F.count(F.lit(1)).alias("isbns"))


def queue_summary(processed: DataFrame, queue: DataFrame) -> DataFrame:
    """Total, processed, remaining English and skipped; ``queue`` carries ``is_english``."""
    rows = processed.select(F.lit(None).cast("boolean").alias("is_english")).unionByName(
        queue.select("is_english")
    )
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("is_english").isNull()).alias("processed"),
        F.count_if(F.col("is_english")).alias("remaining_english"),
        F.count_if(~F.col("is_english")).alias("skipped_non_english"),
    )


def clean_summary(flagged: DataFrame) -> DataFrame:
    """Books loaded and removed; ``flagged`` carries ``bucket``."""
    return flagged.agg(
        F.count(F.lit(1)).alias("loaded"),
        F.count_if(F.col("bucket") != "keep").alias("removed"),
    )


def restore_summary(flagged: DataFrame) -> DataFrame:
    """Failed entries before, restored and left; ``flagged`` carries ``restored``."""
    return flagged.agg(
        F.count(F.lit(1)).alias("original_failed"),
        F.count_if("restored").alias("restored"),
        F.count_if(~F.col("restored")).alias("new_failed"),
    )


def match_count(hits: DataFrame) -> DataFrame:
    return hits.agg(F.count(F.lit(1)).alias("matches"))


def pivot_signals(
    rows: DataFrame, key: str, name: str, count: str, order: str, columns: dict[str, str]
) -> DataFrame:
    """Per ``key``, the last count of each signal name in ``columns``, 0 if it never occurs.

    ``max_by`` keeps one pair per key and name in each task, so hot keys stay small.
    """
    last = lambda signal: F.max_by(
        F.when(F.col(name) == signal, F.col(count)), F.when(F.col(name) == signal, F.col(order))
    )
    zero = F.lit(0).cast("bigint")
    return rows.groupBy(key).agg(
        *[F.coalesce(last(signal), zero).alias(alias) for signal, alias in columns.items()]
    )

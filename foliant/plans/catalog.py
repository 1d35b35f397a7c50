"""Raw records -> catalog table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from foliant.operators.compact import compactly
from foliant.operators.dedup import keep_last_by_id
from foliant.operators.normalize import has_book_id, normalize_books, to_catalog
from foliant.operators.summaries import observe_ingest, observe_parsing
from foliant.sources.readers import read_books
from foliant.sources.writers import write_catalog


def build_catalog(raw: DataFrame, observation: Observation | None = None, with_record: bool = True) -> DataFrame:
    """Raw records -> one typed row per ``book_id``, the last record winning.

    One shuffle, on ``book_id``, with earlier records of an id dropped before it. It carries the
    records; typed rows, which hold most texts twice, are made of what is left.
    """
    return catalog_of(normalize_books(raw), observation, with_record)


def catalog_of(records: DataFrame, observation: Observation | None = None, with_record: bool = True) -> DataFrame:
    """The same from normalised records that carry ``pos``."""
    if observation is not None:
        records = observe_ingest(records, observation)
    return compactly(
        records.where(has_book_id()),
        lambda rows: keep_last_by_id(rows, "book_id", "pos").drop("pos"),
        ["book_id", "pos"],
        lambda last: to_catalog(last, with_record),
        ["book_id"],
    )


def build_catalog_files(
    spark: SparkSession, source: str, target: str, format: str = "auto"
) -> dict[str, int]:
    """Rebuild the catalog at ``target``; returns the counters read, indexed, skipped, parse_errors."""
    counters, errors = Observation("ingest"), Observation("parse")
    raw = read_books(spark, source, format, keep_malformed=True)
    write_catalog(build_catalog(observe_parsing(raw, errors), counters), target)
    return counters.get | errors.get

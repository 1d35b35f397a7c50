"""Sinks. All writes are task-parallel appends or staged replacements."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from foliant.functions.jsons import to_json_text
from foliant.functions.text import falsy_coalesce
from foliant.operators.compact import compactly
from foliant.schemas import DISPOSITIONS, SCRAPED_FIELDS

# Cells are written as they are: quotes doubled, blanks kept, NULL as nothing.
CSV = {
    "header": True, "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
BLOOM_COLUMNS = ["isbn", "isbn13", "asin"]
# Compressed texts are read by one task per file, so their files are kept small.
RECORDS_PER_FILE = 10_000


def write_isbn_list(isbns: DataFrame, path: str, mode: str = "error") -> None:
    """One distinct ISBN per line."""
    isbns.select("isbn").distinct().write.mode(mode).text(path)


def append_books_json(books: DataFrame, path: str, compression: str | None = None) -> None:
    """Append nested records as JSON Lines; NULL fields are written out.

    With ``compression`` (``gzip``) a file holds at most ``RECORDS_PER_FILE`` records.
    """
    files = books.write.mode("append").option("ignoreNullFields", "false")
    if compression:
        files = files.options(compression=compression, maxRecordsPerFile=RECORDS_PER_FILE)
    files.json(path)


def scraped_csv_rows(books: DataFrame) -> DataFrame:
    """The fixed CSV columns: nested fields as JSON text, missing counts as 0."""
    def cell(name: str, type_: str):
        if type_.startswith("array"):
            value = F.coalesce(to_json_text(name), F.lit("[]"))
        elif type_ == "bigint":
            value = F.coalesce(F.col(name), F.lit(0).cast("bigint"))
        elif type_ == "string":
            value = F.coalesce(F.col(name), F.lit(""))
        else:
            value = F.col(name)
        return value.alias(name)

    return books.select(*[cell(n, t) for n, t in SCRAPED_FIELDS.items()])


def write_books_csv(books: DataFrame, path: str, mode: str = "append") -> None:
    scraped_csv_rows(books).write.mode(mode).options(**CSV).csv(path)


def checkpoint_objects(dispositions: DataFrame, chunks: int) -> DataFrame:
    """``(isbn, disposition)`` -> one row of three distinct lists per chunk.

    The entries are spread over ``chunks`` rows by a hash of the ISBN, so no row
    has to hold a whole set.
    """
    chunk = F.pmod(F.xxhash64("isbn"), F.lit(chunks))
    lists = [
        F.sort_array(F.collect_set(F.when(F.col("disposition") == d, F.col("isbn")))).alias(f"{d}_isbns")
        for d in DISPOSITIONS
    ]
    return dispositions.groupBy(chunk.alias("chunk")).agg(*lists).drop("chunk")


def write_checkpoint(dispositions: DataFrame, path: str, chunks: int, mode: str = "error") -> None:
    """Write the checkpoint as ``chunks`` JSON objects of three lists, one per line.

    One object holds its lists in one task: give about one chunk per 100,000 entries.
    The reader takes all objects together.
    """
    checkpoint_objects(dispositions, chunks).write.mode(mode).json(path)


def write_catalog(catalog: DataFrame, path: str, sort_by: str | None = "book_id") -> None:
    """Rebuild the catalog table.

    Files hold disjoint ranges of ``sort_by`` and are sorted by it, so that a lookup or a
    page's late fetch opens the files of its ids only; that takes a shuffle of the
    finished rows. The other identifiers get bloom filters of a size that fits their
    values. With ``sort_by=None`` rows stay as they are.
    """
    if sort_by:
        catalog = compactly(catalog, lambda rows: rows.repartitionByRange(sort_by).sortWithinPartitions(sort_by), [sort_by])
    blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in BLOOM_COLUMNS}
    replace_table(catalog, path, blooms | {"parquet.bloom.filter.adaptive.enabled": "true"})


def replace_table(df: DataFrame, path: str, options: dict[str, str] | None = None, format: str = "parquet") -> None:
    """Write next to ``path``, then swap: the old table may be an input of ``df``.

    The old table is moved aside and only removed when the new one is in its place; it is
    moved back if that fails.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    staged, aside = (f"{path.rstrip('/')}.{kind}-{mark}" for kind in ("staged", "old"))
    df.write.format(format).options(**(options or {})).save(staged)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    target = hadoop(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    had_one = files.exists(target)
    if had_one and not files.rename(target, hadoop(aside)):
        raise OSError(f"could not move {path} aside")
    if not files.rename(hadoop(staged), target):
        if had_one:
            files.rename(hadoop(aside), target)
        raise OSError(f"could not move {staged} to {path}")
    if had_one:
        files.delete(hadoop(aside), True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def rewrite_clean_books(kept: DataFrame, removed: int, path: str) -> bool:
    """Replace the JSON store by its clean records, only if something was removed."""
    if removed == 0:
        return False
    replace_table(kept, path, {"ignoreNullFields": "false"}, format="json")
    return True


def export_rows(records: DataFrame) -> DataFrame:
    """The 14 export columns of normalised records."""
    authors = F.array_join(F.transform("authors", lambda a: F.coalesce(a["author_id"], F.lit(""))), ",")
    blank = lambda name: F.coalesce(F.col(name), F.lit("")).alias(name)
    return records.select(
        blank("book_id"),
        falsy_coalesce("title", "title_without_series", default="").alias("title"),
        F.coalesce(authors, F.lit("")).alias("authors"),
        *[
            blank(name)
            for name in [
                "average_rating", "ratings_count", "isbn", "isbn13", "asin", "language_code",
                "publication_year", "publisher", "format", "is_ebook", "link",
            ]
        ],
    )


def export_results_csv(records: DataFrame, path: str, mode: str = "error") -> None:
    export_rows(records).write.mode(mode).options(**CSV).csv(path)


def export_results_json(records: DataFrame, path: str, mode: str = "error") -> None:
    records.write.mode(mode).option("ignoreNullFields", "false").json(path)

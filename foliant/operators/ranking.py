"""Sorting, paging and positions of search results."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from foliant.operators.normalize import count_value, rating_value, year_value
from foliant.session import materialize

PAGE_SIZE = 10
# Rows of a page that one task may rank.
ONE_TASK = 100_000

SORT_COLUMNS = {
    "rating": "average_rating",
    "reviews": "text_reviews_count",
    "year": "publication_year",
    "popularity": "ratings_count",
}
_PARSE = {"rating": rating_value, "reviews": count_value, "year": year_value, "popularity": count_value}


def sort_keys(sort_by: str | None, tie: str = "book_id") -> list[Column]:
    """Largest first, unknown last; ties by ``tie``. Unknown names mean popularity."""
    return [F.desc_nulls_last(SORT_COLUMNS.get(sort_by or "", "ratings_count")), F.asc(tie)]


def scan_sort_keys(sort_by: str, tie: str = "book_id") -> list[Column]:
    """``sort_keys`` for records whose numbers are still text."""
    name = sort_by if sort_by in SORT_COLUMNS else "popularity"
    return [F.desc_nulls_last(_PARSE[name](SORT_COLUMNS[name])), F.asc(tie)]


def sort_results(df: DataFrame, sort_by: str | None = "popularity", tie: str = "book_id") -> DataFrame:
    return df.orderBy(*sort_keys(sort_by, tie))


def limit_offset(df: DataFrame, limit: int = PAGE_SIZE, offset: int = 0) -> DataFrame:
    """A page of a sorted frame: each task keeps its best ``offset + limit`` rows only."""
    if offset:
        df = df.offset(offset)
    return df.limit(limit)


def page(df: DataFrame, number: int, size: int = PAGE_SIZE) -> DataFrame:
    return limit_offset(df, size, (number - 1) * size)


def result_position(hits: DataFrame, keys: list[Column], name: str = "position", limit: int = PAGE_SIZE) -> DataFrame:
    """1-based place within a page of at most ``limit`` rows; a page beyond ``ONE_TASK`` is ranked by many."""
    if limit > ONE_TASK:
        return positions(hits, keys, name)
    return hits.withColumn(name, F.row_number().over(Window.orderBy(*keys)).cast("bigint"))


def positions(rows: DataFrame, keys: list[Column], name: str = "position") -> DataFrame:
    """1-based place of every row in the order of ``keys``, however many there are.

    Rows are sorted over ranges and written once; a range's first place follows from the
    sizes of those before it, of which the driver adds up one per task.
    """
    sorted_ = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # The upper bits of the number name the task, the lower ones count its rows.
    placed = materialize(sorted_.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    task, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("n")).orderBy("_task").collect()
    before = dict(zip((r["_task"] for r in sizes), accumulate((r["n"] for r in sizes), initial=0)))
    first = rows.sparkSession.createDataFrame(list(before.items()), "_task bigint, _before bigint")
    numbered = placed.withColumn("_task", task).join(F.broadcast(first), "_task")
    return numbered.select(*rows.columns, (F.col("_before") + row + 1).alias(name))


def deep_page(rows: DataFrame, keys: list[Column], limit: int, offset: int, name: str = "position") -> DataFrame:
    """A page far behind the first rows, with its places in the whole result. No task holds what is skipped."""
    placed = positions(rows, keys, name)
    return placed.where((F.col(name) > offset) & (F.col(name) <= offset + limit))


def page_summary(hits: DataFrame, number: int, size: int = PAGE_SIZE) -> DataFrame:
    """Label, shown range and whether a next page is likely (the page is full)."""
    start = (number - 1) * size + 1
    rows = F.count(F.lit(1))
    return hits.agg(rows.alias("rows")).select(
        F.lit(f"Page {number}").alias("label"),
        "rows",
        F.when(F.col("rows") == 0, F.lit("No matches found"))
        .otherwise(F.concat(F.lit(f"Showing books {start}-"), (F.col("rows") + start - 1).cast("string")))
        .alias("shown"),
        F.lit(number > 1).alias("has_previous"),
        (F.col("rows") == size).alias("has_next"),
    )

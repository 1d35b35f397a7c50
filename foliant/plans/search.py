"""Search over the catalog or over raw records, lookups and similar books."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from foliant.operators.normalize import normalize_books, record_columns
from foliant.operators.pinning import pinned
from foliant.operators.predicates import SearchSpec, apply_scan_spec, apply_spec
from foliant.operators.ranking import (
    limit_offset, result_position, scan_sort_keys, sort_keys, sort_results,
)
from foliant.session import materialize
from foliant.sources.readers import read_books


def search(catalog: DataFrame, spec: SearchSpec) -> DataFrame:
    """Page of typed catalog rows with their ``position``.

    Filter and top-k run on the typed columns only: the plan is a pruned scan and a
    ``TakeOrderedAndProject``, without a full shuffle.
    """
    rows = catalog.drop("record")
    hits = limit_offset(sort_results(apply_spec(rows, spec), spec.sort_by), spec.limit, spec.offset)
    return result_position(hits, sort_keys(spec.sort_by), limit=spec.limit)


def fetch_full_records(hits: DataFrame, records: DataFrame) -> DataFrame:
    """Full records of a page of hits, in page order. The page is broadcast if it turns out small."""
    return records.join(hits.select("book_id", "position"), "book_id").orderBy("position")


def search_records(catalog: DataFrame, spec: SearchSpec) -> DataFrame:
    """Page of full records in result order, lazily: top-k first, wide columns after."""
    return fetch_full_records(search(catalog, spec), catalog).select(*record_columns(), "position")


def search_page(catalog: DataFrame, spec: SearchSpec) -> DataFrame:
    """``search_records`` in two jobs: the ids of the page become a pushed filter.

    The second scan then skips every row group whose statistics exclude the ids, instead of
    decoding the wide columns of the whole table. The ids of one page pass through the
    driver; take ``search_records`` for pages too large for that.
    """
    ids = [row.book_id for row in search(catalog, spec).select("book_id", "position").orderBy("position").collect()]
    found = catalog.where(F.col("book_id").isin(ids))
    place = F.array_position(F.array(*[F.lit(i) for i in ids]).cast("array<string>"), F.col("book_id"))
    return found.select(*record_columns(), place.alias("position")).orderBy("position")


def scan_search(raw: DataFrame, spec: SearchSpec, order: str = "pos") -> DataFrame:
    """Search without a catalog, over raw or normalised records.

    Without ``sort_by`` the first matches in source order are returned (``scan_first`` stops
    reading files at the last of them); otherwise matches are sorted before the offset is
    taken, as in the catalog search.
    """
    # Conditions and sort keys name a field many times over: each is to be computed once.
    records = pinned(normalize_books(raw)) if "plain" in raw.columns else raw
    found = apply_scan_spec(records, spec)
    keys = scan_sort_keys(spec.sort_by) if spec.sort_by else [F.asc(order)]
    hits = limit_offset(found.orderBy(*keys), spec.limit, spec.offset)
    return result_position(hits, keys, limit=spec.limit)


def scan_first(spark: SparkSession, path: str | list[str], spec: SearchSpec, format: str = "jsonl") -> DataFrame:
    """The first matches of record files in source order; files behind the last one are not read.

    Files are read in order, the first alone and then four times as many each time, until the
    page is full: one job per step, and never more than the page is kept of it.
    """
    # The order of ``pos``.
    files = sorted(spark.read.text(path).inputFiles())
    need, at, step = spec.offset + spec.limit, 0, 1
    found: list[DataFrame] = []
    while need > 0 and at < len(files):
        records = normalize_books(read_books(spark, files[at : at + step], format))
        hits = materialize(apply_scan_spec(records, spec).orderBy("pos").limit(need), "first-matches")
        need -= hits.count()
        found.append(hits)
        at, step = at + step, step * 4
    if not found:
        return scan_search(read_books(spark, path, "jsonl"), spec)
    hits = limit_offset(reduce(DataFrame.unionByName, found).orderBy("pos"), spec.limit, spec.offset)
    return result_position(hits, [F.asc("pos")], limit=spec.limit)


def lookup(catalog: DataFrame, book_id: str | int) -> DataFrame:
    """The book with this id."""
    return search(catalog, SearchSpec(book_id_query=book_id, limit=1))


def next_page(spec: SearchSpec) -> SearchSpec:
    return replace(spec, offset=spec.offset + spec.limit)


def similar_edges(books: DataFrame) -> DataFrame:
    """``similar_books`` lists, here or in ``record`` as a catalog keeps them -> one edge per row."""
    listed = "similar_books" if "similar_books" in books.columns else "record.similar_books"
    return books.select("book_id", F.posexplode(listed).alias("rank", "similar_id"))


def similar(books: DataFrame, catalog: DataFrame, book_id: str | None = None) -> DataFrame:
    """One hop along ``similar_books``; ids not in the catalog give no row.

    A book many others point to makes its edges a hot key. They are the many-row
    side of the join, which an adaptive skew join splits; catalog ids are unique.
    """
    if book_id is not None:
        books = books.where(F.col("book_id") == book_id)
    edges = similar_edges(books)
    targets = catalog.select(F.col("book_id").alias("similar_id"), *[
        F.col(c).alias(f"similar_{c}")
        for c in catalog.columns
        if c not in ("book_id", "record", "similar_books")
    ])
    return edges.join(targets, "similar_id")

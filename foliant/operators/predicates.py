"""Search predicates over the typed catalog and their twins over raw records."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from foliant.functions.text import blank_to_null, falsy_coalesce, try_float, try_int
from foliant.operators.normalize import flag_value

# No query text holds this character, so nothing in a pattern is ever escaped.
NO_ESCAPE = "\x01"


@dataclass(frozen=True)
class SearchSpec:
    """A search request. Empty texts and ``None`` mean "not asked for"."""

    title_query: str | None = None
    isbn_query: str | None = None
    book_id_query: str | int | None = None
    rating_min: float | None = None
    rating_max: float | None = None
    reviews_min: int | None = None
    publication_year: int | None = None
    publication_year_min: int | None = None
    publication_year_max: int | None = None
    language_code: str | None = None
    is_ebook: bool | None = None
    publisher_query: str | None = None
    author_id: str | int | None = None
    shelf: str | None = None
    sort_by: str | None = "popularity"
    limit: int = 10
    offset: int = 0


def like(column: str, text: str) -> Column:
    """Substring match in any case, '%' and '_' in ``text`` acting as wildcards."""
    return F.ilike(F.col(column), F.lit(f"%{text}%"), F.lit(NO_ESCAPE))


def holds(text: Column, part: str) -> Column:
    """Literal substring match in any case."""
    return F.contains(F.lower(text), F.lower(F.lit(part)))


def catalog_predicates(spec: SearchSpec) -> list[Column]:
    """One condition per supplied field, those a Parquet scan can use first."""
    found: list[Column] = []
    if spec.book_id_query:
        found.append(F.col("book_id") == str(spec.book_id_query))
    if spec.isbn_query:
        found.append(
            (F.col("isbn") == spec.isbn_query)
            | (F.col("isbn13") == spec.isbn_query)
            | (F.col("asin") == spec.isbn_query)
        )
    if spec.rating_min is not None:
        found.append(F.col("average_rating") >= float(spec.rating_min))
    if spec.rating_max is not None:
        found.append(F.col("average_rating") <= float(spec.rating_max))
    if spec.reviews_min is not None:
        found.append(F.col("text_reviews_count") >= spec.reviews_min)
    if spec.publication_year is not None:
        found.append(F.col("publication_year") == spec.publication_year)
    if spec.publication_year_min is not None:
        found.append(F.col("publication_year") >= spec.publication_year_min)
    if spec.publication_year_max is not None:
        found.append(F.col("publication_year") <= spec.publication_year_max)
    if spec.language_code:
        found.append(F.col("language_code") == spec.language_code)
    if spec.is_ebook is not None:
        found.append(F.col("is_ebook") == spec.is_ebook)
    if spec.author_id:
        found.append(F.array_contains("author_ids", str(spec.author_id)))
    if spec.shelf:
        found.append(F.array_contains("shelves", spec.shelf.lower()))
    if spec.publisher_query:
        found.append(like("publisher", spec.publisher_query))
    if spec.title_query:
        found.append(like("title", spec.title_query) | like("description", spec.title_query))
    return found


def apply_spec(catalog: DataFrame, spec: SearchSpec) -> DataFrame:
    """Keep catalog rows meeting every supplied condition."""
    return _where_all(catalog, catalog_predicates(spec))


def _or_zero(name: str, parse) -> Column:
    """Missing -> 0; unparsable -> NULL, which no comparison lets pass."""
    return F.when(blank_to_null(name).isNull(), F.lit(0)).otherwise(parse(name))


def scan_rating() -> Column:
    # NaN fails neither bound of the raw scan.
    return _or_zero("average_rating", try_float)


def scan_year() -> Column:
    return _or_zero("publication_year", try_int)


def scan_predicates(spec: SearchSpec) -> list[Column]:
    """The same conditions on normalised records, whose values are still text."""
    found: list[Column] = []
    if spec.book_id_query:
        found.append(F.col("book_id") == str(spec.book_id_query))
    if spec.isbn_query:
        found.append(
            (F.col("isbn") == spec.isbn_query)
            | (F.col("isbn13") == spec.isbn_query)
            | (F.col("asin") == spec.isbn_query)
        )
    rating = scan_rating()
    if spec.rating_min is not None:
        found.append(F.isnan(rating) | (rating >= float(spec.rating_min)))
    if spec.rating_max is not None:
        found.append(F.isnan(rating) | (rating <= float(spec.rating_max)))
    if spec.reviews_min is not None:
        found.append(_or_zero("text_reviews_count", try_int) >= spec.reviews_min)
    if spec.publication_year is not None:
        found.append(scan_year() == spec.publication_year)
    if spec.publication_year_min is not None:
        found.append(scan_year() >= spec.publication_year_min)
    if spec.publication_year_max is not None:
        found.append(scan_year() <= spec.publication_year_max)
    if spec.language_code:
        found.append(F.col("language_code") == spec.language_code)
    if spec.is_ebook is not None:
        found.append(flag_value("is_ebook") == spec.is_ebook)
    if spec.author_id:
        found.append(F.exists("authors", lambda a: a["author_id"] == str(spec.author_id)))
    if spec.shelf:
        found.append(
            F.exists("popular_shelves", lambda s: F.lower(s["name"]) == F.lower(F.lit(spec.shelf)))
        )
    if spec.publisher_query:
        found.append(holds(F.col("publisher"), spec.publisher_query))
    if spec.title_query:
        title = falsy_coalesce("title", "title_without_series", default="")
        # One side may be NULL, which must not hide a match on the other.
        description = F.coalesce(F.col("description"), F.lit(""))
        found.append(holds(title, spec.title_query) | holds(description, spec.title_query))
    return found


def apply_scan_spec(records: DataFrame, spec: SearchSpec) -> DataFrame:
    """Keep normalised records meeting every supplied condition."""
    return _where_all(records, scan_predicates(spec))


def _where_all(df: DataFrame, conditions: list[Column]) -> DataFrame:
    return df.where(reduce(and_, conditions)) if conditions else df

"""Display projections of normalised records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from foliant.functions.isbn import best_identifier
from foliant.functions.text import (
    blank_to_null, excerpt, falsy_coalesce, pub_date_label, thousands, try_int,
)


@dataclass(frozen=True)
class CardStyle:
    author_prefix: str
    shelf_counts: bool
    no_format: str
    excerpt_size: int


# The two layouts in which results are shown.
STYLES = {
    "list": CardStyle("ID:", True, "N/A", 200),
    "card": CardStyle("Author ", False, "Paperback/N/A", 160),
}


# What is shown where a field is missing.
MISSING = "N/A"
NO_TITLE, NO_DETAIL_TITLE = "Unknown Title", "Book Details"
NO_NUMBER, NO_COUNT, NO_FLAG = "0.0", "0", "None"
NO_EDITION = "Standard"
NO_DESCRIPTION = "No description available for this book."
NO_SHELVES = "No popular shelves information."
SHOWN_SHELVES = 5


def author_names(authors: Column | str, prefix: str) -> Column:
    """``prefix`` + id, the role in parentheses, joined by commas; ``N/A`` for none."""
    known = F.filter(authors, lambda a: blank_to_null(a["author_id"]).isNotNull())
    names = F.transform(
        known,
        lambda a: F.concat(
            F.lit(prefix),
            a["author_id"],
            F.coalesce(F.concat(F.lit(" ("), blank_to_null(a["role"]), F.lit(")")), F.lit("")),
        ),
    )
    return falsy_coalesce(F.array_join(names, ", "), default=MISSING)


def shelf_labels(shelves: Column, counts: bool, prefix: str = "") -> Column:
    """Names of shelves, empties dropped, with their counts if asked for."""
    named = F.filter(shelves, lambda s: blank_to_null(s["name"]).isNotNull())

    def label(s: Column) -> Column:
        name = F.concat(F.lit(prefix), s["name"])
        if not counts:
            return name
        return F.concat(name, F.coalesce(F.concat(F.lit(" ("), blank_to_null(s["count"]), F.lit(")")), F.lit("")))

    return F.transform(named, label)


def _format(no_format: str) -> Column:
    is_ebook = F.lower("is_ebook") == "true"
    return F.coalesce(
        blank_to_null("format"), F.when(is_ebook, F.lit("Ebook")).otherwise(F.lit(no_format))
    )


def _or_na(name: str) -> Column:
    return falsy_coalesce(name, default=MISSING)


def result_cards(records: DataFrame, style: str = "list") -> DataFrame:
    """One display row per record in the given style."""
    look = STYLES[style]
    shelves = F.array_join(
        shelf_labels(F.slice("popular_shelves", 1, SHOWN_SHELVES), look.shelf_counts), ", "
    )
    extra = [c for c in ("position",) if c in records.columns]
    return records.select(
        *extra,
        F.coalesce("book_id", F.lit(MISSING)).alias("book_id"),
        falsy_coalesce("title", "title_without_series", default=NO_TITLE).alias("title"),
        best_identifier("isbn", "isbn13", "asin").alias("identifier"),
        author_names("authors", look.author_prefix).alias("authors"),
        F.coalesce("average_rating", F.lit(MISSING if style == "list" else NO_NUMBER)).alias("rating"),
        thousands(try_int(F.coalesce("ratings_count", F.lit(NO_COUNT)))).alias("ratings"),
        thousands(try_int(falsy_coalesce("text_reviews_count", default=NO_COUNT))).alias("reviews"),
        _or_na("language_code").alias("language"),
        _format(look.no_format).alias("format"),
        _or_na("publisher").alias("publisher"),
        _or_na("publication_year").alias("year"),
        falsy_coalesce(shelves, default=MISSING).alias("shelves"),
        falsy_coalesce("link", "url").alias("link"),
        blank_to_null(excerpt("description", look.excerpt_size)).alias("description"),
    )


def book_detail(records: DataFrame) -> DataFrame:
    """The detail view of each record."""
    as_is = lambda name, missing: F.coalesce(F.col(name), F.lit(missing))
    shelves = F.array_join(shelf_labels(F.col("popular_shelves"), True, "• "), "\n")
    return records.select(
        "book_id",
        falsy_coalesce("title", "title_without_series", default=NO_DETAIL_TITLE).alias("title"),
        as_is("average_rating", NO_NUMBER).alias("rating"),
        thousands(try_int(as_is("ratings_count", NO_COUNT))).alias("ratings"),
        thousands(try_int(as_is("text_reviews_count", NO_COUNT))).alias("reviews"),
        as_is("isbn", MISSING).alias("isbn"),
        as_is("isbn13", MISSING).alias("isbn13"),
        as_is("asin", MISSING).alias("asin"),
        _or_na("language_code").alias("language"),
        _or_na("publisher").alias("publisher"),
        pub_date_label(
            F.col("publication_year"), F.col("publication_month"), F.col("publication_day")
        ).alias("published"),
        _or_na("num_pages").alias("pages"),
        _or_na("format").alias("format"),
        as_is("is_ebook", NO_FLAG).alias("is_ebook"),
        _or_na("country_code").alias("country"),
        falsy_coalesce("edition_information", default=NO_EDITION).alias("edition"),
        falsy_coalesce("description", default=NO_DESCRIPTION).alias("description"),
        falsy_coalesce(shelves, default=NO_SHELVES).alias("shelves"),
        F.coalesce("similar_books", F.array().cast("array<string>")).alias("similar_books"),
    )

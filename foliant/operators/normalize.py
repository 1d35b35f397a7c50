"""Two record schemas -> one normalised record -> the typed catalog row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from foliant.functions.isbn import is_english_isbn
from foliant.functions.jsons import json_path
from foliant.functions.text import (
    blank_to_null, falsy_coalesce, nan_to_null, strip, try_float, try_int,
)
from foliant.schemas import (
    RECORD_FIELDS, RECORD_INTEGERS, RECORD_NESTED, RECORD_TEXT, REST_FIELDS, SHARED_FIELDS,
)


def surrogate_id(title: Column | str) -> Column:
    """Stable non-negative id of a title, for records that come without one: 60 bits of a digest."""
    return F.conv(F.substring(F.md5(title), 1, 15), 16, 10)


def genre_shelves(genres: Column | str) -> Column:
    return F.transform(genres, lambda g: F.struct(F.lit("1").alias("count"), g.alias("name")))


def whole_text(v: Column | str) -> Column:
    """Text of a whole-number field: the number 4.7 counts as 4, the text "4.7" stays."""
    text = json_path(v, "$", "string")
    whole = json_path(v, "$", "bigint").cast("string")
    return F.when(text.rlike(r"[.eE]"), F.coalesce(whole, text)).otherwise(text)


def scraped_values(prefix: str = "") -> dict[str, Column]:
    """Normalised fields of a scraped book whose fields are found behind ``prefix``.

    Fields the scraped schema has no source for are empty.
    """
    at = lambda name: F.col(prefix + name)
    title = F.coalesce(at("Title"), F.lit(""))
    count = lambda name: F.coalesce(at(name), F.lit(0)).cast("string")
    values = {
        "book_id": surrogate_id(title),
        "title": title,
        "title_without_series": title,
        "description": falsy_coalesce(at("Desc"), default=""),
        "isbn": falsy_coalesce(at("ISBN"), default=""),
        "average_rating": F.coalesce(F.nullif(at("Point"), F.lit(0.0)).cast("string"), F.lit("0.0")),
        "ratings_count": count("RatingsCount"),
        "text_reviews_count": count("ReviewsCount"),
        "language_code": falsy_coalesce(at("Language"), default=""),
        "is_ebook": F.lit("false"),
        "popular_shelves": genre_shelves(F.coalesce(at("Genre"), F.array().cast("array<string>"))),
        "num_pages": F.lit(None).cast("string"),
        "edition_information": F.lit(None).cast("string"),
    }
    blanks = {name: F.lit("") for name in RECORD_TEXT} | {
        name: F.array().cast(type_) for name, type_ in RECORD_NESTED.items()
    }
    return blanks | values


def normalize_books(raw: DataFrame) -> DataFrame:
    """``(plain, scraped, pos)`` -> the normalised record columns, ``pos`` kept.

    Records of the scraped schema are mapped field by field, others taken as they are.
    """
    mapped = scraped_values("scraped.")
    mapped["book_id"] = F.coalesce(blank_to_null("scraped.book_id"), mapped["book_id"])

    def field(name: str) -> Column:
        as_is = F.col(f"plain.{name}")
        if name in RECORD_INTEGERS:
            as_is = whole_text(as_is)
        return F.when(F.col("scraped").isNull(), as_is).otherwise(mapped[name]).alias(name)

    return raw.select(*[field(name) for name in RECORD_FIELDS], "pos")


def normalize_scraped(books: DataFrame) -> DataFrame:
    """Typed scraped books -> normalised record columns."""
    values = scraped_values()
    return books.select(*[values[name].alias(name) for name in RECORD_FIELDS])


def rating_value(c: Column | str) -> Column:
    """Missing or unparsable -> 0.0, NaN -> NULL."""
    return nan_to_null(F.coalesce(try_float(c), F.lit(0.0)))


def count_value(c: Column | str) -> Column:
    """Missing or unparsable -> 0."""
    return F.coalesce(try_int(c), F.lit(0).cast("bigint"))


def year_value(c: Column | str) -> Column:
    """Missing -> 0, unparsable -> NULL."""
    return F.when(blank_to_null(c).isNull(), F.lit(0).cast("bigint")).otherwise(try_int(c))


def flag_value(c: Column | str) -> Column:
    return F.coalesce(F.lower(c) == "true", F.lit(False))


def author_ids(authors: Column | str) -> Column:
    """Stripped ids; entries without an id are dropped."""
    known = F.filter(authors, lambda a: blank_to_null(a["author_id"]).isNotNull())
    return F.coalesce(
        F.transform(known, lambda a: strip(a["author_id"])), F.array().cast("array<string>")
    )


def shelf_names(shelves: Column | str) -> Column:
    """Stripped lower-case names; entries without a name are dropped."""
    named = F.filter(shelves, lambda s: blank_to_null(s["name"]).isNotNull())
    return F.coalesce(
        F.transform(named, lambda s: F.lower(strip(s["name"]))), F.array().cast("array<string>")
    )


def to_catalog(records: DataFrame, with_record: bool = True) -> DataFrame:
    """Normalised records -> typed catalog rows; other columns (``pos``) are kept.

    ``record`` carries those parts of the full record that the typed columns do not;
    a search that does not select it never reads its Parquet columns.
    """
    blank = lambda name: falsy_coalesce(name, default="").alias(name)
    extra = [c for c in records.columns if c not in RECORD_FIELDS]
    record = [F.struct(*REST_FIELDS).alias("record")] if with_record else []
    return records.select(
        "book_id",
        falsy_coalesce("title", "title_without_series", default="").alias("title"),
        blank("description"),
        blank("isbn"),
        blank("isbn13"),
        blank("asin"),
        rating_value("average_rating").alias("average_rating"),
        count_value("ratings_count").alias("ratings_count"),
        count_value("text_reviews_count").alias("text_reviews_count"),
        year_value("publication_year").alias("publication_year"),
        blank("publisher"),
        blank("language_code"),
        flag_value("is_ebook").alias("is_ebook"),
        author_ids("authors").alias("author_ids"),
        shelf_names("popular_shelves").alias("shelves"),
        *record,
        *extra,
    )


def record_columns() -> list[Column]:
    """The full normalised record of a catalog row, as columns.

    Shared text fields come back as the catalog has them: '' where there was no value.
    """
    return [
        F.col(name) if name in SHARED_FIELDS else F.col(f"record.{name}").alias(name)
        for name in RECORD_FIELDS
    ]


def has_book_id(book_id: Column | str = "book_id") -> Column:
    return blank_to_null(book_id).isNotNull()


def backfill_language(books: DataFrame) -> DataFrame:
    """A missing language becomes English where the ISBN says so."""
    missing = blank_to_null("Language").isNull()
    return books.withColumn(
        "Language", F.when(missing & is_english_isbn("ISBN"), F.lit("English")).otherwise(F.col("Language"))
    )

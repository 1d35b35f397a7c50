"""Record schemas shared by sources, operators and sinks."""

from __future__ import annotations

# A page's review, and the nested record extracted from a page ("scraped book").
REVIEW = (
    "struct<Author:string,AuthorUrl:string,Rating:int,Likes:bigint,"
    "Date:string,Spoiler:boolean,Text:string>"
)
SCRAPED_FIELDS = {
    "ISBN": "string",
    "Title": "string",
    "Desc": "string",
    "Genre": "array<string>",
    "Review": f"array<{REVIEW}>",
    "Point": "double",
    "Language": "string",
    "RatingsCount": "bigint",
    "ReviewsCount": "bigint",
    "CurrentlyReadingCount": "bigint",
    "WantToReadCount": "bigint",
}

# The normalised record: scalars are kept as text, coercion happens in the catalog.
RECORD_TEXT = [
    "book_id", "title", "title_without_series", "description", "isbn", "isbn13", "asin",
    "average_rating", "ratings_count", "text_reviews_count", "publication_year",
    "publication_month", "publication_day", "publisher", "language_code", "is_ebook",
    "format", "link", "url", "image_url", "country_code", "work_id",
    "num_pages", "edition_information",
]
RECORD_NESTED = {
    "authors": "array<struct<author_id:string,role:string>>",
    "popular_shelves": "array<struct<count:string,name:string>>",
    "similar_books": "array<string>",
    "series": "array<string>",
}
RECORD_FIELDS = [*RECORD_TEXT, *RECORD_NESTED]

# Fields holding whole numbers: a JSON number there loses its fraction.
RECORD_INTEGERS = {"ratings_count", "text_reviews_count", "publication_year"}

# What a raw record is read as. Whole numbers stay VARIANT until it is known whether
# they were numbers or texts. ``_misfit`` is set where a text did not fit the schema.
RAW_PLAIN = "struct<_misfit:string," + ",".join(
    [f"{name}:{'variant' if name in RECORD_INTEGERS else 'string'}" for name in RECORD_TEXT]
    + [f"{name}:{type_}" for name, type_ in RECORD_NESTED.items()]
) + ">"
RAW_SCRAPED = (
    "struct<book_id:string,ISBN:string,Title:string,Desc:string,Genre:array<string>,Point:double,"
    "Language:string,RatingsCount:bigint,ReviewsCount:bigint>"
)

# Record fields the catalog row carries under the same name; ``record`` holds the rest.
SHARED_FIELDS = [
    "book_id", "description", "isbn", "isbn13", "asin", "publisher", "language_code",
]
REST_FIELDS = [name for name in RECORD_FIELDS if name not in SHARED_FIELDS]

EDITION = "isbn_13 array<string>, isbn_10 array<string>, subjects array<string>, _corrupt_record string"

DISPOSITIONS = ["failed", "duplicate", "non_english"]


def ddl(fields: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {type_}" for name, type_ in fields.items())

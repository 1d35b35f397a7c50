"""Rules that sort crawled pages and stored books into dispositions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from foliant.functions.isbn import is_english_isbn
from foliant.functions.text import blank_to_null

# The marks of a refused, an empty and a successful request.
FORBIDDEN = "403 Forbidden"
DENIED_TITLE = "Access Denied"
EMPTY_SEARCH_TITLE = "showing 1-0 of 0 books"
EMPTY_SEARCH_TEXT = "No results"
BOOK_URL = "/book/show/"
ENGLISH = "English"

BLOCKED, FAILED, NON_ENGLISH, DUPLICATE, SAVED = "blocked", "failed", "non_english", "duplicate", "saved"


def _has(c: Column | str, part: str) -> Column:
    text = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.contains(text, F.lit(part)), F.lit(False))


def blocked_by_title(page_title: Column | str = "page_title") -> Column:
    title = F.coalesce(page_title, F.lit(""))
    return _has(title, FORBIDDEN) | (title == DENIED_TITLE)


def blocked_by_html(html: Column | str = "html") -> Column:
    return _has(html, FORBIDDEN)


def book_page_url(url: Column | str = "url") -> Column:
    return _has(url, BOOK_URL)


def not_found_page(page_title: Column | str = "page_title", html: Column | str = "html") -> Column:
    return _has(F.lower(page_title), EMPTY_SEARCH_TITLE) | _has(html, EMPTY_SEARCH_TEXT)


def page_status(pages: DataFrame) -> DataFrame:
    """Add ``page_status``: blocked, book, not_found or timeout; the first rule wins."""
    status = (
        F.when(blocked_by_title(), BLOCKED)
        .when(book_page_url(), "book")
        .when(not_found_page(), "not_found")
        .when(blocked_by_html(), BLOCKED)
        .otherwise("timeout")
    )
    return pages.withColumn("page_status", status)


def zero_data(point: Column | str = "Point", reviews: Column | str = "Review") -> Column:
    """Neither a rating nor a review."""
    no_point = F.coalesce(F.col(point) if isinstance(point, str) else point, F.lit(0.0)) == 0
    return no_point & (F.coalesce(F.size(reviews), F.lit(0)) <= 0)


def non_english_crawl(language: Column | str = "Language") -> Column:
    """Language known and not English; an unknown one passes."""
    return F.coalesce(blank_to_null(language) != ENGLISH, F.lit(False))


def non_english_reload(language: Column | str = "Language", isbn: Column | str = "ISBN") -> Column:
    """As at the crawl, but an unknown language is judged by the ISBN, if there is one."""
    unknown = blank_to_null(language).isNull()
    has_isbn = blank_to_null(isbn).isNotNull()
    return non_english_crawl(language) | (unknown & has_isbn & ~is_english_isbn(isbn))

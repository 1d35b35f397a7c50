"""ISBN predicates and extraction."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from foliant.functions.text import col, digits_only, falsy_coalesce, startswith_any, strip

# ISBN prefixes of the English-language registration groups.
ENGLISH_ISBN13 = ["9780", "9781", "9798"]
ENGLISH_ISBN10 = ["0", "1"]

# The two message forms a blocked page leaves in a crawl log.
BLOCKED_MESSAGE = r"Book '403 Forbidden' for ISBN (\d+)"
BLOCKED_MARK = "403 Forbidden"
BLOCKED_FALLBACK = r"ISBN:?\s*(\d+)"


def is_english_isbn(c: Column | str) -> Column:
    """13 digits or 10 digits with an English prefix; an 'X' check digit does not count."""
    digits = digits_only(c)
    return F.coalesce(
        ((F.length(digits) == 13) & startswith_any(digits, ENGLISH_ISBN13))
        | ((F.length(digits) == 10) & startswith_any(digits, ENGLISH_ISBN10)),
        F.lit(False),
    )


def preferred_isbn(isbn_13: Column | str, isbn_10: Column | str) -> Column:
    """First ISBN-13, else first ISBN-10, stripped; NULL if there is neither."""
    return strip(F.coalesce(F.get(col(isbn_13), F.lit(0)), F.get(col(isbn_10), F.lit(0))))


def best_identifier(isbn: Column | str, isbn13: Column | str, asin: Column | str) -> Column:
    return falsy_coalesce(isbn, isbn13, asin, default="N/A")


def blocked_isbn(line: Column | str) -> Column:
    """ISBN named by the usual block message, else NULL."""
    return F.nullif(F.regexp_extract(col(line), BLOCKED_MESSAGE, 1), F.lit(""))


def blocked_isbn_fallback(line: Column | str) -> Column:
    """ISBN named anywhere on a line that mentions the block, else NULL."""
    found = F.regexp_extract(col(line), BLOCKED_FALLBACK, 1)
    return F.when(F.contains(col(line), F.lit(BLOCKED_MARK)), F.nullif(found, F.lit("")))

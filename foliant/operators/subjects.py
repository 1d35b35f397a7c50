"""Subject rules that tell the editions of novels from all others."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from foliant.functions.text import contains_any

# Default terms, each matched as a substring of the lower-cased text.
INCLUDE_TERMS = [
    "fiction", "novel", "romance", "fantasy", "mystery", "thriller", "horror",
    "science fiction", "historical fiction", "young adult", "literary fiction",
]
EXCLUDE_TERMS = [
    "non-fiction", "nonfiction", "biography", "autobiography", "history", "textbook",
    "manual", "guide", "dictionary", "encyclopedia", "comic", "comics", "manga",
    "graphic novel", "poetry", "short stories", "essay", "academic",
]
PREFILTER_TERMS = [
    "fiction", "novel", "romance", "fantasy", "mystery", "thriller", "horror", "young adult",
]
PREFILTER_KEYS = [["isbn_13", "isbn_10"], ["subjects"]]

# Stands between subjects; no term can match across it.
SEPARATOR = "\x01"


def subjects_lower(subjects: Column | str) -> Column:
    """The subjects in lower case, one by one; ``subjects_text`` joins them for the term search."""
    return F.transform(subjects, F.lower)


def subjects_text(subjects: Column | str) -> Column:
    """All subjects as one lower-cased text, so that a term is searched once."""
    return F.array_join(subjects_lower(subjects), SEPARATOR)


def include_subjects(text: Column, terms: Iterable[str] = INCLUDE_TERMS) -> Column:
    return contains_any(text, terms)


def exclude_subjects(text: Column, terms: Iterable[str] = EXCLUDE_TERMS) -> Column:
    """True if the record survives, that is, no subject holds any of the terms."""
    return ~contains_any(text, terms)


def raw_prefilter(
    df: DataFrame,
    column: str = "json",
    keys: Iterable[Iterable[str]] = PREFILTER_KEYS,
    terms: Iterable[str] = PREFILTER_TERMS,
) -> DataFrame:
    """Drop texts that cannot qualify before they are parsed.

    One of each group of ``keys`` must occur as it is, one of ``terms`` in any case.
    """
    def may_qualify(text: Column) -> Column:
        found = F.lit(True)
        for group in keys:
            found = found & contains_any(text, group)
        return found & F.exists(F.array(F.lower(text)), lambda low: contains_any(low, terms))

    # The lambdas bind the text and its lower-cased form, so that each is computed
    # once instead of once per term.
    return df.where(F.exists(F.array(F.col(column)), may_qualify))

"""Bibliographic dump -> distinct ISBNs of novels."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from foliant.functions.isbn import preferred_isbn
from foliant.functions.jsons import one_json
from foliant.operators.subjects import (
    EXCLUDE_TERMS, INCLUDE_TERMS, PREFILTER_KEYS, PREFILTER_TERMS, exclude_subjects,
    include_subjects, raw_prefilter, subjects_text,
)
from foliant.schemas import EDITION


def parse_editions(
    editions: DataFrame,
    keys: Iterable[Iterable[str]] = PREFILTER_KEYS,
    terms: Iterable[str] = PREFILTER_TERMS,
) -> DataFrame:
    """``json`` -> the preferred ISBN and the subjects as one text.

    Only texts that pass the prefilter are parsed, and only three fields of those.
    ``malformed`` marks texts that are no JSON.
    """
    kept = raw_prefilter(editions, "json", keys, terms)
    options = {"columnNameOfCorruptRecord": "_corrupt_record", "allowSingleQuotes": "false"}
    parsed = kept.select(F.when(one_json("json"), F.from_json("json", EDITION, options)).alias("e"))
    return parsed.select(
        preferred_isbn("e.isbn_13", "e.isbn_10").alias("isbn"),
        subjects_text("e.subjects").alias("subjects"),
        (F.col("e").isNull() | F.col("e._corrupt_record").isNotNull()).alias("malformed"),
    )


def novel_isbns(
    editions: DataFrame,
    include: Iterable[str] = INCLUDE_TERMS,
    exclude: Iterable[str] = EXCLUDE_TERMS,
    keys: Iterable[Iterable[str]] = PREFILTER_KEYS,
    prefilter: Iterable[str] = PREFILTER_TERMS,
) -> DataFrame:
    """Distinct ISBNs of editions with an included and without an excluded subject.

    Editions that do not qualify are turned into NULL keys instead of being
    filtered out, and that one group is dropped after the aggregation: a filter
    would be pushed below the parsing projection and parse every text twice.
    """
    parsed = parse_editions(editions, keys, prefilter)
    subjects = F.col("subjects")
    wanted = include_subjects(subjects, include) & exclude_subjects(subjects, exclude)
    candidates = parsed.select(F.when(wanted, F.col("isbn")).alias("isbn"))
    groups = candidates.groupBy("isbn").agg(F.count("isbn").alias("editions"))
    return groups.where(F.col("editions") > 0).select("isbn")


def novel_counters(
    editions: DataFrame,
    include: Iterable[str] = INCLUDE_TERMS,
    exclude: Iterable[str] = EXCLUDE_TERMS,
    keys: Iterable[Iterable[str]] = PREFILTER_KEYS,
    prefilter: Iterable[str] = PREFILTER_TERMS,
) -> DataFrame:
    """Texts parsed, malformed, excluded, and distinct ISBNs kept."""
    parsed = parse_editions(editions, keys, prefilter)
    subjects = F.coalesce("subjects", F.lit(""))
    included, survives = include_subjects(subjects, include), exclude_subjects(subjects, exclude)
    return parsed.agg(
        F.count(F.lit(1)).alias("parsed"),
        F.count_if("malformed").alias("malformed"),
        F.count_if(~survives).alias("excluded"),
        F.count_distinct(F.when(included & survives, F.col("isbn"))).alias("isbns"),
    )

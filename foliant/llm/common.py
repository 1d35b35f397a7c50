"""Helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foliant.session import materialize, scratch

__all__ = ["DOCUMENT", "GAP", "let", "materialize", "scratch", "source_key", "table", "text_of", "words_of"]

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]

# What separates words: blank, tab to carriage return.
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def text_of(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def words_of(text: Column) -> Column:
    """Runs of anything but ``GAP``, in order."""
    return F.array_remove(F.split(text, GAP), "")


def source_key(c: str = "source") -> Column:
    """A hash that tells NULL from every text."""
    return F.xxhash64(F.col(c).isNull(), F.col(c))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, whatever ``body`` does with it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))

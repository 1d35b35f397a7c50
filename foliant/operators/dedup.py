"""Order-dependent deduplication.

A key may hold a large share of all rows, so no operator here gathers a key's rows
in one task: ``row_number() <= n`` is cut to n rows per key before the shuffle (the
plan shows a partial WindowGroupLimit), minima are partially aggregated, and rows
are flagged through a join whose many-row side adaptive execution can split (see
``pinned``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from foliant.functions.text import title_key
from foliant.operators.pinning import pinned


def keep_last_by_id(df: DataFrame, key: str | list[str] = "book_id", order: str | list[str] = "pos") -> DataFrame:
    """Last row per key in source order."""
    return _ranked(df, key, [F.desc(c) for c in _listed(order)], 1)


def keep_first(df: DataFrame, key: str | list[str], order: str | list[str]) -> DataFrame:
    return first_n(df, key, order, 1)


def first_n(df: DataFrame, key: str | list[str], order: str | list[str], n: int) -> DataFrame:
    """First ``n`` rows per key.

    Up to n = 1000 (``spark.sql.optimizer.windowGroupLimitThreshold``) rows are cut before
    the shuffle; with a larger n a key's rows meet in one task first.
    """
    return _ranked(df, key, [F.asc(c) for c in _listed(order)], n)


def flag_first(
    df: DataFrame, key: str, order: str | list[str], known: DataFrame | None = None, flag: str = "is_first"
) -> DataFrame:
    """Mark the first row per key; every row is kept.

    ``order`` must tell the rows of a key apart; several columns do so together. Keys
    listed in ``known`` (same column name) are taken already: none of their rows is
    first. Rows without a key are not deduplicated and get NULL.
    """
    columns = _listed(order)
    place = F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)
    firsts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(place).alias("_first"))
    if known is not None:
        firsts = firsts.join(known.select(key).distinct(), key, "left_anti")
    keyed = df.where(F.col(key).isNotNull()).join(pinned(firsts), key, "left")
    is_first = F.coalesce(F.col("_first") == place, F.lit(False))
    keyed = keyed.withColumn(flag, is_first).drop("_first").select(*df.columns, flag)
    unkeyed = df.where(F.col(key).isNull()).withColumn(flag, F.lit(None).cast("boolean"))
    return keyed.unionByName(unkeyed)


def keep_first_by_title(df: DataFrame, title: str, order: str) -> DataFrame:
    """Flag the first record per title key (``is_first``)."""
    return flag_first(df.withColumn("title_key", title_key(title)), "title_key", order)


def known_titles(df: DataFrame, known: DataFrame, title: str = "Title", keep_known: bool = True) -> DataFrame:
    """Rows whose title is (or, with ``keep_known=False``, is not) among ``known.title_key``."""
    keys = known.select("title_key").where(F.col("title_key").isNotNull()).distinct()
    keyed = df.withColumn("title_key", title_key(title))
    return keyed.join(pinned(keys), "title_key", "left_semi" if keep_known else "left_anti")


def distinct_first_isbn(isbns: DataFrame, order: str | None = None) -> DataFrame:
    """Distinct ISBNs; with ``order`` also the position of the first occurrence."""
    if order is None:
        return isbns.select("isbn").distinct()
    return isbns.groupBy("isbn").agg(F.min(order).alias(order))


def _listed(names: str | list[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _ranked(df: DataFrame, key: str | list[str], order: list[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*_listed(key)).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")

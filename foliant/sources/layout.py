"""One layout of the catalog that prunes on several columns.

Rows are ordered along a space-filling curve: the rank of a row in each column, in as many
steps as its bits tell apart, interleaved bit by bit. Rows near each other on the curve are near
in all columns, so every file and row group spans a small range of each, and the scan's
minimum and maximum statistics skip most of them for a range of any column, and still more
for ranges of several.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foliant.sources.writers import BLOOM_COLUMNS, replace_table

CURVE_COLUMNS = ["average_rating", "ratings_count", "publication_year"]
# Steps per column are two to this power.
BITS = 6


def rank_bounds(rows: DataFrame, columns: list[str], bits: int = BITS) -> dict[str, list[float]]:
    """Values that cut each column into about equal shares; ``2 ** bits - 1`` numbers per column reach the driver."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = rows.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(c) for c in columns]).head()
    return {c: sorted(found[c] or []) for c in columns}


def curve_place(bounds: dict[str, list[float]]) -> Column:
    """The place of a row on the curve. NULL ranks below all values, and among equal bounds no step is lost."""
    place = F.lit(0).cast("bigint")
    for i, (column, cuts) in enumerate(bounds.items()):
        limits = F.array(*[F.lit(float(x)) for x in cuts]) if cuts else F.array().cast("array<double>")
        value = F.col(column).cast("double")
        rank = F.size(F.filter(limits, _below(value))).cast("bigint")
        for bit in range(max(1, len(cuts).bit_length())):
            step = F.call_function("shiftright", rank, F.lit(bit)).bitwiseAND(F.lit(1).cast("bigint"))
            place = place.bitwiseOR(F.call_function("shiftleft", step, F.lit(bit * len(bounds) + i)))
    return place


def _below(value: Column):
    return lambda limit: limit < value


def cluster_catalog(
    spark: SparkSession, source: str, target: str, columns: list[str] | None = None, bits: int = BITS, files: int | None = None
) -> None:
    """Write the stored catalog at ``source`` to ``target`` (which may be the same) along the curve.

    Two narrow passes and one shuffle of the stored rows; ``files`` fixes the number of files.
    """
    columns = columns or CURVE_COLUMNS
    rows = spark.read.parquet(source)
    placed = rows.withColumn("_place", curve_place(rank_bounds(rows, columns, bits)))
    order = ["_place", "book_id"]
    spread = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in ["book_id", *BLOOM_COLUMNS]}
    replace_table(spread.sortWithinPartitions(*order).drop("_place"), target, blooms | {"parquet.bloom.filter.adaptive.enabled": "true"})

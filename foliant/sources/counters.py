"""Counts that are kept over appends: rows exactly, distinct keys by mergeable sketches or exactly.

Every append leaves a row of its own beside the store: how many rows it brought and a sketch of
their keys, both observed while the rows are written. Sketches merge without the rows they were made
of, so the distinct count of a store of any size is a merge of a few kilobytes per append.

A sketch estimates once it has seen more keys than it holds, at any precision. Where the
count has to be exact, ``exact`` keeps the keys themselves beside the counters: each append adds those
that are new, so they are distinct and counting them needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from foliant.session import materialize
from foliant.sources.writers import path_exists

# Relative standard error: 1.04 / sqrt(2 ** PRECISION), so 0.8 %.
PRECISION = 14
KEPT = "rows bigint, sketch binary"
KEY = "key string"


def append_counted(
    rows: DataFrame, path: str, counters: str, key: str, format: str = "json", precision: int = PRECISION, exact: bool = False, **options
) -> dict[str, int]:
    """Append ``rows`` to the store at ``path`` and their count and sketch of ``key`` to ``counters``, in one pass.

    NULL keys are rows but no keys. Returns rows and distinct keys of this append. With ``exact``, from the
    first append on, new keys are kept as well, in a second pass over the key of ``rows``. If a job
    fails between the writes, ``rebuild_counters`` makes them agree again.
    """
    seen = Observation("append")
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(F.col(key), precision).alias("sketch"))
    counted.write.mode("append").options(**options).format(format).save(path)
    found = seen.get
    spark = rows.sparkSession
    row = spark.createDataFrame([(found["rows"], found["sketch"])], KEPT)
    if exact:
        brought = materialize(_keys(rows, key), "brought-keys")
        kept = kept_keys(spark, counters)
        # The outcome is staged first: the folder that is read is also written.
        new = materialize(brought.join(kept, "key", "left_anti"), "new-keys")
        new.write.mode("append").parquet(_keys_path(counters))
    row.coalesce(1).write.mode("append").parquet(counters)
    if exact:
        return {"rows": found["rows"], "keys": brought.count()}
    return row.select("rows", F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias("keys")).head().asDict()


def kept_counts(spark: SparkSession, counters: str, exact: bool = False) -> DataFrame:
    """``appends``, ``rows`` and ``keys`` (distinct, estimated unless ``exact``) of the whole store, which is not read."""
    kept = spark.read.parquet(counters) if path_exists(spark, counters) else spark.createDataFrame([], KEPT)
    counts = [F.count(F.lit(1)).alias("appends"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")]
    if exact:
        return kept.agg(*counts).crossJoin(kept_keys(spark, counters).agg(F.count("key").alias("keys")))
    return kept.agg(*counts, F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch", True)), F.lit(0)).alias("keys"))


def kept_keys(spark: SparkSession, counters: str) -> DataFrame:
    """The distinct keys of all appends made with ``exact``, as texts."""
    path = _keys_path(counters)
    return spark.read.schema(KEY).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], KEY)


def _keys_path(counters: str) -> str:
    return f"{counters.rstrip('/')}-keys"


def _keys(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.col(key).cast("string").alias("key")).where(F.col("key").isNotNull()).distinct()


def rebuild_counters(stored: DataFrame, counters: str, key: str, precision: int = PRECISION, exact: bool = False) -> None:
    """One row for all that is stored, in place of those of its appends."""
    whole = stored.agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(F.col(key), precision).alias("sketch"))
    if exact:
        _keys(stored, key).write.mode("overwrite").parquet(_keys_path(counters))
    whole.coalesce(1).write.mode("overwrite").parquet(counters)

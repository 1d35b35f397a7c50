"""Mixing sources to target weights by systematic sampling.

A document's size is its number of words. Sources, by code point and NULL last, weigh
5, 2, 1, repeating; they share 150 % of all words by weight, and no source gets more than
twice its own words: what is above goes to the others by weight until none is above.

Within a source all documents expect the same number of copies, target over size of the
source. The running sum of expected copies, plus one random offset per source, gives a
document one copy for each whole number it passes. Documents are taken by size, so the
words of a source come within about one long document of its target.

The running sum needs each document's place among those of its source. Rows are dealt
out by ranges of (source, size, doc_id, ...), so a large source spreads over many tasks;
a place is the place within the task plus the source's rows in the tasks before.

Defined results: NULL and empty texts have size 0 and take 0 words; a NULL source is a
source, the last one; rows that agree in everything are places of their own; a NULL
doc_id comes first among its size; an empty table gives an empty result; other columns
are ignored by ``mix_plan`` and kept by ``mix``. Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from foliant.llm.common import materialize, text_of, words_of

WEIGHTS = (5, 2, 1)
SHARE, CEILING = 1.5, 2.0


def _offset(key: Column) -> Column:
    """A number from 0 to 1 that looks random, the same in every run."""
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sized: DataFrame, share: float = SHARE, ceiling: float = CEILING) -> DataFrame:
    """``source``, ``source_size``, ``target`` and ``_offset``; one row per source.

    With room = ceiling x size over weight, sources stay below their ceiling from the
    first one on, in that order, at which the level no longer passes the room.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everywhere = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.get(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHTS))))
    rows = sizes.select("*", weight.cast("double").alias("_weight"))
    rows = rows.select("*", (F.col("source_size") * F.lit(ceiling)).alias("_most"))
    rows = rows.select("*", (F.col("_most") / F.col("_weight")).alias("_room"), F.sum("source_size").over(everywhere).alias("_all"))
    order = Window.orderBy("_room", F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.select("*", F.coalesce(F.sum("_most").over(before), F.lit(0.0)).alias("_full"), F.sum("_weight").over(after).alias("_open"))
    level = (F.col("_all") * F.lit(share) - F.col("_full")) / F.col("_open")
    rows = rows.select("*", level.alias("_level"), F.row_number().over(order).alias("_nth"))
    fits = F.when(F.col("_level") <= F.col("_room"), F.struct("_nth", "_level"))
    rows = rows.select("*", F.min(fits).over(everywhere)["_level"].alias("_final"))
    target = F.least(F.col("_most"), F.col("_final") * F.col("_weight"))
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))
    return rows.select("source", "source_size", target.alias("target"), _offset(key).alias("_offset"))


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` (source, size, doc_id, ``_tie``, ``_id``) with ``_place``, from 1 within the source."""
    order = [F.col("source").asc_nulls_last(), "size", F.col("doc_id").asc_nulls_first(), "_tie", "_id"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.withColumn("_at", F.monotonically_increasing_id())
    dealt = materialize(dealt.withColumn("_part", F.shiftright("_at", 33)), "places")
    parts = dealt.groupBy("source", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    parts = parts.select(F.col("source").alias("_s"), F.col("_part").alias("_p"), "_first", "_before")
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p"))
    return dealt.join(parts, same).withColumn("_place", F.col("_at") - F.col("_first") + F.col("_before") + 1)


def _taken(rows: DataFrame) -> DataFrame:
    """``rows`` with source_size, target and ``_copies``."""
    targets = materialize(source_targets(rows), "source-targets").withColumnRenamed("source", "_name")
    placed = _placed(rows).join(targets, F.col("source").eqNullSafe(F.col("_name")))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    upto = lambda place: F.floor(expected * place + F.col("_offset"))
    return placed.withColumn("_copies", upto(F.col("_place")) - upto(F.col("_place") - 1))


def _sizes(docs: DataFrame) -> list[Column]:
    return [
        F.col("source"), F.size(words_of(text_of())).cast("bigint").alias("size"), F.col("doc_id"),
        F.xxhash64("text").alias("_tie"), F.monotonically_increasing_id().alias("_id"),
    ]


def mix_plan(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target (its source's), taken."""
    rows = _taken(materialize(docs.select(*_sizes(docs)), "sizes"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("_copies") * F.col("size")).cast("bigint").alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mix: every document as often as it is taken, with its own columns."""
    numbered = materialize(docs.select(*_sizes(docs), F.struct(*docs.columns).alias("_row")), "numbered")
    copies = _taken(numbered.drop("_row")).where("_copies > 0").select(F.col("_id").alias("_of"), F.col("_copies").cast("int").alias("_copies"))
    taken = numbered.select("_id", "_row").join(copies, F.col("_id") == F.col("_of"))
    return taken.select("_row", F.explode(F.sequence(F.lit(1), "_copies"))).select("_row.*")


SQL = f"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [{WEIGHTS[0]}.0, {WEIGHTS[1]}.0, {WEIGHTS[2]}.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1]::DOUBLE AS weight
  FROM sized GROUP BY source),
rooms AS (SELECT *, source_size * {CEILING}::DOUBLE AS most, source_size * {CEILING}::DOUBLE / weight AS room FROM sources),
levels AS (
  SELECT *, row_number() OVER o AS nth,
    (sum(source_size) OVER () * {SHARE}::DOUBLE - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM rooms WINDOW o AS (ORDER BY room, source NULLS LAST)),
targets AS (
  SELECT source, source_size, least(most, (SELECT first(level ORDER BY nth) FROM levels WHERE level <= room) * weight) AS target,
    ('0x' || substr(md5(coalesce('=' || source, '-')), 1, 13))::BIGINT::DOUBLE / {float(1 << 52)}::DOUBLE AS u
  FROM levels),
placed AS (
  SELECT doc_id, size, t.source_size, t.target, u, row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id NULLS FIRST) AS place,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS e
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, ((floor(e * place + u) - floor(e * (place - 1) + u)) * size)::BIGINT AS taken FROM placed
"""

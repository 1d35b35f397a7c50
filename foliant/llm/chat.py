"""Chat formatting: logged snapshots of growing conversations collapse to the longest ones.

Every turn gets the hash of all turns up to and with it, a running sum of hashes of
(place, role, text), so one sort per conversation gives all of its prefixes. A conversation is a
snapshot if its hash is that of a proper prefix of a longer one; an anti-join against the
distinct prefixes keeps the others. Conversations with the same turns are logged
copies: the smallest conv_id stays. Only what is kept is rendered.

Rendered turns are ``<|im_start|>role``, line feed, text, ``<|im_end|>``, line feed; a marker's
beginning ``<|`` within a role or text becomes ``< |``.

Defined results: turns are ordered by turn (NULL last), then role and text (NULL first), and
repeated rows are turns of their own; a NULL role or text is rendered as the empty text but
differs from it; a row without conv_id is a conversation of its own, of one turn, and such rows
that agree collapse; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from foliant.llm.common import materialize

LOW = (1 << 40) - 1


def _piece(seed: int) -> Column:
    """Forty bits of a turn's hash: sums of eight million of them stay in range."""
    parts = [F.col("_pos"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    return F.xxhash64(F.lit(seed), *parts).bitwiseAND(F.lit(LOW))


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` with their place, prefix hashes and whether they are the last; a written table."""
    order = [F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]
    named = turns.where("conv_id IS NOT NULL").select("conv_id", "turn", "role", "text")
    of = Window.partitionBy("conv_id").orderBy(*order)
    placed = named.withColumn("_pos", F.row_number().over(of).cast("bigint"))
    # Places are unique, so the running sums need no frame of equal rows.
    upto = Window.partitionBy("conv_id").orderBy("_pos")
    rows = placed.select(
        "conv_id", "role", "text", "_pos",
        F.sum(_piece(1)).over(upto).alias("_a"), F.sum(_piece(2)).over(upto).alias("_b"),
        F.lead("_pos").over(upto).isNull().alias("_last"),
    )
    single = turns.where("conv_id IS NULL").select("conv_id", "role", "text", F.lit(1).cast("bigint").alias("_pos"))
    single = single.select("*", _piece(1).alias("_a"), _piece(2).alias("_b"), F.lit(True).alias("_last"))
    return materialize(rows.unionByName(single), "turn-prefixes")


def maximal(rows: DataFrame) -> DataFrame:
    """conv_id, ``_pos`` (the number of turns), hashes and copies of the conversations that prefix no other."""
    key = ["_pos", "_a", "_b"]
    shorter = rows.where(~F.col("_last")).select(*key).distinct()
    whole = rows.where("_last").groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    return whole.join(shorter, key, "left_anti")


def _turn() -> Column:
    safe = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|im_start|>"), safe("role"), F.lit("\n"), safe("text"), F.lit("<|im_end|>\n"))


def chat(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, copies and text of every conversation that is kept."""
    rows = prefixes(turns)
    kept = materialize(maximal(rows), "maximal-conversations")
    named = kept.where("conv_id IS NOT NULL").select(F.col("conv_id").alias("_id"), F.col("_pos").alias("n_turns"), "copies")
    told = rows.where("conv_id IS NOT NULL").join(named, F.col("conv_id") == F.col("_id"))
    told = told.groupBy("conv_id", "n_turns", "copies").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_pos", _turn().alias("t")))), lambda x: x["t"]), "").alias("text")
    )
    loose = kept.where("conv_id IS NULL").select(F.col("_a").alias("_x"), F.col("_b").alias("_y"), F.col("_pos").alias("n_turns"), "copies")
    single = rows.where("conv_id IS NULL").dropDuplicates(["_a", "_b"])
    single = single.join(loose, (F.col("_a") == F.col("_x")) & (F.col("_b") == F.col("_y")))
    return told.unionByName(single.select("conv_id", "n_turns", "copies", _turn().alias("text")))


_SAFE = "replace(coalesce({0}, ''), '<|', '< |')"
SQL = f"""
WITH placed AS (
  SELECT coalesce(conv_id::VARCHAR, 'row' || row_number() OVER ()) AS c, conv_id, turn, role, text,
    coalesce('=' || length(role) || ':' || role, '-') || coalesce('=' || length(text) || ':' || text, '-') AS raw,
    '<|im_start|>' || {_SAFE.format('role')} || chr(10) || {_SAFE.format('text')} || '<|im_end|>' || chr(10) AS told
  FROM conversations),
numbered AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) AS pos FROM placed),
prefixed AS (
  SELECT c, conv_id, pos, string_agg(raw, '|') OVER w AS pre, string_agg(told, '') OVER w AS text,
    lead(pos) OVER (PARTITION BY c ORDER BY pos) IS NULL AS last
  FROM numbered WINDOW w AS (PARTITION BY c ORDER BY pos)),
whole AS (SELECT pos, pre, min(conv_id) AS conv_id, count(*) AS copies, first(text) AS text FROM prefixed WHERE last GROUP BY pos, pre)
SELECT conv_id, pos AS n_turns, copies, text FROM whole
WHERE NOT EXISTS (SELECT 1 FROM prefixed p WHERE NOT p.last AND p.pos = whole.pos AND p.pre = whole.pre)
"""

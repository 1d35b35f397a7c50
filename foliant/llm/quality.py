"""Quality rules: lines that many documents of a host share, and repetition within a text.

DataFrame functions only. A document's host is its ``source``.

``line_counts``: for every host and normalised line (lower case, trimmed) the number of distinct documents that hold it. Documents whose
normalised lines are all the same are copies and count once, so that a group of copies
does not turn its own lines into boilerplate: copies are left to the deduplication.
Documents that differ in any line are distinct. A line is over the limit if more than ``min_docs`` documents
and more than ``share`` of its host's rows hold it. Such lines are removed; a document
is depleted if at least ``depleted`` of its words go with them. ``quality`` judges, and
``keep_good`` also returns the texts without these lines. What is left keeps its order
and its characters. The base rules and the word counts are those of the whole text.

Defined results: a NULL text has no words and fails the base rules; a NULL source is a
host of its own; repeated rows get one verdict each; further columns are ignored by
``quality`` and kept as they are by ``keep_good`` (but for ``n_chars``, which follows the text); empty tables give empty results. Texts are taken
whole, whatever their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from foliant.llm.common import let, materialize, source_key, text_of, words_of
from foliant.operators.pinning import pinned

WINDOW = 8
MIN_DOCS, SHARE, DEPLETED = 20, 0.005, 0.8


def _window_hashes(words: Column) -> Column:
    """One hash per window of eight words: of pairs, then of pairs of pairs, then of those.

    ``zip_with`` fills the shorter side with NULL, so the last seven are cut off.
    """

    def pairs(hashes: Column, step: int) -> Column:
        return F.zip_with(hashes, F.slice(hashes, step + 1, F.size(hashes)), lambda x, y: F.xxhash64(x, y))

    one = F.transform(words, lambda w: F.xxhash64(w))
    all_ = let(one, lambda a: let(pairs(a, 1), lambda b: let(pairs(b, 2), lambda c: pairs(c, 4))))
    return F.slice(all_, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))


def base_rules(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    Each step is a projection of its own, because the next one uses its result
    more than once.
    """
    long = lambda c: c.cast("bigint")
    lines = F.filter(F.split(F.col("_text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    steps = docs.select("*", text_of().alias("_text")).select("*", words_of(F.col("_text")).alias("_w"), lines.alias("_l"))
    steps = steps.select(
        "*",
        long(F.size("_w")).alias("n_words"),
        long(F.length(F.array_join("_w", ""))).alias("word_chars"),
        long(F.regexp_count("_text", F.lit(r"[#*$%&|<>]"))).alias("n_symbols"),
        long(F.size("_l") - F.size(F.array_distinct("_l"))).alias("n_dup_lines"),
        _window_hashes(F.col("_w")).alias("_h"),
    ).drop("_w", "_l", "_text")
    steps = steps.select("*", (F.size(F.array_distinct("_h")) < F.size("_h")).alias("_again"))
    return _with_verdict(steps.select("*", F.when(F.col("_again"), _covered(F.col("_h"))).alias("_c")).drop("_h", "_again"))


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more.

    Windows are sorted as one number each, the upper bits of the hash before the place;
    neighbours in that order are then compared by their whole hashes.
    """
    bits = F.when(F.size(hashes) < 1 << 24, F.lit(24)).otherwise(F.lit(31))

    def repeated(width: Column) -> Column:
        high = lambda h: F.call_function("shiftright", h, width)
        place = lambda v: (v - F.call_function("shiftleft", high(v), width)).cast("int")
        packed = F.transform(hashes, lambda h, i: F.call_function("shiftleft", high(h), width).bitwiseOR(i.cast("bigint")))
        same = lambda v, w: F.coalesce((high(v) == high(w)) & (F.get(hashes, place(v)) == F.get(hashes, place(w))), F.lit(False))
        return let(
            F.sort_array(packed),
            lambda s: F.transform(F.filter(s, lambda v, k: same(v, F.get(s, k - 1)) | same(v, F.get(s, k + 1))), place),
        )

    gaps = let(
        F.sort_array(let(bits, repeated)),
        lambda p: F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
    )
    return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _with_verdict(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("n_repeat_words", F.coalesce("_c", F.lit(0).cast("bigint"))).drop("_c")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def _content() -> list[Column]:
    """Two independent hashes of source and text: rows that agree in both get the same verdict."""
    parts = [F.col("source").isNull(), F.col("source"), F.col("text").isNull(), F.col("text")]
    return [F.xxhash64(*parts).alias("_k1"), F.xxhash64(F.lit(1), *reversed(parts)).alias("_k2")]


def line_facts(docs: DataFrame) -> DataFrame:
    """One row per text, as a written table: content hashes, host, and the hash and words of each line.

    A line is lower-cased and trimmed; its words are counted by the blanks between them.
    A line without words is NULL, which keeps the places of the others.
    """
    n_words = lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1
    trimmed = F.transform(F.split(F.lower(text_of()), "\n"), lambda x: F.btrim(x, F.lit(" \t\r\x0b\x0c")))
    lines = F.transform(trimmed, lambda x: F.when(x != "", F.struct(n_words(x).alias("n"), F.xxhash64(x).alias("line"))))
    return materialize(docs.select(*_content(), source_key().alias("_host"), lines.alias("_lines")), "line-facts")


def _exploded(facts: DataFrame) -> DataFrame:
    rows = facts.select(
        "_k1", "_k2", "_host", F.xxhash64("_lines").alias("_doc"),
        F.aggregate("_lines", F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x["n"], F.lit(0))).alias("_total"),
        F.posexplode("_lines").alias("_pos", "_x"),
    ).where("_x IS NOT NULL")
    return rows.select("_k1", "_k2", "_host", "_doc", "_total", "_pos", F.col("_x.line").alias("_line"), F.col("_x.n").alias("_n"))


def line_counts(facts: DataFrame) -> DataFrame:
    """(host, line, number of distinct documents). Counted partially before each shuffle."""
    return _exploded(facts).groupBy("_host", "_line").agg(F.count_distinct("_doc").alias("_docs"))


def frequent_lines(facts: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """The (host, line) over the limit, as a written table."""
    hosts = facts.groupBy("_host").agg(F.count(F.lit(1)).alias("_rows"))
    counts = line_counts(facts).where(F.col("_docs") > min_docs)
    over = counts.join(hosts, "_host").where(F.col("_docs") > share * F.col("_rows"))
    return materialize(over.select("_host", "_line"), "frequent-lines")


def lost_lines(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, depleted: float = DEPLETED) -> DataFrame:
    """Content hashes of the texts with lines over the limit, the places of these lines and ``_gone``, as a written table.

    Being tables with known sizes, both sides are broadcast if they are small and
    joined by a shuffle, with hot keys split, if they are not.
    """
    facts = line_facts(docs)
    lost = _exploded(facts).join(frequent_lines(facts, min_docs, share), ["_host", "_line"])
    once = lost.groupBy("_k1", "_k2", "_pos").agg(F.first("_n").alias("_n"), F.first("_total").alias("_total"))
    texts = once.groupBy("_k1", "_k2").agg(F.collect_list("_pos").alias("_places"), F.sum("_n").alias("_lost"), F.first("_total").alias("_total"))
    return materialize(texts.select("_k1", "_k2", "_places", (F.col("_lost") >= depleted * F.col("_total")).alias("_gone")), "lost-lines")


def without_lines(text: Column, places: Column) -> Column:
    """``text`` without the lines at ``places``; as it is where these are NULL."""
    rest = lambda lines: F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places), lambda i: F.get(lines, i))
    return F.when(places.isNull(), text).otherwise(F.array_join(let(F.split(text, "\n"), rest), "\n"))


def judged(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` with the base columns, ``kept`` and ``_places``, those of its lines over the limit."""
    lost = lost_lines(docs, **limits)
    rows = base_rules(docs.select("*", *_content()))
    rows = rows.join(lost, ["_k1", "_k2"], "left")
    return rows.withColumn("kept", ~F.col("base_failed") & ~F.coalesce("_gone", F.lit(False))).drop("_k1", "_k2", "_gone")


RESULT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def quality(docs: DataFrame, **limits) -> DataFrame:
    """The verdict on every row of ``docs``."""
    return judged(docs.select("doc_id", "text", "source"), **limits).select(*RESULT)


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns; ``text`` is without the lines over the limit.

    ``docs`` may have columns named as the verdict's: they are set aside in a struct. The
    verdicts are pinned, or the condition would be unfolded into the rules and run them anew.
    """
    packed = docs.select("text", "source", F.struct(*docs.columns).alias("_row"))
    kept = pinned(judged(packed, **limits).select("_row", "_places", "kept")).where("kept")
    clean = without_lines(F.col("_row.text"), F.col("_places"))
    own = lambda name: F.col("_row").getField(name)
    # A stated length follows the text.
    changed = {"text": clean, "n_chars": F.when(F.col("_places").isNull(), own("n_chars")).otherwise(F.length(clean))}
    return kept.select(*(changed.get(name, own(name)).cast(docs.schema[name].dataType).alias(name) for name in docs.columns))


SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS l
  FROM documents),
windows AS (
  SELECT r, i, list_slice(w, i, i + {WINDOW - 1}) AS x FROM docs, unnest(range(1, len(w) - {WINDOW - 2})) AS t(i)),
twice AS (SELECT *, count(*) OVER (PARTITION BY r, x) AS n FROM windows),
repeats AS (
  SELECT r, sum(least({WINDOW}, coalesce(next - i, {WINDOW})))::BIGINT AS n FROM (
    SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next FROM twice WHERE n > 1) GROUP BY r),
base AS (
  SELECT docs.r, doc_id, source, text, len(w)::BIGINT AS n_words, coalesce(list_sum([length(x) FOR x IN w]), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words
  FROM docs LEFT JOIN repeats ON docs.r = repeats.r),
lines AS (
  SELECT r, source, x, length(x) - length(replace(x, ' ', '')) + 1 AS n, doc FROM (
    SELECT r, source, unnest(y) AS x, array_to_string(y, chr(10)) AS doc FROM (
      SELECT r, source, [z FOR z IN [trim(v, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) FOR v IN string_split(lower(text), chr(10))] IF z <> ''] AS y FROM docs))),
frequent AS (
  SELECT source, x FROM (SELECT l.source, l.x, count(DISTINCT doc) AS docs FROM lines l GROUP BY ALL)
  JOIN (SELECT source AS s, count(*) AS total FROM docs GROUP BY source) ON source IS NOT DISTINCT FROM s
  WHERE docs > {MIN_DOCS} AND docs > {SHARE} * total),
gone AS (
  SELECT r FROM lines l LEFT JOIN frequent f ON l.source IS NOT DISTINCT FROM f.source AND l.x = f.x
  GROUP BY r HAVING sum(CASE WHEN f.x IS NOT NULL THEN n ELSE 0 END) >= {DEPLETED} * sum(n))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND gone.r IS NULL AS kept
FROM base LEFT JOIN gone ON base.r = gone.r
"""

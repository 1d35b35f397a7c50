"""Licence scan with a positional index of rare words. DataFrame functions only.

Every template (a licence notice, or one of the base phrases) has mandatory key phrases. A first
pass counts in how many documents each licence word occurs; the word of a phrase with
the highest inverse document frequency becomes its entry in the index, with its place
relative to the template. A second pass looks these words up in each file, turns their
places into starts of templates, keeps the starts on which all phrases of a template agree, and
verifies the phrases word by word. Any place of a phrase holds its rarest word at the
relative position, so the choice of words bears on cost alone and no place is missed.
All of it happens within a row; nothing but the word counts is shuffled.

The score is the largest share of a template's words that stand at their relative place
(1 for the base phrases), 0 without a template.

Defined results: a NULL or empty text has no words, empty labels and score 0; repeated
rows are scanned each; a NULL doc_id stays NULL; further columns are ignored; an empty
table gives an empty result. Texts are scanned whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Base phrases and their labels.
BASE = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]
# Opening words of public licence notices: label, words, mandatory phrases.
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
     ["permission is hereby granted free of charge", "obtaining a copy of this software"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
     ["redistribution and use in source and binary forms", "with or without modification"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("lgpl", "gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl", "gnu affero general public license", ["gnu affero general public license"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", ["mozilla public license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ["permission to use copy modify", "with or without fee"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
    ("cc-by-nc", "licensed under cc by nc", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa", ["cc by sa"]),
    ("cc0", "cc0 1 0 universal", ["cc0 1 0 universal"]),
    ("all-rights-reserved", "all rights reserved", ["all rights reserved"]),
]

GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Phrase:
    place: int
    words: tuple[str, ...]


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    phrases: tuple[Phrase, ...]
    base: bool = False


def template(label: str, text: str, phrases: list[str], base: bool = False) -> Template:
    words = tuple(text.split())
    found = []
    for phrase in phrases:
        part = tuple(phrase.split())
        place = next(i for i in range(len(words)) if words[i : i + len(part)] == part)
        found.append(Phrase(place, part))
    return Template(label, words, tuple(found), base)


TEMPLATES = [template(label, text, [text], True) for label, text in BASE] + [template(*x) for x in NOTICES]


def license_words(text: Column) -> Column:
    """Words with A-Z lower-cased. The two other characters whose small form is ASCII are kept out of it."""
    kept = F.replace(F.replace(text, F.lit("\u0130"), F.lit("\u0131")), F.lit("\u212a"), F.lit("\u0131"))
    return F.array_remove(F.split(F.lower(kept), GAP), "")


def word_counts(docs: DataFrame, templates: list[Template]) -> dict[str, int]:
    """Documents per licence word; as many numbers as the templates have key words."""
    known = sorted({w for t in templates for p in t.phrases for w in p.words})
    counts = docs.select(F.explode(F.array_intersect("_words", F.array(*map(F.lit, known)))).alias("word")).groupBy("word").count()
    return {w: 0 for w in known} | {r["word"]: r["count"] for r in counts.collect()}


def _starts(t: Template, counts: dict[str, int]) -> Column:
    """Starts of ``t`` in ``_words``, ascending."""
    words = F.col("_words")

    def candidates(p: Phrase) -> Column:
        rare = min(range(len(p.words)), key=lambda i: (counts[p.words[i]], -len(p.words[i]), i))
        at = F.transform(words, lambda w, i: F.when(w == p.words[rare], i - (p.place + rare)))
        return F.array_distinct(F.filter(at, lambda i: i.isNotNull()))

    def stands(p: Phrase, start: Column) -> Column:
        same = F.lit(True)
        for i, w in enumerate(p.words):
            same = same & F.coalesce(F.get(words, start + (p.place + i)) == w, F.lit(False))
        return same

    found = candidates(t.phrases[0])
    for p in t.phrases[1:]:
        found = F.array_intersect(found, candidates(p))
    # The rarest word first: most files stop there.
    needed = [F.array_contains(words, w) for w in sorted({w for p in t.phrases for w in p.words}, key=lambda w: (counts[w], w))]
    exact = F.filter(found, lambda s: _all([stands(p, s) for p in t.phrases]))
    return F.when(_all(needed), exact).otherwise(F.array().cast("array<int>"))


def _all(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def _share(t: Template, starts: Column) -> Column:
    """The largest share of the template's words in place, over ``starts``."""
    n = len(t.words)
    if t.base or all(len(p.words) == n for p in t.phrases):
        return F.when(F.size(starts) > 0, F.lit(1.0)).otherwise(F.lit(0.0))

    def hits(s: Column) -> Column:
        total = F.lit(0)
        for i, w in enumerate(t.words):
            total = total + F.when(F.get(F.col("_words"), s + i) == w, 1).otherwise(0)
        return total

    return F.coalesce(F.array_max(F.transform(starts, hits)) / F.lit(float(n)), F.lit(0.0))


def scan(docs: DataFrame, templates: list[Template] | None = None) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and its places."""
    templates = TEMPLATES if templates is None else templates
    split = docs.select("doc_id", license_words(F.coalesce("text", F.lit(""))).alias("_words"))
    counts = word_counts(split, templates)
    base = [i for i, t in enumerate(templates) if t.base]
    rows = split.select("*", *[_starts(t, counts).alias(f"_t{i}") for i, t in enumerate(templates)])
    label = lambda i: F.when(F.size(f"_t{i}") > 0, F.lit(templates[i].label))
    joined = lambda at: F.array_join(F.sort_array(F.array_distinct(F.array_compact(F.array(*map(label, at))))), ",")
    places = F.concat(*[F.col(f"_t{i}") for i in base])

    def spans(i: int) -> Column:
        name, size = F.lit(templates[i].label), F.lit(len(templates[i].words))
        return F.transform(f"_t{i}", lambda s: F.struct(name.alias("label"), s.cast("bigint").alias("start"), size.alias("length")))

    long = lambda c: c.cast("bigint")
    return rows.select(
        "doc_id",
        long(F.size("_words")).alias("n_words"),
        long(F.size(places)).alias("n_base"),
        long(F.array_min(places)).alias("first_word"),
        long(F.array_max(places)).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(range(len(templates))).alias("labels"),
        F.greatest(*[_share(t, F.col(f"_t{i}")) for i, t in enumerate(templates)]).alias("score"),
        F.concat(*map(spans, range(len(templates)))).alias("places"),
    )


COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def license_scan(docs: DataFrame) -> DataFrame:
    return scan(docs).select(*COLUMNS)


def _sql() -> str:
    """The same by plain comparison at every place of every text."""
    quoted = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"

    def places(t: Template) -> str:
        tests = " AND ".join(
            f"list_slice(w, s + {p.place} + 1, s + {p.place + len(p.words)}) = {quoted(p.words)}" for p in t.phrases
        )
        # A phrase may stand nearer to the beginning than its place in the template.
        least = -max(p.place for p in t.phrases)
        inside = " AND ".join(f"s + {p.place} >= 0" for p in t.phrases)
        known = quoted(sorted({w for p in t.phrases for w in p.words}))
        return f"CASE WHEN list_has_all(w, {known}) THEN [s FOR s IN range({least}, len(w)) IF {inside} AND {tests}] ELSE [] END"

    def share(i: int, t: Template) -> str:
        if t.base or all(len(p.words) == len(t.words) for p in t.phrases):
            return f"CASE WHEN len(t{i}) > 0 THEN 1.0::DOUBLE ELSE 0 END"
        hits = " + ".join(f"CASE WHEN s + {j} >= 0 AND w[s + {j} + 1] = '{x}' THEN 1 ELSE 0 END" for j, x in enumerate(t.words))
        return f"coalesce(list_max([{hits} FOR s IN t{i}]) / {len(t.words)}::DOUBLE, 0)"

    base = [i for i, t in enumerate(TEMPLATES) if t.base]
    labels = lambda at: "coalesce(array_to_string(list_sort(list_distinct([x FOR x IN [" + ", ".join(
        f"CASE WHEN len(t{i}) > 0 THEN '{TEMPLATES[i].label}' END" for i in at) + "] IF x IS NOT NULL])), ','), '')"
    both = " || ".join(f"t{i}" for i in base)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{letters}', '{letters.lower()}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
  FROM documents),
found AS (SELECT doc_id, w, {", ".join(f"{places(t)} AS t{i}" for i, t in enumerate(TEMPLATES))} FROM words)
SELECT doc_id, len(w)::BIGINT AS n_words, len({both})::BIGINT AS n_base, list_min({both})::BIGINT AS first_word,
  list_max({both})::BIGINT AS last_word, {labels(base)} AS base_labels, {labels(range(len(TEMPLATES)))} AS labels,
  greatest({", ".join(share(i, t) for i, t in enumerate(TEMPLATES))}) AS score
FROM found"""


SQL = _sql()

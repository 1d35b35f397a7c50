"""Licence scan against a plain search."""

import re

from foliant.llm.licenses import TEMPLATES, scan

WORD = re.compile(r"[0-9a-z\x80-\U0010FFFF]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(text):
    words = WORD.findall(lower(text))
    base, labels, score = [], {}, 0.0
    for t in TEMPLATES:
        for s in range(-max(p.place for p in t.phrases), len(words)):
            if all(s + p.place >= 0 and tuple(words[s + p.place : s + p.place + len(p.words)]) == p.words for p in t.phrases):
                labels[t.label] = labels.get(t.label, False) or t.base
                hits = sum(0 <= s + i < len(words) and words[s + i] == w for i, w in enumerate(t.words))
                score = max(score, 1.0 if t.base else hits / len(t.words))
                if t.base:
                    base.append((s, t.label))
    starts = [s for s, _ in base]
    return (len(words), len(base), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), score)


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
TEXTS = [
    "Licensed under the Apache License, Version 2.0.", "Released under the MIT License. MIT-license! mit licenses", "cc by cc BY-NC 4.0",
    "gnu gnu general public license, version 3 gnu general\npublic licensé", MIT, "x " + MIT.upper(), MIT.replace("any person", "some body"),
    MIT.replace("to any person", "to"), "", None, "…", "general public license", "All rights reserved.", "KEEP Keep İ MİT License",
    "mit license " * 3000, "redistribution and use in source and binary forms, with or without modification", "apache_license", "cc\x00by", "by cc",
]


def test_scan(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "MIT license", None), (0, TEXTS[0], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = scan(df).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for doc_id, text, _ in rows:
        r = by_id[doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == brute(text)[:6], text
        assert abs(r.score - brute(text)[6]) < 1e-12
    assert {(p.label, p.start, p.length) for p in by_id[4].places} == {("mit", 0, 20)}
    assert scan(df.limit(0)).count() == 0

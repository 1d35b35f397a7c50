"""Ranked search against brute force."""

import math
import random
import re

import pytest

from foliant.llm.lexical import TERM, bag_classes, restricted, search, terms

SCHEMA = "doc_id long, text string, item_id string, score string"
ITEM = "item_id long, text string, doc_id string"


def split(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda x: x.group().lower(), text or ""))


@pytest.mark.parametrize("text", ["", "Ab-aB_ab 12x\x7f\x00ÄÖ é b", "KK İ Ω z y", "a" * 100_000, "~~~", None])
def test_terms(text):
    assert [t.decode() for t in terms(text.encode() if text else None) if t] == split(text)


def brute(docs, items, k=10):
    bags = [(d, split(t)) for d, t in docs]
    n, total = sum(1 for _, b in bags if b), sum(len(b) for _, b in bags)
    out = []
    for item, text in items:
        words = set(split(text))
        df = {w: sum(w in b for _, b in bags) for w in words}
        found = []
        for d, b in bags:
            if not b:
                continue
            m = 10 + (90 * len(b) * n) // total
            score = 0
            for w in words & set(b):
                tf = b.count(w)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Über", "naïve", "X9"]
    text = lambda n: rng.choice([" ", "-", ", "]).join(rng.choices(words, [3 / (i + 1) for i in range(len(words))], k=n))
    docs = [(i, text(rng.randint(1, 40))) for i in range(200)]
    docs += [(i, docs[3][1]) for i in range(300, 360)] + [(i, docs[5][1].upper() + " unseen") for i in range(400, 450)]
    docs += [(500, None), (501, ""), (502, "..."), (None, docs[3][1]), (None, "w1 w2"), (7, docs[7][1]), (7, docs[7][1])]
    items = [(i, text(8)) for i in range(12)] + [(3, text(5)), (50, None), (51, ""), (52, "nowhere"), (53, "w1 w1 w1")]
    return docs, items


@pytest.mark.parametrize("seed, block, items_block", [(1, 1 << 19, 4096), (2, 7, 4096), (3, 1 << 19, 5)])
def test_search(spark, seed, block, items_block):
    docs, items = made(seed)
    got = search(
        spark.createDataFrame([(d, t, "x", "y") for d, t in docs], SCHEMA).repartition(5),
        spark.createDataFrame([(i, t, "x") for i, t in items], ITEM), block=block, items_block=items_block,
    )
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items)


def test_copies_are_one_class(spark):
    docs = [(i, "alpha beta other") for i in range(500)] + [(i, "Beta, ALPHA! thing") for i in range(500, 900)]
    frame = spark.createDataFrame([(d, t, "", "") for d, t in docs], SCHEMA).repartition(6)
    classes, n = bag_classes(restricted(frame, [b"alpha", b"beta"]))
    assert n == 900
    assert [(r["size"], r["members"]) for r in classes.collect()] == [(900, list(range(10)))]


def test_empty(spark):
    docs, items = spark.createDataFrame([(1, "a", "", "")], SCHEMA), spark.createDataFrame([(1, "a", "")], ITEM)
    assert [tuple(r)[:3] for r in search(docs, items).collect()] == [(1, 1, 1)]
    assert search(docs.limit(0), items).collect() == []
    assert search(docs, items.limit(0)).collect() == []
    assert search(docs.where("false").unionByName(spark.createDataFrame([(1, None, "", "")], SCHEMA)), items).collect() == []

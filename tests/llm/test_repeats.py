"""Repeated passages against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from foliant.llm.repeats import Parse, _reach, common, repeated_starts, repeats_digest, triggers, without_repeats

SCHEMA = "doc_id long, text string, k1 string, spans int"


def brute(docs, length):
    texts = [(t or "").encode() for _, t in docs]
    times = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(docs, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if times[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(12))
def test_every_start_belongs_to_one_end(seed):
    rng = np.random.default_rng(seed)
    length = int(rng.choice([40, 64, 200]))
    letters = rng.integers(97, 97 + int(rng.choice([1, 2, 26])), 20_000).astype(np.uint8)
    cuts = np.unique(np.concatenate([[0, 20_000], rng.integers(0, 20_000, 30)]))
    cuts = np.sort(np.append(cuts, cuts[3]))
    p = Parse(letters, cuts, length)
    held = Counter()
    for at, low, high, owner in zip(p.at, p.low, p.high, p.owner):
        assert 0 <= low <= high <= _reach(length)
        assert cuts[owner] <= at - high and at - low + length <= cuts[owner + 1]
        held.update(range(at - high, at - low + 1))
    want = {i for a, b in zip(cuts, cuts[1:]) for i in range(a, b - length + 1)}
    assert set(held) == want and set(held.values()) <= {1}


@pytest.mark.parametrize("seed", range(6))
def test_equal_strings_are_cut_alike(seed):
    rng = np.random.default_rng(seed)
    length = 64
    passage = rng.integers(97, 97 + [2, 4, 26][seed % 3], length).astype(np.uint8)
    found = set()
    for _ in range(20):
        a, b = rng.integers(97, 123, rng.integers(0, 300)), rng.integers(97, 123, rng.integers(0, 300))
        data = np.concatenate([a, passage, b]).astype(np.uint8)
        p = Parse(data, np.array([0, len(data)]), length)
        mine = [int(at - len(a)) for at, low, high in zip(p.at, p.low, p.high) if at - high <= len(a) <= at - low]
        found.add(tuple(mine))
    assert len(found) == 1


def test_triggers_in_chunks():
    data = np.random.default_rng(1).integers(97, 99, 5000).astype(np.uint8)
    for whole, part in zip(triggers(data, 40), triggers(data, 40, 64)):
        assert (whole == part).all() and len(whole) > 50
    assert [len(x) for x in triggers(data[:47], 40)] == [0, 0]
    assert [len(x) for x in triggers(data[:48], 40)] == [1, 1]


def test_common():
    for a, b, n in ((b"", b"x", 0), (b"ab", b"abc", 2), (b"abc", b"abd", 2), (b"\0\0", b"\0\1", 1), (b"\xff", b"\xff", 1)):
        assert common(a, b) == common(b, a) == n


@pytest.mark.parametrize("seed", range(30))
def test_starts_of_a_group(seed):
    rng, length = random.Random(seed), 20
    letters = "ab"[: 1 + seed % 2] + "c"
    group = []
    for i in range(rng.randint(1, 25)):
        low, high = sorted((rng.randint(0, 12), rng.randint(0, 12)))
        phrase = "".join(rng.choices(letters, [9, 1] if len(letters) == 2 else [9, 9, 1], k=high)).encode()
        follow = ("xyzw" + "".join(rng.choices(letters, [9, 1] if len(letters) == 2 else [9, 9, 1], k=16 - low))).encode()
        group.append({"tid": i, "place": 100, "low": low, "high": high, "n": rng.choice([1, 1, 2]), "phrase": phrase, "follow": follow})
    strings = lambda c: {a: c["phrase"][:a][::-1] + c["follow"][: length - a] for a in range(c["low"], c["high"] + 1)}
    distinct = {(c["low"], c["phrase"], c["follow"]): c for c in group}
    group = list(distinct.values())
    times = Counter((a, s) for c in group for a, s in strings(c).items())
    want = {(c["tid"], 100 - a) for c in group if c["n"] == 1 for a, s in strings(c).items() if times[a, s] > 1}
    got = {(t, i) for t, a, b in repeated_starts(group, length) for i in range(a, b + 1)}
    assert got == want


def corpus(seed, length):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeéñ", k=rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    base = [text(rng.randint(0, 120)) for _ in range(40)]
    shared = [text(length // 3) for _ in range(4)]
    docs = []
    for t in base:
        at = rng.randint(0, len(t))
        docs.append(t[:at] + rng.choice([*shared, "", ""]) + t[at:])
    for t in base[:15]:
        at = rng.randint(0, len(t))
        docs += [t[:at] + rng.choice("xyz") + t[at:], t[rng.randint(0, 20) :], t]
    docs += ["a" * 700, "b" + "a" * (length + 3), "ab" * 200, "ba" * 150 + "c", shared[0] * 3, shared[1][: length - 1], "a" * length]
    docs += [s[3:] + t for s, t in zip(shared, ["", "q", "qq", "r"])]
    rows = [(i, t) for i, t in enumerate(docs)]
    return rows + [(3, docs[3]), (None, docs[0]), (None, None), (700, None), (701, ""), (702, "ñ" * (length // 2))]


@pytest.mark.parametrize("seed, length, parts, group", [(1, 40, 5, 20_000), (2, 40, 1, 2), (3, 64, 7, 20_000), (4, 200, 3, 3), (5, 100, 4, 0)])
def test_digest(spark, seed, length, parts, group):
    docs = corpus(seed, length)
    df = spark.createDataFrame([(d, t, "x", 0) for d, t in docs], SCHEMA).repartition(parts)
    got = sorted((tuple(r) for r in repeats_digest(df, length, group).collect()), key=str)
    assert got == brute(docs, length)


@pytest.mark.parametrize("group", [20_000, 10])
def test_many_different_followers_of_one_passage(spark, group):
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    passage = noise(260)
    docs = [(i, noise(rng.randint(0, 90)) + passage[rng.randint(0, 3) :] + noise(rng.randint(0, 90))) for i in range(300)]
    df = spark.createDataFrame([(d, t, "x", 0) for d, t in docs], SCHEMA).repartition(6)
    assert sorted((tuple(r) for r in repeats_digest(df, group=group).collect()), key=str) == brute(docs, 200)


def test_texts_and_columns(spark):
    shared = "".join(random.Random(4).choices("abcdefgh ", k=250))
    docs = [(1, "one " + shared + " two"), (2, shared + "three"), (3, shared * 1), (4, "short"), (5, shared), (6, None)]
    df = spark.createDataFrame([(d, t, "mine", 7) for d, t in docs], SCHEMA)
    got = {r["doc_id"]: r for r in without_repeats(df).collect()}
    assert df.columns[:3] == list(got[1].asDict())[:3] and got[1]["k1"] == "mine"
    assert bytes(got[1]["kept"]) == b"one  two" and [tuple(s) for s in got[1]["spans"]] == [(4, 254)]
    assert bytes(got[2]["kept"]) == b"three" and bytes(got[4]["kept"]) == b"short"
    assert bytes(got[3]["kept"]) == b"" == bytes(got[6]["kept"]) and [tuple(s) for s in got[5]["spans"]] == [(0, 250)]


def test_empty_and_invalid(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert repeats_digest(df).collect() == [] and without_repeats(df).collect() == []
    with pytest.raises(ValueError):
        repeats_digest(df, 35)

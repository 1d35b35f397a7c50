"""Mixing against a plain computation."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest

from foliant.llm.mixing import mix, mix_plan

ROWS = [(i, "w " * (i * 7 % 50), f"s{i % 4}" if i % 9 else None, "x") for i in range(1, 400)]
ROWS += [(None, None, "s0", None), (5, "w w", "s1", "x"), (5, "w w", "s1", "x"), (6, "", None, "x")] + [(900 + i, "many words here", "hot", "x") for i in range(300)]


def brute(rows):
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    size = Counter()
    for r in rows:
        size[r[2]] += len((r[1] or "").split())
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    target, open_, left = {}, list(sources), 1.5 * sum(size.values())
    while True:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * size[s]]
        if not over:
            break
        for s in over:
            target[s] = 2.0 * size[s]
            left -= 2 * size[s]
            open_.remove(s)
    target |= {s: level * weight[s] for s in open_}
    out = []
    for s in sources:
        own = sorted((len((r[1] or "").split()), r[0] is not None, r[0] or 0) for r in rows if r[2] == s)
        u = int(hashlib.md5(("-" if s is None else "=" + s).encode()).hexdigest()[:13], 16) / (1 << 52)
        e = target[s] / size[s] if size[s] else 0.0
        for i, (n, has, doc_id) in enumerate(own, 1):
            copies = math.floor(e * i + u) - math.floor(e * (i - 1) + u)
            out.append((doc_id if has else None, n, size[s], pytest.approx(target[s]), copies * n))
    return out, target


def key(r):
    return (r[0] is not None, r[0] or 0, r[1], r[2], r[4])


def test_plan(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string, size string").repartition(5)
    got = [tuple(r) for r in mix_plan(df).collect()]
    want, target = brute(ROWS)
    assert sorted(got, key=key) == sorted(want, key=key)
    taken = defaultdict(int)
    for doc_id, size, source_size, t, n in got:
        assert n <= 2 * size
        taken[source_size, t] += n
    for (_, t), n in taken.items():
        assert abs(n - t) <= 100
    assert sorted(map(tuple, mix_plan(df.repartition(2)).collect()), key=key) == sorted(got, key=key)


def test_mix_keeps_rows_and_columns(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string, size string")
    copies = mix(df)
    assert copies.columns == df.columns
    words = Counter()
    for r in copies.collect():
        words[r.doc_id] += len((r.text or "").split())
    plan = Counter()
    for r in mix_plan(df).collect():
        plan[r.doc_id] += r.taken
    assert +words == +plan


def test_few(spark):
    schema = "doc_id long, text string, source string"
    assert mix_plan(spark.createDataFrame([], schema)).count() == 0
    assert mix(spark.createDataFrame([], schema)).count() == 0
    empty = mix_plan(spark.createDataFrame([(1, None, None)], schema)).collect()
    assert [tuple(r) for r in empty] == [(1, 0, 0, 0.0, 0)]

"""SimHash: fingerprints, trie join and components against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.llm.simhash import Trie, components, fingerprint, keep_one, links, simhash_components, trie_links


def brute_components(values, budget):
    root = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if (int(values[i]) ^ int(values[j])).bit_count() <= budget:
                a, b = root[i], root[j]
                if a != b:
                    root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def clustered(n, seed, flips=3):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, n // 4, dtype=np.uint64) * np.uint64(2)
    out = []
    for c in centres:
        for _ in range(4):
            x = int(c)
            for b in rng.integers(0, 64, rng.integers(0, flips + 3)):
                x ^= 1 << int(b)
            out.append(x)
    return np.unique(np.array([*out, 0, 2**64 - 1], np.uint64))


@pytest.mark.parametrize("budget", [0, 1, 4, 7])
def test_trie_join_is_exact(budget):
    values = clustered(400, budget)
    assert trie_links(values, budget, chunk=50).tolist() == brute_components(values, budget)


def test_trie_join_across_two_subtrees():
    values = clustered(400, 9)
    cut = int(np.searchsorted(values, np.uint64(1 << 63)))
    root = trie_links(values, 4, across=cut)
    want = list(range(len(values)))
    for i in range(cut):
        for j in range(cut, len(values)):
            if (int(values[i]) ^ int(values[j])).bit_count() <= 4:
                a, b = want[i], want[j]
                want = [min(a, b) if r in (a, b) else r for r in want]
    assert root.tolist() == want


def test_trie_of_few():
    assert Trie(np.array([], np.uint64), 64).root == -1
    assert trie_links(np.array([5], np.uint64), 4).tolist() == [0]
    assert trie_links(np.array([0, 2**64 - 1], np.uint64), 64).tolist() == [0, 0]


def test_fingerprint_by_hand():
    import xxhash

    assert fingerprint(None) == fingerprint("") == fingerprint(" \n\t") == 0
    assert fingerprint("A b\tC") == xxhash.xxh64_intdigest("a b c".encode(), 42)
    words = "Ä b c d e É".lower().replace("ä", "Ä").replace("é", "É").split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(3)]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) > 1.5)
    assert fingerprint("Ä B c  D\x0be É") == want


def texts(spark):
    base = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (5, base, "x"), (3, base.upper(), "x"), (9, base, "y"), (9, base, "y"), (None, base, None),
        (7, None, "x"), (8, "", "x"), (2, " \n", None), (11, "quite another text with its own words in it", "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, _print string")


def test_components_of_documents(spark):
    got = {(r.doc_id, r.component_id) for r in simhash_components(texts(spark)).collect()}
    assert got == {(5, 3), (3, 3), (9, 3), (None, 3), (7, 2), (8, 2), (2, 2), (11, 11)}
    assert simhash_components(texts(spark)).count() == 9
    kept = keep_one(texts(spark))
    assert kept.columns == ["doc_id", "text", "_print"]
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 11]


def test_components_without_ids_and_empty(spark):
    none = spark.createDataFrame([(None, "a"), (None, "a")], "doc_id long, text string")
    assert [r.component_id for r in simhash_components(none).collect()] == [None, None]
    assert keep_one(none).count() == 1
    assert simhash_components(none.limit(0)).count() == 0


@pytest.mark.parametrize("group", [30, 100_000])
def test_dealt_out_links(spark, group):
    values = clustered(300, 4)
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "_print long")
    found = {r.node: r.root for r in components(links(df, 4, group)).collect()}
    want = brute_components(values, 4)
    groups, ours = {}, {}
    for v, w in zip(values.view(np.int64).tolist(), want):
        groups.setdefault(w, set()).add(v)
        ours.setdefault(found.get(v, v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, ours.values()))


def test_components_of_a_long_chain(spark):
    chain = spark.range(1, 200).select(F.col("id").alias("u"), (F.col("id") - 1).alias("v"))
    assert {r.root for r in components(chain).collect()} == {0}

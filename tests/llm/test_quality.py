"""Quality rules against a plain computation."""

import random
from collections import Counter, defaultdict

from foliant.llm.quality import RESULT, keep_good, quality


def split(text):
    return [w for w in "".join(" " if c in " \t\n\r\x0b\x0c" else c for c in text or "").split(" ") if w]


def base(text):
    words = split(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if split(x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed)


def brute(rows, min_docs, share, limit):
    norm = {i: [x for x in (y.strip(" \t\r\x0b\x0c") for y in (t or "").lower().split("\n")) if x] for i, (_, t, _) in enumerate(rows)}
    n = lambda x: x.count(" ") + 1
    docs, size = defaultdict(set), Counter(s for _, _, s in rows)
    for i, lines in norm.items():
        for x in lines:
            docs[rows[i][2], x].add(tuple(lines))
    out = []
    for i, (doc_id, text, source) in enumerate(rows):
        lost = sum(n(x) for x in norm[i] if len(docs[source, x]) > min_docs and len(docs[source, x]) > share * size[source])
        all_ = sum(map(n, norm[i]))
        b = base(text)
        out.append((doc_id, *b, not b[-1] and not (lost and lost >= limit * all_)))
    return out


def rows():
    rng = random.Random(4)
    word = lambda: rng.choice("ab cd ef gh ij kl mn op qr st".split()) + str(rng.randint(0, 40))
    common = " ".join(word() for _ in range(14))
    out = []
    for i in range(120):
        lines = [" ".join(word() for _ in range(rng.choice([16, 18, 20, 23]))) + f" end{i}" for _ in range(rng.randint(0, 3))]
        if i % 2:
            lines.insert(rng.randint(0, len(lines)), common.upper() if i % 4 == 1 else "  " + common)
        if i % 7 == 0:
            lines += lines[:1] * 2
        out.append((i, "\n".join(lines), f"h{i % 2}" if i % 5 else None))
    out += [(300 + i, f"{common}\n{common.upper()} \nu{i} v w", "h1") for i in range(4)]
    again = "one two three four five six seven eight nine"
    out += [(200, None, "h0"), (201, "", None), (202, "\n \t\n", "h1"), (203, f"{again} x {again} y {again}", "h0"), (203, f"{again} x {again} y {again}", "h0"),
            (None, "a b c d e f g h i " * 3, "h0"), (205, "tick " * 5000, "h1"), (206, "é#\x85x " * 30, "h1"), (207, " ".join(f"w{k}" for k in range(3000)), "h0")]
    return out


def test_verdicts(spark):
    data = rows()
    df = spark.createDataFrame([(*r, 1) for r in data], "doc_id long, text string, source string, kept int").repartition(5)
    got = quality(df, min_docs=5, share=0.02)
    assert got.columns == RESULT
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(brute(data, 5, 0.02, 0.8), key=key)
    kept = keep_good(df, min_docs=5, share=0.02)
    assert kept.columns == df.columns
    want = Counter(r[0] for r in brute(data, 5, 0.02, 0.8) if r[-1])
    assert Counter(r.doc_id for r in kept.collect()) == want
    assert any(not r[-1] and not r[-2] for r in brute(data, 5, 0.02, 0.8))


def test_copies_are_not_boilerplate_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(i, text, "s") for i in range(100)], "doc_id long, text string, source string")
    assert quality(df).where("kept").count() == 100
    assert quality(df.limit(0)).count() == 0


def test_long_shared_passages_count_plain_documents(spark):
    """The shared passage is the longest line of every document that holds it; copies still count once."""
    passage, other = (" ".join(f"{c}{i}" for i in range(60)) for c in "pq")
    rows = [(i, f"{passage}\nown line {i}\nby the way", "s") for i in range(40)]
    rows += [(100 + i, f"{other}\nthe same end", "s") for i in range(40)]
    rows += [(200 + i, f"{passage if i % 2 else other}\n" + " ".join(f"v{i}x{k}" for k in range(70)), "s") for i in range(6)]
    rows += [(300 + i, f"{passage}\nown line {i}", None) for i in range(5)]
    norm = {i: [x.strip() for x in t.split("\n")] for i, t, _ in rows}
    n = lambda x: x.count(" ") + 1
    docs = defaultdict(set)
    for i, _, s in rows:
        for x in norm[i]:
            docs[s, x].add(tuple(norm[i]))
    lost = {i: sum(n(x) for x in norm[i] if len(docs[s, x]) > 20) for i, _, s in rows}
    want = {i for i, _, _ in rows if lost[i] < 0.8 * sum(map(n, norm[i]))}
    assert want == {i for i, _, _ in rows if i >= 100}
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    assert {r.doc_id for r in quality(df).where("kept").collect()} == want


def test_kept_texts_lose_frequent_lines(spark):
    """Copies, blank lines and line ends around the removed lines stay as they are."""
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(40))
    rows = [(i, f"\n{own(i)}\r\n  Sign UP now \n\t\n\nEnd {i}\n", "s", i) for i in range(30)]
    rows += [(100, f"sign up now\n{own(100)}\nSign up NOW", "s", 1), (101, f"{own(101)}\nSign up now", "t", 2), (102, f"\n\n{own(102)}\r\n", "s", 3)]
    rows += [rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(3)
    got = keep_good(df)
    assert got.columns == df.columns
    clean = lambda t: t.replace("  Sign UP now \n", "")
    want = Counter((i, clean(t), s, n if clean(t) == t else len(clean(t))) for i, t, s, n in rows if i not in (100,))
    want[100, own(100), "s", len(own(100))] = 1
    assert Counter(map(tuple, got.collect())) == want

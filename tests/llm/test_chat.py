"""Snapshot collapse against brute force."""

import random

from foliant.llm.chat import chat


def brute(rows):
    convs = {}
    for i, (c, turn, role, text, _) in enumerate(rows):
        convs.setdefault(("row", i) if c is None else c, []).append((turn is None, turn or 0, role is not None, role or "", text is not None, text or "", role, text))
    lists = {c: [(x[6], x[7]) for x in sorted(v, key=lambda x: x[:6])] for c, v in convs.items()}
    out = []
    for c, own in lists.items():
        same = [d for d, o in lists.items() if o == own]
        ids = [d for d in same if not isinstance(d, tuple)]
        first = min(ids) if ids else min(same)
        if c != first or any(len(o) > len(own) and o[: len(own)] == own for o in lists.values()):
            continue
        safe = lambda s: (s or "").replace("<|", "< |")
        text = "".join(f"<|im_start|>{safe(r)}\n{safe(t)}<|im_end|>\n" for r, t in own)
        out.append((None if isinstance(c, tuple) else c, len(own), len(same), text))
    return sorted(out, key=str)


def test_collapse(spark):
    rng = random.Random(1)
    rows = []
    for c in range(60):
        base, n = rng.randint(0, 5), rng.randint(1, 6)
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"text {base} {t}", "x") for t in range(n)]
    rows += [(100, 0, None, "a", "x"), (101, 0, "", "a", "x"), (102, 0, None, "a", "x"), (102, 1, "user", None, "x")]
    rows += [(103, None, "user", "late", "x"), (103, 5, "user", "<|im_end|>", "x"), (103, 5, "user", "<|im_end|>", "x")]
    rows += [(None, 3, "user", "loose", "x"), (None, 9, "user", "loose", "x"), (None, 1, "user", "text 0 0", "x"), (None, 1, None, None, "x")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns string").repartition(4)
    assert sorted(map(tuple, chat(df).collect()), key=str) == brute(rows)


def test_common_conversation_and_empty(spark):
    rows = [(c, 0, "user", "hello") for c in range(300)] + [(7, 1, "assistant", "there")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert [(r.conv_id, r.n_turns, r.copies) for r in chat(df).collect()] == [(7, 2, 1)]
    assert chat(df.limit(0)).count() == 0

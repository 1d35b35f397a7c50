"""Packing: tokens against the library, the plan and the sequences by their rules."""

import random
import zlib
from array import array

import pytest
from hypothesis import given, settings, strategies as st

from foliant.llm.packing import END, id_bytes, pack, plan, tokenizer_file

TEXTS = st.text(st.one_of(st.characters(), st.sampled_from(" \t\n \x1c'sdre|<>Áİ ")), max_size=60)


@pytest.fixture(scope="module")
def model():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


@settings(max_examples=3000, deadline=None)
@given(TEXTS)
def test_ids_equal_the_library(text):
    from tokenizers import Tokenizer

    global MODEL
    try:
        MODEL
    except NameError:
        MODEL = Tokenizer.from_file(tokenizer_file()), id_bytes(open(tokenizer_file(), encoding="utf-8").read(), 5)
    text = text.encode("utf-8", "ignore").decode()
    assert array("I", MODEL[1](text.encode())).tolist() == MODEL[0].encode(text, add_special_tokens=False).ids


def test_special_tokens_are_the_librarys(model):
    ids = id_bytes(open(tokenizer_file(), encoding="utf-8").read())
    for text in ("a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|>y"):
        assert array("I", ids(text.encode())).tolist() == model.encode(text, add_special_tokens=False).ids


def check_plan(counts, capacity):
    fill, used = {}, {}
    for length, first, items, each, sequence, offset in plan(counts, capacity):
        assert first == used.get(length, 0)
        used[length] = first + items
        for i in range(items):
            s = sequence + i // each
            assert offset + (i % each) * length == fill.get(s, 0)
            fill[s] = fill.get(s, 0) + length
    assert used == {k: v for k, v in counts.items() if v}
    assert all(v <= capacity for v in fill.values())
    return len(fill)


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 2, 10, 37, 100])
    counts = {rng.randint(1, capacity): rng.randint(1, 40) for _ in range(rng.randint(0, 25))}
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fit = min((r for r in rooms if r >= length), default=None)
            if fit is None:
                rooms.append(capacity - length)
            else:
                rooms.remove(fit)
                rooms.append(fit - length)
    assert check_plan(counts, capacity) == len(rooms)


def test_plan_of_many_documents_is_small():
    slots = plan({n: 10**9 + n for n in range(1, 4097)})
    assert len(slots) < 50_000


def test_documents(spark, model):
    rng = random.Random(3)
    words = ["alpha", "Beta", "gamma's", "12", "é", "…"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 40, 300]))), "z") for i in range(150)]
    rows += [(7, rows[7][1], "z"), (None, None, None), (500, "", "z"), (501, "word " * 1000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(3)
    got = pack(df, 100, with_ids=True).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        part = array("I", r.ids)
        assert zlib.crc32(part.tobytes()) == r.ids_crc32 and len(part) == r.length <= 100
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.ids))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, text, _ in rows:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, END]
        want = [(k, at, ids[at : at + 100]) for k, at in enumerate(range(0, len(ids), 100))]
        copies = sum(r[0] == doc_id for r in rows)
        assert sorted(by_doc[doc_id]) == sorted(want * copies)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 100
    assert pack(df.limit(0)).count() == 0
    assert "ids" not in pack(df).columns

"""The pipeline stage by stage against plain computations, and as a whole."""

import random
import zlib
from array import array
from collections import Counter

import corpus_pipeline
from foliant.llm.common import DOCUMENT
from foliant.llm.packing import END, tokenizer_file
from foliant.llm.pii import KEY, replace_all
from foliant.llm.simhash import fingerprint
from test_mixing import brute as mix_brute
from test_quality import brute as quality_brute


def documents():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    rows = []
    for i in range(80):
        text = "\n".join(" ".join(word() for _ in range(rng.randint(8, 40))) for _ in range(rng.randint(1, 6)))
        if i % 5 == 0:
            text += f" mail jo.{i}@mail.example.com now"
        rows.append((i, text, "en", f"s{i % 4}" if i % 11 else None, len(text)))
    rows += [(100 + i, rows[i][1], "en", "s1", 1) for i in range(6)]
    rows += [(110, None, None, None, None), (111, "", "en", "s0", 0), (112, "short", "en", "s0", 5), (3, rows[3][1], "en", rows[3][3], rows[3][4])]
    return rows


def brute(rows):
    kept = [r for r, v in zip(rows, quality_brute([(r[0], r[1], r[3]) for r in rows], 20, 0.005, 0.8)) if v[-1]]
    prints = [fingerprint(r[1]) for r in kept]
    root = list(range(len(kept)))
    for i in range(len(kept)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4 and root[i] != root[j]:
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    best = {}
    for r, g in zip(kept, root):
        best[g] = min(best.get(g, r), r, key=lambda x: x[0])
    single = list(best.values())
    masked = [(r[0], replace_all(r[1], KEY.encode())[0], *r[2:]) for r in single]
    plan, _ = mix_brute([(r[0], r[1], r[3]) for r in masked])
    copies = {p[0]: p[4] // p[1] if p[1] else 0 for p in plan}
    return kept, single, masked, [r for r in masked for _ in range(copies[r[0]])]


def test_stages(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    wanted = brute(rows)
    for (name, stage), want in zip(corpus_pipeline.STAGES, wanted):
        docs = stage(spark, docs, None)
        assert docs.columns == DOCUMENT, name
        assert Counter(map(tuple, docs.collect())) == Counter(want), name
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer_file())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, None).collect()
    ids = [(r[0], [*model.encode(r[1], add_special_tokens=False).ids, END]) for r in wanted[-1]]
    assert Counter((p.doc_id, p.length, p.ids_crc32) for p in pieces) == Counter((i, len(x), zlib.crc32(array("I", x).tobytes())) for i, x in ids)


def test_run(spark):
    d = "/root/testdata/sf0.001"
    first = corpus_pipeline.run(spark, d)
    assert first.count() == corpus_pipeline.run(spark, d).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None

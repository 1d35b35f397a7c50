import json

from foliant.operators.subjects import EXCLUDE_TERMS, INCLUDE_TERMS, PREFILTER_TERMS
from foliant.plans.novels import novel_counters, novel_isbns
from foliant.sources import readers as r


def line(body):
    text = body if isinstance(body, str) else json.dumps(body, ensure_ascii=False)
    return "\t".join(["/type/edition", "/books/E1", "1", "2020", text])


LINES = [
    line({"subjects": ["Fantasy fiction"], "isbn_13": ["9780000000001"]}),
    line({"subjects": ["Fiction", "Prehistory"], "isbn_13": ["9780000000002"]}),
    line({"subjects": ["Romance"], "isbn_13": [], "isbn_10": [" 0123456789 "]}),
    line({"title": "fiction", "isbn_13": ["9780000000003"]}),
    line({"subjects": ["Fiction"]}),
    line({"subjects": ["Science"], "isbn_13": ["9780000000004"], "title": "a novel"}),
    "too\tfew\tfields\t",
    "a\tb\tc\t" + json.dumps({"subjects": ["Fiction"], "isbn_13": ["9780000000005"]}),
    line('{"subjects": ["Fiction"], "isbn_13": ["978000000'),
    line('{"isbn_13": ["978'),
    line({"subjects": ["Young Adult"], "isbn_13": ["9780000000001"]}),
    line({"subjects": ["HORROR tales"], "isbn_10": ["1"], "notes": "x"}).replace('"x"', '\t"x"'),
    line({"subjects": [], "isbn_10": ["2"], "notes": "fiction"}),
]


def test_novels(spark, write):
    dump = r.read_edition_dump(spark, write("\n".join(LINES)))
    assert sorted(x.isbn for x in novel_isbns(dump).collect()) == ["0123456789", "1", "9780000000001"]
    counters = novel_counters(dump).first()
    assert (counters.parsed, counters.malformed, counters.excluded, counters.isbns) == (8, 1, 1, 3)


def test_fields_agree_with_split(spark, write):
    rows = ["a\tb\tc\td\te\tf\tg", "a\tb\tc\td\t", "a\tb\tc\td", "", "é\tü\tc\td\tñ ü", "\t\t\t\tx"]
    got = sorted(x.json for x in r.edition_json(spark.read.text(write("\n".join(rows)))).collect())
    assert got == sorted(p[4] for p in (x.split("\t", 4) for x in rows) if len(p) == 5)


def test_agrees_with_brute_force(spark, write):
    words = ["Fiction", "history", "Guide", "Mystery", "cooking", "Manga", "young adult", "Essays", "Novela"]
    bodies = [
        {"isbn_13": [f"978{n % 40}"], "subjects": [words[n % 9], words[(n * 7 + n // 9) % 9]]} for n in range(200)
    ]
    dump = r.read_edition_dump(spark, write("\n".join(line(b) for b in bodies)))
    want = set()
    for body in bodies:
        subjects = [s.lower() for s in body["subjects"]]
        hit = lambda terms: any(t in s for s in subjects for t in terms)  # noqa: E731,B023
        if any(t in json.dumps(body).lower() for t in PREFILTER_TERMS) and not hit(EXCLUDE_TERMS) and hit(INCLUDE_TERMS):
            want.add(body["isbn_13"][0])
    assert {x.isbn for x in novel_isbns(dump).collect()} == want


def test_running_the_filter_on_its_own_output_changes_nothing(spark, write):
    dump = r.read_edition_dump(spark, write("\n".join(LINES)))
    once = sorted(x.isbn for x in novel_isbns(dump).collect())
    again = "\n".join(line({"subjects": ["fiction"], "isbn_13": [isbn]}) for isbn in once)
    assert sorted(x.isbn for x in novel_isbns(r.read_edition_dump(spark, write(again, "again"))).collect()) == once

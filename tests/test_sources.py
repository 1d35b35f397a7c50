import json

from pyspark.sql import functions as F

from foliant.operators.normalize import normalize_books
from foliant.operators.summaries import parse_summary
from foliant.sources import readers as r, writers as w

BOOKS = [
    {"book_id": "1", "title": "One", "description": "a\ttab"},
    {"book_id": "2", "title": "Two }, {", "authors": [{"author_id": " 7 "}, {}, 3]},
    {"Title": "Drei", "title": "no", "Genre": ["X", "Y"], "Point": 4.5},
]


def titles(raw):
    rows = normalize_books(raw).orderBy("pos").select("book_id", "title", "authors").collect()
    return [row.title for row in rows]


def test_jsonl_skips_what_is_no_object(spark, write):
    lines = [json.dumps(BOOKS[0]), "", "  ", "{broken", "3", "[1]", '"text"', json.dumps(BOOKS[1]), '{"a":1} x',
             json.dumps(BOOKS[2])]
    path = write("\n\n" + "\n".join(lines))
    assert list(r.detect_books_formats(spark, path)) == ["jsonl"]
    assert titles(r.read_books(spark, path)) == ["One", "Two }, {", "Drei"]


def test_raw_control_characters_only_in_arrays(spark, write):
    line = '{"book_id":"1","title":"a\x01\tb"}'
    assert titles(r.read_books_jsonl(spark, write(line, "l"))) == []
    assert titles(r.read_books(spark, write(f"[\n{line}\n]", "rows"))) == ["a\x01\tb"]
    assert titles(r.read_books(spark, write(f"[{line}]", "whole"))) == ["a\x01\tb"]


def test_array_layouts(spark, write):
    rows = "[\n" + ",\n".join(json.dumps(b) for b in BOOKS) + "\n]"
    layouts = {
        "rows": rows,
        "indented": json.dumps(BOOKS, indent=2),
        "whole": json.dumps(BOOKS),
    }
    for layout, text in layouts.items():
        path = write("\n \n" + text, layout)
        assert list(r.detect_books_formats(spark, path)) == ["rows" if layout == "rows" else "whole"]
        assert titles(r.read_books(spark, path)) == ["One", "Two }, {", "Drei"], layout
        assert titles(r.read_books(spark, path, layout)) == ["One", "Two }, {", "Drei"], layout
    path = write(json.dumps(BOOKS, indent=4), "wide")
    assert list(r.detect_books_formats(spark, path)) == ["whole"]
    assert titles(r.read_books(spark, path)) == ["One", "Two }, {", "Drei"]


def test_broken_array_gives_nothing(spark, write):
    assert titles(r.read_books(spark, write('[{"book_id":"1"', "broken"), "whole")) == []


def test_kinds_of_files_and_records_between(spark, write, tmp_path):
    folder = tmp_path / "folder"
    folder.mkdir()
    (folder / "a.jsonl").write_text("\n".join(json.dumps(b) for b in BOOKS[:2]))
    (folder / "b.json").write_text("[" + json.dumps(BOOKS[2]) + ",\n" + json.dumps(BOOKS[0], indent=1) + "]")
    (folder / "c.json").write_text(json.dumps(BOOKS[:2]))
    kinds = r.detect_books_formats(spark, str(folder))
    assert {k: len(v) for k, v in kinds.items()} == {"jsonl": 1, "whole": 2}
    assert sorted(titles(r.read_books(spark, str(folder)))) == ["Drei", "One", "One", "One", "Two }, {", "Two }, {"]
    feed = write('[\n  {\n    "book_id": "1",\n    "title": "a\nb"\n  }\n]', "feed")
    assert titles(r.read_books(spark, feed)) == ["a\nb"]


def test_malformed_texts_are_counted(spark, write):
    lines = [json.dumps(BOOKS[0]), "{'book_id':'2'}", '{"book_id":"3"} {"book_id":"4"}', '{"book_id":"5"},{"book_id":"6"}', "[1]", "", json.dumps(BOOKS[1])]
    raw = r.read_books_jsonl(spark, write("\n".join(lines)), keep_malformed=True)
    assert parse_summary(raw).head().asDict() == {"records": 2, "parse_errors": 4}
    cut = r.read_books(spark, write('[{"book_id":"1"}, {"book_id":', "cut"), keep_malformed=True)
    assert parse_summary(cut).head().asDict() == {"records": 1, "parse_errors": 1}


def test_array_beyond_one_variant_value(spark, tmp_path):
    record = json.dumps({"book_id": "1", "title": "t", "description": "x" * 990})
    path = tmp_path / "large"
    with open(path, "w") as file:
        file.write("[\n " + record)
        for _ in range(139_999):
            file.write(",\n " + record)
        file.write("]")
    assert path.stat().st_size > 138 << 20
    assert r.read_books(spark, str(path), "whole").count() == 140_000


def test_repeated_keys_in_any_session(spark, write):
    path = write('{"Title":"a","Title":"b","ISBN":"1"}')
    old = spark.conf.get("spark.sql.variant.allowDuplicateKeys")
    try:
        for allowed in ("true", "false"):
            spark.conf.set("spark.sql.variant.allowDuplicateKeys", allowed)
            assert titles(r.read_books_jsonl(spark, path)) == ["b"]
    finally:
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", old)


def test_isbn_list(spark, write, tmp_path):
    path = write(" 978 \n\n978\n1\n   \n")
    assert sorted(x.isbn for x in r.read_isbn_list(spark, path).collect()) == ["1", "978", "978"]
    w.write_isbn_list(r.read_isbn_list(spark, path), str(tmp_path / "out"))
    assert sorted(x.isbn for x in r.read_isbn_list(spark, str(tmp_path / "out")).collect()) == ["1", "978"]


def entries(df):
    return sorted((x.isbn, x.disposition) for x in df.collect())


def test_checkpoint_layouts(spark, write, tmp_path):
    want = [("1", "failed"), ("2", "duplicate"), ("3", "failed")]
    full = {"failed_isbns": ["1", "3"], "duplicate_isbns": ["2"], "non_english_isbns": []}
    for n, text in enumerate([json.dumps(full), json.dumps(full, indent=4)]):
        df = r.read_checkpoint(spark, write(text, f"c{n}"))
        assert entries(df) == want
        failed = df.where("disposition = 'failed'").orderBy("pos").collect()
        assert [x.isbn for x in failed] == ["1", "3"]
    assert entries(r.read_checkpoint(spark, write('{"failed_isbns":["9"]}', "part"))) == [("9", "failed")]
    assert entries(r.read_checkpoint(spark, write("{oops", "bad"))) == []
    # A checkpoint may be split over several objects and is read back whole.
    many = spark.range(100).select(F.col("id").cast("string").alias("isbn"), F.lit("failed").alias("disposition"))
    w.write_checkpoint(many.union(many), str(tmp_path / "many"), chunks=10)
    assert spark.read.text(str(tmp_path / "many")).count() > 5
    assert entries(r.read_checkpoint(spark, str(tmp_path / "many"))) == entries(many)


def test_undecodable_log_bytes(spark, tmp_path):
    path = tmp_path / "log"
    path.write_bytes(b"ok \xff\xfe line\nnext\n")
    assert r.read_crawl_log(spark, str(path)).count() == 2


def test_csv_keeps_cells_as_they_are(spark, tmp_path):
    import csv

    rows = [("1", ' a "q", b \n c', None, ["é"], [], 1.5, None, 3, None, None, None)]
    from foliant.schemas import SCRAPED_FIELDS, ddl

    books = spark.createDataFrame(rows, ddl(SCRAPED_FIELDS)).coalesce(1)
    out = tmp_path / "csv"
    w.write_books_csv(books, str(out))
    text = next(out.glob("part-*.csv")).read_text(encoding="utf-8")
    cells = list(csv.reader(text.splitlines(keepends=True)))
    assert cells[0] == list(SCRAPED_FIELDS)
    assert cells[1] == ["1", ' a "q", b \n c', "", '["é"]', "[]", "1.5", "", "3", "0", "0", "0"]


def test_replace_table_while_reading_it(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    w.replace_table(spark.read.parquet(path).where("id < 3"), path)
    assert spark.read.parquet(path).count() == 3


def test_export_columns(spark):
    raw = spark.createDataFrame([("x",)], "value string").select(F.lit(json.dumps(BOOKS[1])).alias("value"))
    record = raw.select(F.from_json("value", "book_id string, title string").alias("r")).select("r.*")
    for name in w.export_rows(_records(spark, record)).columns:
        assert name in w.export_rows(_records(spark, record)).first().asDict()


def _records(spark, df):
    from foliant.schemas import RECORD_NESTED, RECORD_TEXT

    empty = spark.createDataFrame(
        [], ", ".join([f"{n} string" for n in RECORD_TEXT] + [f"{n} {t}" for n, t in RECORD_NESTED.items()])
    )
    return empty.unionByName(df, allowMissingColumns=True)


def test_lines_of_record_files_are_not_looked_into_for_their_kind(spark, write, monkeypatch):
    path, looked = write('{"title": "One"}\n{"title": "Two"}\n'), []
    real = r._have_rows
    monkeypatch.setattr(r, "_have_rows", lambda lines: looked.append(1) or real(lines))
    assert list(r.detect_books_formats(spark, path)) == ["jsonl"] and not looked
    assert list(r.detect_books_formats(spark, write('[\n{"a": 1}\n,\n{"a": 2}\n]\n', "rows"))) == ["rows"] and looked
    assert list(r.detect_books_formats(spark, write('[\n{"a":\n1}\n]\n', "whole"))) == ["whole"]

"""Nested texts travel as JSON, and the texts of a build are stored compressed."""

import json

from pyspark.sql import functions as F

from foliant import session
from foliant.checks import ingest_queries
from foliant.operators.compact import LONGEST, compactly
from foliant.plans.catalog import build_catalog
from foliant.sources import readers as r, writers as w

ROW = "id int, authors array<struct<author_id:string,role:string>>, names array<string>, rec struct<a:string,`b c`:string,d:array<struct<x:string>>>, n array<int>"


def rows(spark):
    found = spark.createDataFrame(
        [
            (1, [("1", "Editor"), None, (None, None), ("", ""), (None, 'q"\\ \n é😀')], ["a", None, "", "\x00\x01"], ("x", None, [None, (None,), ("y",)]), [1, None]),
            (2, None, None, None, None),
            (3, [], [], (None, None, None), []),
            (4, [("\ufffd", "r")], ["\ufffd"], ("\ufffd", None, None), [3]),
            (5, [("x" * 9, "y" * LONGEST)], ["w" * LONGEST], ("v", None, [("u" * LONGEST,)]), [4]),
        ],
        ROW,
    )
    broken = F.unhex(F.lit("61FF62")).cast("string")
    bytes_ = found.where("id = 1").withColumns({"id": F.lit(6), "names": F.array(broken), "authors": F.array(F.struct(broken.alias("author_id"), F.lit("k").alias("role")))})
    return found.unionByName(bytes_)


def hashes(df):
    return sorted(tuple(x) for x in df.select("id", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).collect())


def test_values_come_back_as_they_were(spark):
    df, seen = rows(spark), []
    out = compactly(df, lambda x: (seen.append(x), x.repartition(3, "id"))[1], ["id"])
    assert hashes(out) == hashes(df) and out.dtypes == df.dtypes
    names = seen[0].select("id", "_json_names", "names").where("id < 6").orderBy("id").collect()
    assert [x._json_names is None for x in names] == [False, True, False, True, True]
    assert [x.names is None for x in names] == [True, True, True, False, False]


def test_a_result_is_moved_again_without_being_read(spark):
    seen = []
    once = compactly(rows(spark), lambda x: x.where("id <> 2"), ["id"], lambda x: x.select("id", F.size("names").alias("k"), "rec"), ["id"])
    for reads in (["id"], ["k"]):
        again = compactly(once, lambda x: (seen.append(x.columns), x.sort(*reads))[1], reads)
        assert hashes(again) == hashes(once)
    assert "names" in seen[0] and "k" not in seen[0]  # by a column that was left as it is
    assert "k" in seen[1]  # by one that was made
    compactly(once.cache(), lambda x: (seen.append(x.columns), x)[1], ["id"])
    once.unpersist()
    assert "k" in seen[2]  # cached rows are not made anew


def test_catalog_is_written_from_packed_records(spark, tmp_path, monkeypatch):
    lines = [json.dumps({"book_id": str(n), "title": None if n % 2 else f"b{n}", "title_without_series": f"a{n}", "authors": [{"author_id": str(n)}]}) for n in range(40)]
    (tmp_path / "b.json").write_text("\n".join(lines))
    built = build_catalog(r.read_books_jsonl(spark, str(tmp_path / "b.json")))
    with monkeypatch.context() as m:
        m.setattr(w, "replace_table", lambda df, *rest: plans.append(df._jdf.queryExecution().executedPlan().toString()))
        plans: list[str] = []
        w.write_catalog(built, "")
    top, below = plans[0].split("Exchange rangepartitioning")
    between, _ = below.split("Exchange hashpartitioning")
    assert "author_ids" in top and "from_json" in top  # typed rows are made above both shuffles
    assert "author_ids" not in between and "from_json" not in between
    for by in ("book_id", "title"):
        w.write_catalog(built, str(tmp_path / by), by)
        got = r.load_catalog(spark, str(tmp_path / by)).collect()
        assert sorted(x.book_id for x in got) == sorted(str(n) for n in range(40))
        assert [x[by] for x in got] == sorted(x[by] for x in got)
        assert {x.title for x in got} == {f"{'a' if n % 2 else 'b'}{n}" for n in range(40)}


def test_build_stores_its_texts_compressed(spark, tmp_path, monkeypatch):
    part = spark.range(300).select(
        F.col("id").alias("p_partkey"), F.format_string("ring %s", "id").alias("p_name"), F.lit("B").alias("p_brand"), F.lit("T").alias("p_type"), F.lit(1).alias("p_size"),
    )
    item = spark.range(6000).select(
        (F.col("id") % 300).alias("l_partkey"), F.col("id").alias("l_suppkey"), F.lit(2.0).alias("l_quantity"), F.lit("R").alias("l_returnflag"), F.lit("2020-01-01").cast("timestamp").alias("l_shipdate"),
    )
    for name, df in (("part", part), ("lineitem", item)):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    for at in (ingest_queries, session):
        monkeypatch.setattr(at, "scratch", lambda spark, name: str(tmp_path / "kept" / name))
    got = ingest_queries.catalog_build(spark, str(tmp_path)).collect()
    assert len(got) == 300 and {len(x.authors.split(",")) for x in got} == {20} and "outdated" not in {x.title for x in got}
    raw = list((tmp_path / "kept" / "raw-books").rglob("part-*"))
    assert {f.parent.name for f in raw} == {"a", "b", "c"} and all(f.name.endswith(".json.gz") for f in raw)
    w.append_books_json(spark.read.parquet(str(tmp_path / "kept" / "records")), str(tmp_path / "plain"))
    assert sum(f.stat().st_size for f in raw) < sum(f.stat().st_size for f in (tmp_path / "plain").glob("*.json"))


def test_compressed_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(w, "RECORDS_PER_FILE", 100)
    w.append_books_json(spark.range(0, 450, 1, 2).select(F.col("id").cast("string").alias("book_id"), F.lit(None).cast("string").alias("title")), str(tmp_path / "x"), "gzip")
    assert len(list((tmp_path / "x").glob("*.json.gz"))) == 6
    raw = r.read_books_jsonl(spark, str(tmp_path / "x"))
    assert [x.id for x in raw.select(F.col("plain.book_id").cast("int").alias("id"), "pos").orderBy("pos").collect()] == list(range(450))

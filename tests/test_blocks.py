"""Searches through the block index against searches without it."""

import random

import pytest
from pyspark.sql import functions as F

from foliant.operators.predicates import SearchSpec
from foliant.plans.search import search
from foliant.sources.blocks import candidate_blocks, clauses, restricted, search_blocks, write_block_index

KIND = ("book_id string, title string, description string, publisher string, language_code string, is_ebook boolean, author_ids array<string>, "
        "shelves array<string>, isbn string, isbn13 string, asin string, average_rating double, ratings_count bigint, text_reviews_count bigint, publication_year bigint, record string")


def books(n, seed=1):
    rng = random.Random(seed)
    words = ["Red", "ring", "ÉTÉ", "straße", "100%", "under_score", "back\\slash", "of", "İstanbul", "😀😀😀x", "gizmo", "Widget", "a"]
    text = lambda k: " ".join(rng.choices(words, [9] * 8 + [1] * 5, k=k)) if k else None
    return [
        (f"{i:05}", text(rng.randint(0, 4)), text(rng.randint(0, 6)), rng.choice(["Ace Books", "tor", "", None]), rng.choice(["eng", "fre", "", None]), rng.choice([True, False, None]),
         [str(rng.randint(0, 60)) for _ in range(rng.randint(0, 3))], rng.choices(["to-read", "s1", f"rare{i % 97}"], k=2) if i % 9 else None, str(i), "", "", float(i % 6), i % 50, i % 4, 1990 + i % 9, "r" * 50)
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("blocks")
    catalog, index = str(folder / "catalog"), str(folder / "index")
    rows = spark.createDataFrame(books(2000), KIND)
    rows.repartitionByRange(5, "book_id").sortWithinPartitions("book_id").write.parquet(catalog)
    write_block_index(spark, catalog, index, rows=40)
    return catalog, index


SPECS = [
    {"title_query": "RED R"}, {"title_query": "red%ring"}, {"title_query": "r_d"}, {"title_query": "été"}, {"title_query": "STRASSE"}, {"title_query": "straße"}, {"title_query": "istanbul"},
    {"title_query": "İSTANBUL"}, {"title_query": "100%"}, {"title_query": "back\\s"}, {"title_query": "😀😀x"}, {"title_query": "nowhere at all"}, {"title_query": "_%_"}, {"title_query": "gizmo%widget"},
    {"publisher_query": "BOOK"}, {"publisher_query": "to"}, {"language_code": "fre"}, {"language_code": "xx"}, {"is_ebook": True}, {"is_ebook": False}, {"author_id": 7}, {"shelf": "RARE5"},
    {"author_id": "7", "shelf": "rare11", "is_ebook": True}, {"title_query": "widget", "publisher_query": "ace", "language_code": "eng", "shelf": "s1"}, {"rating_min": 2.0}, {},
    {"shelf": "rare3", "title_query": "of", "sort_by": "year", "limit": 5, "offset": 2},
]


@pytest.mark.parametrize("fields", SPECS, ids=map(str, SPECS))
def test_same_rows_as_without_the_index(spark, stored, fields):
    spec = SearchSpec(**{"limit": 3000, **fields})
    key = lambda df: [tuple(r) for r in df.select("position", "book_id").orderBy("position").collect()]
    assert key(search_blocks(spark, *stored, spec)) == key(search(spark.read.parquet(stored[0]), spec))


def test_only_blocks_that_can_match_are_read(spark, stored):
    spec = SearchSpec(shelf="rare42", author_id=5)
    blocks = candidate_blocks(spark, stored[1], spec).collect()
    want = {int(b[0]) // 400 * 100 + int(b[0]) % 400 // 40 for b in books(2000) if b[7] and "rare42" in b[7]}
    assert 0 < len(blocks) <= len(want)
    rare = SearchSpec(title_query="gizmo%widget", author_id=59, shelf="rare7")
    assert len(restricted(spark, *stored, rare).inputFiles()) < 5
    assert restricted(spark, *stored, SearchSpec(title_query="nowhere at all")).count() == 0
    plan = restricted(spark, *stored, spec)._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(book_id" in plan
    # Every match is in a candidate block, and blocks without any term are left out.
    for r in blocks:
        assert r["low"] <= r["high"]
    total = spark.read.parquet(f"{stored[1]}/blocks").count()
    assert 50 <= total <= 60 and len(blocks) < total


def test_many_blocks_skip_whole_files_only(spark, stored):
    spec = SearchSpec(language_code="eng")
    assert restricted(spark, *stored, spec, ranges=3).count() == 2000
    assert search(restricted(spark, *stored, spec, ranges=3), spec).count() == 10


def test_files_after_the_index_are_read(spark, tmp_path):
    catalog, index = str(tmp_path / "c"), str(tmp_path / "i")
    spark.createDataFrame(books(300), KIND).coalesce(1).write.parquet(catalog)
    write_block_index(spark, catalog, index)
    late = [(f"x{b[0]}", "a title of its own", *b[2:]) for b in books(5, seed=2)]
    spark.createDataFrame(late, KIND).coalesce(1).write.mode("append").parquet(catalog)
    found = search_blocks(spark, catalog, index, SearchSpec(title_query="of its own", limit=100))
    assert {r.book_id for r in found.collect()} == {f"x{i:05}" for i in range(5)}


def test_what_the_index_can_tell():
    assert clauses(SearchSpec()) == clauses(SearchSpec(title_query="ab_cd%", rating_min=1.0)) == []
    assert clauses(SearchSpec(title_query="abc%de_fgh")) == [[("title", ["abc", "fgh"]), ("description", ["abc", "fgh"])]]
    assert clauses(SearchSpec(is_ebook=False, shelf="X Y")) == [[("is_ebook", ["false"])], [("shelf", ["x y"])]]


def test_empty_catalog(spark, tmp_path):
    catalog, index = str(tmp_path / "c"), str(tmp_path / "i")
    spark.createDataFrame([], KIND).write.parquet(catalog)
    write_block_index(spark, catalog, index)
    assert search_blocks(spark, catalog, index, SearchSpec(title_query="red ring")).count() == 0

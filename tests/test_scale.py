"""Plans hold what large runs need, and hot keys give whole results."""

import pytest
from pyspark.sql import functions as F

from foliant.operators.dedup import distinct_first_isbn, first_n, flag_first, keep_first_by_title, keep_last_by_id, known_titles
from foliant.operators.predicates import SearchSpec
from foliant.operators.sets import resume_queue
from foliant.plans.catalog import build_catalog
from foliant.plans.novels import novel_isbns
from foliant.plans.search import search, search_page, similar
from foliant.sources import readers as r, writers as w


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df)


@pytest.fixture
def skewed(spark):
    """Small limits, so that a hot key in little data is treated as on a cluster."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_rows(spark, n=30_000):
    """A third of all rows share one title; the rest are mostly distinct."""
    title = F.when(F.col("id") % 3 == 0, " Hot ").otherwise(F.concat(F.lit("t"), (F.col("id") % 9000).cast("string")))
    return spark.range(0, n, 1, 16).select("id", title.alias("Title"), F.repeat(F.md5(F.col("id").cast("string")), 4).alias("payload"))


def test_flags_of_a_hot_title_are_whole_and_split(skewed):
    flagged = keep_first_by_title(hot_rows(skewed), "Title", "id")
    rows = flagged.select("id", "Title", "is_first").collect()
    firsts = {}
    for row in sorted(rows):
        firsts.setdefault(row.Title.strip().lower(), row.id)
    assert len(rows) == 30_000
    assert {x.id for x in rows if x.is_first} == set(firsts.values())
    assert "skew=true" in final_plan(flagged)


def test_hot_queue_and_known_titles_are_split(skewed):
    listed = hot_rows(skewed).select(F.col("Title").alias("isbn"), "payload")
    queue = resume_queue(listed, skewed.createDataFrame([("t1",), ("t1",)], "isbn string"))
    assert queue.count() == listed.where("isbn <> 't1'").count()
    assert "skew=true" in final_plan(queue)
    known = skewed.createDataFrame([("hot",), ("hot",), (None,)], "title_key string")
    assert known_titles(hot_rows(skewed), known, "Title").count() == 10_000
    assert known_titles(hot_rows(skewed), known, "Title", keep_known=False).count() == 20_000


def test_hot_similar_target_is_split(skewed):
    books = hot_rows(skewed).select(
        F.col("id").cast("string").alias("book_id"),
        F.array(F.lit("7"), (F.col("id") + 1).cast("string")).alias("similar_books"),
        F.col("payload").alias("title"),
    )
    found = similar(books, books.select("book_id", "title"))
    assert found.where("similar_id = '7'").count() == 30_001
    assert found.count() == 59_999
    assert "skew=true" in final_plan(found)


def test_known_keys_and_rows_without_a_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b"), (5, None)], "id int, k string")
    known = spark.createDataFrame([("b",)], "k string")
    got = {x.id: x.is_first for x in flag_first(df, "k", "id", known).collect()}
    assert got == {1: True, 2: False, 3: None, 4: False, 5: None}


def test_dedup_cuts_before_the_shuffle(spark):
    rows = hot_rows(spark)
    for df in (keep_last_by_id(rows, "Title", "id"), first_n(rows, "Title", "id", 10)):
        text = plan(df)
        assert text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")
    assert {x.id for x in keep_last_by_id(rows, "Title", "id").where("Title = ' Hot '").collect()} == {29_997}
    assert first_n(rows, "Title", "id", 10).where("Title = ' Hot '").count() == 10
    firsts = distinct_first_isbn(rows.select(F.col("Title").alias("isbn"), "id"), "id")
    assert firsts.where("isbn = ' Hot '").first().id == 0


def test_search_plan(spark, tmp_path):
    lines = [f'{{"book_id":"{n}","title":"t{n}","ratings_count":"{n}","isbn":"i{n}"}}' for n in range(500)]
    (tmp_path / "b.json").write_text("\n".join(lines))
    built = build_catalog(r.read_books_jsonl(spark, str(tmp_path / "b.json")))
    text = plan(built)
    assert text.count("from_json(StructField(_misfit") == 1 and text.count("Exchange hashpartitioning") == 1
    target = str(tmp_path / "catalog")
    w.write_catalog(built, target)
    catalog = r.load_catalog(spark, target)
    text = plan(search(catalog, SearchSpec(rating_min=0, isbn_query="i3", title_query="t")).select("book_id"))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    assert "GreaterThanOrEqual(average_rating,0.0)" in text and "EqualTo(isbn,i3)" in text
    scan = text[text.index("ReadSchema"):]
    assert "record" not in scan and "publisher" not in scan
    assert "PushedFilters: [In(book_id" in plan(search_page(catalog, SearchSpec(limit=3)))


def test_dump_is_parsed_once(spark, write):
    text = plan(novel_isbns(r.read_edition_dump(spark, write("a\tb\tc\td\t{}"))))
    assert text.count("from_json(") == 1
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_deep_pages_come_from_a_distributed_sort(spark):
    catalog = spark.range(300_000).select(
        F.col("id").cast("string").alias("book_id"), F.col("id").alias("ratings_count")
    )
    text = plan(search(catalog, SearchSpec(limit=10, offset=200_000)))
    assert "rangepartitioning" in text and "TakeOrderedAndProject" not in text

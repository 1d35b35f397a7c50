import pytest
from pyspark.sql import functions as F

from foliant.checks import stream_queries
from foliant.plans.crawl import triage_pages
from foliant.streaming import crawl as s
from page_rows import PAGES_DDL, page_rows


def land(spark, folder, rows, name):
    spark.createDataFrame(rows, PAGES_DDL).coalesce(1).write.parquet(f"{folder}/{name}")


def stream(spark, folder, per_batch=None):
    schema = spark.createDataFrame([], PAGES_DDL).schema
    return s.stream_pages(spark, f"{folder}/*", schema, files_per_batch=per_batch)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


@pytest.mark.parametrize("per_batch", [None, 1])
def test_dedup_over_batches_and_a_restart(spark, tmp_path, per_batch):
    rows = page_rows(40)
    folder, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    titles = lambda: s.stream_dedup_titles(stream(spark, folder, per_batch).withColumnRenamed("page_title", "Title")).select("title_key", "isbn")
    land(spark, folder, rows[:15], "a")
    land(spark, folder, rows[15:25], "b")
    finish(s.run(titles(), state, out))
    land(spark, folder, rows[25:], "c")
    finish(s.run(titles(), state, out))
    keys = [x.title_key for x in spark.read.parquet(out).collect()]
    assert len(keys) == len(set(keys))
    assert set(keys) == {r[2].strip().lower() for r in rows}


def test_store_over_batches_equals_one_batch_triage(spark, tmp_path):
    rows = page_rows(40)
    folder, store, state = (str(tmp_path / x) for x in ("in", "store", "state"))
    for n in range(4):
        land(spark, folder, rows[n * 10:n * 10 + 10], f"p{n}")
        finish(s.run(s.stream_triage(stream(spark, folder)), state, batch=s.store_sink(store, order="pos")))
    want = triage_pages(spark.createDataFrame(rows, PAGES_DDL), order="pos")
    saved = {x.isbn for x in want.where("disposition = 'saved'").collect()}
    assert saved
    assert {x.ISBN for x in spark.read.json(f"{store}/books").collect()} == saved
    csv = spark.read.options(header=True, multiLine=True, escape='"').csv(f"{store}/books_csv")
    assert {x.ISBN for x in csv.collect()} == saved
    noted = {(x.isbn, x.disposition) for x in spark.read.parquet(f"{store}/checkpoint").collect()}
    assert noted == {(x.isbn, x.disposition) for x in want.collect() if x.disposition in ("failed", "duplicate", "non_english")}


def test_running_a_batch_again_changes_nothing(spark, tmp_path):
    store = str(tmp_path / "store")
    sink = s.store_sink(store, order="pos")
    judged = s.stream_triage(spark.createDataFrame(page_rows(12), PAGES_DDL))
    sink(judged, 0)
    once = sorted(x.ISBN for x in spark.read.json(f"{store}/books").collect())
    sink(judged, 0)
    assert sorted(x.ISBN for x in spark.read.json(f"{store}/books").collect()) == once


def test_running_counts(spark, tmp_path):
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    seen = []
    for name, rows in (("a", page_rows(10)), ("b", page_rows(30)[10:])):
        land(spark, folder, rows, name)
        judged = s.stream_triage(stream(spark, folder)).select(F.coalesce("disposition", F.lit("open")).alias("disposition"))
        finish(s.run(s.stream_dispositions(judged), state, batch=lambda df, n: seen.append({x.disposition: x.isbns for x in df.collect()}), mode="complete"))
    assert sum(seen[-1].values()) == 30


def test_bounded_state_variant(spark, tmp_path):
    folder, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    land(spark, folder, page_rows(20), "a")
    timed = stream(spark, folder).withColumnRenamed("page_title", "Title").withColumn("at", F.current_timestamp())
    finish(s.run(s.stream_dedup_titles(timed, event_time="at", delay="1 hour").select("title_key"), state, out))
    assert spark.read.parquet(out).count() == len({r[2].strip().lower() for r in page_rows(20)})


def test_landings_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream_queries, "scratch", lambda spark, name: str(tmp_path))
    rows = spark.range(60).select(F.col("id").alias("pos")).repartition(3)
    found = [len(list(tmp_path.glob("*.parquet"))) for _ in stream_queries._landed(spark, rows)]
    assert found == [3, 6, 9, 12, 12]

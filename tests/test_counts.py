"""Counts kept over appends, and counts of the batches of a running crawl."""

from pyspark.sql import functions as F

from foliant.sources.counters import append_counted, kept_counts, rebuild_counters
from foliant.streaming import crawl as s
from foliant.streaming.progress import COUNTS, ProgressLog, observed, read_progress
from foliant.streaming.titles import state_on_disk
from page_rows import PAGES_DDL, page_rows


def test_distinct_keys_after_appends(spark, tmp_path):
    store, kept = str(tmp_path / "store"), str(tmp_path / "kept")
    assert kept_counts(spark, kept).head().asDict() == {"appends": 0, "rows": 0, "keys": 0}
    rows = spark.range(60_000).select((F.col("id") % 40_000).cast("string").alias("isbn"), F.lit("x").alias("title"))
    parts = [rows.where("isbn < '2'"), rows.where("isbn >= '15'"), rows.where("isbn < '3'").repartition(5), rows.where("false")]
    for part in parts:
        assert abs(append_counted(part, store, kept, "isbn")["keys"] - part.distinct().count()) <= 0.04 * part.distinct().count()
    # The store itself is not needed.
    found = kept_counts(spark, kept).head()
    stored = spark.read.schema("isbn string, title string").json(store)
    assert found.appends == 4 and found.rows == stored.count()
    # Five standard errors.
    assert abs(found["keys"] / 40_000 - 1) < 0.04
    rebuild_counters(stored, kept, "isbn")
    again = kept_counts(spark, kept).head()
    assert (again.appends, again.rows) == (1, found.rows) and abs(again["keys"] / 40_000 - 1) < 0.04


def test_missing_keys_are_rows(spark, tmp_path):
    rows = spark.createDataFrame([("1",), (None,), ("1",)], "isbn string")
    assert append_counted(rows, str(tmp_path / "s"), str(tmp_path / "k"), "isbn") == {"rows": 3, "keys": 1}
    none = rows.where("isbn IS NULL")
    assert append_counted(none, str(tmp_path / "s"), str(tmp_path / "k"), "isbn") == {"rows": 1, "keys": 0}


def test_exact_keys_beyond_what_a_sketch_holds(spark, tmp_path):
    store, kept = str(tmp_path / "store"), str(tmp_path / "kept")
    assert kept_counts(spark, kept, exact=True).head().asDict() == {"appends": 0, "rows": 0, "keys": 0}
    rows = spark.range(260_000).select(F.col("id").cast("string").alias("isbn"))
    missing = spark.createDataFrame([(None,)], "isbn string")
    for part, n in ((rows, 260_000), (rows.where("isbn < '5'").unionByName(rows.limit(9)), None), (rows.unionByName(missing), 260_000)):
        found = append_counted(part, store, kept, "isbn", exact=True)
        assert n is None or found["keys"] == n
    found = kept_counts(spark, kept, exact=True).head()
    assert found.appends == 3 and found["keys"] == 260_000 and found.rows == spark.read.schema("isbn string").json(store).count()
    rebuild_counters(rows, kept, "isbn", exact=True)
    assert kept_counts(spark, kept, exact=True).head().asDict() == {"appends": 1, "rows": 260_000, "keys": 260_000}


def test_counts_of_batches_over_a_restart(spark, tmp_path):
    folder, store, state, log = (str(tmp_path / x) for x in ("in", "store", "state", "log"))
    schema = spark.createDataFrame([], PAGES_DDL).schema
    listener = ProgressLog(spark, log)
    spark.streams.addListener(listener)
    try:
        for n in range(3):
            spark.createDataFrame(page_rows(30)[n * 10 : n * 10 + 10], PAGES_DDL).coalesce(1).write.parquet(f"{folder}/p{n}")
            judged = s.stream_triage(s.stream_pages(spark, f"{folder}/*", schema))
            with state_on_disk(spark):
                query = s.run(observed(s.stream_settled(judged, "pos")), state, batch=s.settled_sink(store))
            query.awaitTermination()
            assert listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    found = read_progress(spark, log).orderBy("batch").collect()
    assert [r.batch for r in found] == [0, 1, 2] and len({r["query"] for r in found}) == 1
    for r in found:
        settled = spark.read.parquet(f"{store}/settled/batch={r.batch}")
        counts = {x.disposition: x["count"] for x in settled.groupBy("disposition").count().collect()}
        assert {c: r[c] for c in COUNTS if c != "read"} == {c: counts.get(c, 0) for c in COUNTS if c != "read"} and r.read == 10

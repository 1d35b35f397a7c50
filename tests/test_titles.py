"""First titles by order of arrival: batches, restarts, hot titles, known titles."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from foliant.plans.crawl import triage_pages
from foliant.streaming import crawl as s
from foliant.streaming.titles import OPEN, _least_per_task, flag_first_titles, state_on_disk
from page_rows import PAGES_DDL, page_rows

DDL = "n bigint, title_key string, x double, tags array<string>"


def land(spark, folder, rows, name, ddl=DDL, parts=3):
    spark.createDataFrame(rows, ddl).repartition(parts).write.parquet(f"{folder}/{name}")


def start(spark, folder, out, state, known=None, order="n"):
    stream = s.stream_pages(spark, f"{folder}/*", spark.createDataFrame([], DDL).schema)
    with state_on_disk(spark):
        query = s.run(flag_first_titles(stream, order, known), state, out)
    query.awaitTermination()
    assert query.exception() is None


def test_first_by_arrival_over_batches_and_restarts(spark, tmp_path):
    rng = random.Random(2)
    folder, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    taken, want, n = set(), {}, 0
    for batch in range(4):
        rows = []
        for _ in range(60):
            title = rng.choice([None, "", "hot", "hot", f"t{rng.randint(0, 25)}"])
            rows.append((rng.randint(-50, 50) * 1000 + n, title, n / 7, ["é", None] if n % 2 else None))
            n += 1
        first = {}
        for r in sorted(rows):
            if r[1] is not None and r[1] not in taken:
                first.setdefault(r[1], r[0])
        for r in rows:
            want[r[0]] = None if r[1] is None else first.get(r[1]) == r[0]
        taken |= set(first)
        land(spark, folder, rows, f"b{batch}")
        # Every batch is a query of its own, started from the checkpoint.
        start(spark, folder, out, state)
    got = spark.read.parquet(out).collect()
    assert {r["n"]: r["is_first"] for r in got} == want and len(got) == 240
    assert all(r["x"] == [x for x in range(240) if r["x"] == x / 7][0] / 7 for r in got)
    assert {tuple(r["tags"]) if r["tags"] else None for r in got} == {None, ("é", None)}


def test_known_titles_and_missing_orders(spark, tmp_path):
    folder, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    known = spark.createDataFrame([("a",), ("a",), (None,)], "title_key string")
    land(spark, folder, [(5, "a", 0.0, []), (None, "b", 1.0, []), (9, "b", 2.0, []), (None, "c", 3.0, [])], "one")
    start(spark, folder, out, state, known)
    land(spark, folder, [(1, "c", 4.0, []), (1, "d", 5.0, [])], "two")
    start(spark, folder, out, state, known)
    assert {r["x"]: r["is_first"] for r in spark.read.parquet(out).collect()} == {0.0: False, 1.0: False, 2.0: True, 3.0: True, 4.0: False, 5.0: True}


def test_a_hot_title_costs_its_group_one_row_per_task():
    frames = [pd.DataFrame({"title_key": ["hot"] * 500 + [f"t{i}" for i in range(5)], "place": [f"{(i * 7919) % 1000:05}" for i in range(505)], "row": [str(i) for i in range(505)]}) for _ in range(20)]
    out = pd.concat(_least_per_task()(iter(frames)))
    assert len(out) == 20 * 505
    open_ = out[out["known"] == OPEN]
    assert sorted(open_["title_key"]) == ["hot"] + [f"t{i}" for i in range(5)]
    assert open_[open_["title_key"] == "hot"]["place"].tolist() == [min(frames[0]["place"][:500])]
    assert out[out["known"] != OPEN]["lane"].nunique() > 32


def test_titles_may_return_after_their_time(spark, tmp_path):
    import time

    folder, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = spark.createDataFrame([], DDL).schema
    for n in range(2):
        land(spark, folder, [(n, "a", float(n), [])], f"b{n}", parts=1)
        with state_on_disk(spark):
            query = s.run(flag_first_titles(s.stream_pages(spark, f"{folder}/*", schema), "n", ttl_ms=500), state, out)
        query.awaitTermination()
        time.sleep(1)
    assert [r["is_first"] for r in spark.read.parquet(out).collect()] == [True, True]


def test_orders_that_cannot_be_told(spark):
    with pytest.raises(ValueError):
        flag_first_titles(spark.createDataFrame([], DDL), "x")


def test_settled_store_equals_triage(spark, tmp_path):
    rows = page_rows(40)
    folder, store, state = (str(tmp_path / x) for x in ("in", "store", "state"))
    schema = spark.createDataFrame([], PAGES_DDL).schema
    for n in range(3):
        land(spark, folder, rows[n * 14 : n * 14 + 14], f"p{n}", PAGES_DDL)
        query = s.run_settled(s.stream_triage(s.stream_pages(spark, f"{folder}/*", schema)), store, state, order="pos")
        query.awaitTermination()
    want = triage_pages(spark.createDataFrame(rows, PAGES_DDL), order="pos")
    verdicts = {x.isbn: x.disposition for x in want.collect()}
    assert {x.ISBN for x in spark.read.json(f"{store}/books").collect()} == {i for i, v in verdicts.items() if v == "saved"}
    noted = {x.isbn: x.disposition for x in spark.read.parquet(f"{store}/checkpoint").collect()}
    assert noted == {i: v for i, v in verdicts.items() if v in ("failed", "duplicate", "non_english")}
    # No title is kept beside the state, and a batch that runs again changes nothing.
    assert not (tmp_path / "store" / "titles").exists()
    # The sink writes what it is given to where this is read from.
    settled = spark.read.parquet(f"{store}/settled/batch=1")
    settled = spark.createDataFrame(settled.collect(), settled.schema)
    s.settled_sink(store)(settled, 1)
    assert {x.isbn: x.disposition for x in spark.read.parquet(f"{store}/checkpoint").collect()} == noted

"""The curve layout: same rows, and ranges of several columns skip most files."""

import random
from pathlib import Path

import pyarrow.parquet as pq

from foliant.operators.predicates import SearchSpec
from foliant.plans.search import search
from foliant.sources.layout import CURVE_COLUMNS, cluster_catalog, curve_place, rank_bounds
from test_blocks import KIND, books


def stored(spark, folder, n=6000):
    rng = random.Random(5)
    rows = [(*b[:11], rng.choice([None, rng.random() * 5]), int(rng.paretovariate(1) * 10), b[13], rng.randint(1900, 2024), b[15]) for b in books(n)]
    path = str(folder / "catalog")
    spark.createDataFrame(rows, KIND).repartition(3).write.parquet(path)
    return path


def files_left(path, ranges):
    """Files whose statistics do not exclude all of ``ranges``."""
    left, total = 0, 0
    for file in sorted(Path(path).glob("*.parquet")):
        meta = pq.ParquetFile(file).metadata
        total += 1
        keep = False
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(i).path_in_schema: meta.row_group(g).column(i).statistics for i in range(meta.num_columns)}
            keep |= all(columns[c].min <= high and columns[c].max >= low for c, (low, high) in ranges.items())
        left += keep
    return left, total


def test_ranges_of_any_column_skip_files(spark, tmp_path):
    path, target = stored(spark, tmp_path), str(tmp_path / "curve")
    cluster_catalog(spark, path, target, files=64)
    assert files_left(path, {"average_rating": (4.5, 9)}) == (3, 3)
    left, total = files_left(target, {"average_rating": (4.5, 9), "publication_year": (1990, 2000)})
    assert total == 64 and left <= 12
    for one in ({"average_rating": (4.5, 9)}, {"publication_year": (1990, 2000)}, {"ratings_count": (100, 10**9)}):
        assert files_left(target, one)[0] <= 32
    spec = SearchSpec(rating_min=4.5, publication_year_min=1990, publication_year_max=2000, limit=7000, sort_by="rating")
    key = lambda p: [tuple(r) for r in search(spark.read.parquet(p), spec).select("position", "book_id").orderBy("position").collect()]
    assert key(path) == key(target) and key(path)
    plan = search(spark.read.parquet(target), spec)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(average_rating" in plan and "LessThanOrEqual(publication_year" in plan


def test_clustering_in_place_keeps_every_row(spark, tmp_path):
    path = stored(spark, tmp_path, 500)
    before = sorted(map(str, spark.read.parquet(path).collect()))
    cluster_catalog(spark, path, path, columns=["publication_year", "text_reviews_count"], bits=3)
    assert sorted(map(str, spark.read.parquet(path).collect())) == before


def test_places(spark):
    df = spark.createDataFrame([(float(i % 8), i // 8, None) for i in range(64)], "average_rating double, ratings_count int, publication_year int")
    bounds = rank_bounds(df, CURVE_COLUMNS, 3)
    places = {(r.average_rating, r.ratings_count): r.p for r in df.withColumn("p", curve_place(bounds)).collect()}
    # Eight steps of two columns: every cell has a place of its own, and each quarter a run of sixteen.
    assert len(set(places.values())) == 64
    order = sorted(places, key=places.get)
    assert {x < 4 for x, _ in order[:16]} == {True} and {y < 4 for _, y in order[:16]} == {True}
    empty = df.limit(0)
    assert empty.withColumn("p", curve_place(rank_bounds(empty, CURVE_COLUMNS))).count() == 0

"""Time the headline jobs; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Inputs that are
files (dump, JSON Lines, catalog) are derived from the tables before the clock
starts. Every job writes its whole result to the ``noop`` sink or to files, and runs twice.
"""

from __future__ import annotations

import json
import os
import subprocess
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from foliant.checks import bindings as b  # noqa: E402
from foliant.operators.pages import extract_books  # noqa: E402
from foliant.operators.predicates import SearchSpec  # noqa: E402
from foliant.plans.catalog import build_catalog  # noqa: E402
from foliant.plans.crawl import build_queue, clean_books, triage_pages  # noqa: E402
from foliant.plans.novels import novel_isbns  # noqa: E402
from foliant.plans.search import lookup, scan_search, search, search_page, similar  # noqa: E402
from foliant.session import scratch, session  # noqa: E402
from foliant.sources import readers as r, writers as w  # noqa: E402

D = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def edition_dump(spark: SparkSession) -> DataFrame:
    """One dump line per line item; a third each are novels, non-novels, without subjects."""
    item = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    subjects = (
        F.when(item % 3 == 0, F.array(F.lit("Fantasy fiction"), F.col("p_name")))
        .when(item % 3 == 1, F.array(F.lit("Local history"), F.col("p_name")))
    )
    body = F.struct(
        F.array(b.isbn_of(item)).alias("isbn_13"),
        subjects.alias("subjects"),
        F.concat_ws(" ", "p_name", "p_brand").alias("title"),
        F.repeat(F.concat_ws(" ", "p_name", "p_type", "l_shipdate"), 5).alias("notes"),
    )
    items = b.table(spark, D, "lineitem").repartition(int(CPUS))
    rows = items.join(b.table(spark, D, "part"), F.col("l_partkey") == F.col("p_partkey"))
    key = F.concat(F.lit("/books/E"), item.cast("string"))
    return rows.select(
        F.concat_ws("\t", F.lit("/type/edition"), key, F.lit("1"), F.lit("2020-01-01"), F.to_json(body)).alias("value")
    )


def raw_books(spark: SparkSession) -> DataFrame:
    """One record per line item with text values; about a quarter of the ids repeat."""
    items = b.table(spark, D, "lineitem").repartition(int(CPUS))
    rows = items.join(b.table(spark, D, "part"), F.col("l_partkey") == F.col("p_partkey"))
    text = lambda c: F.col(c).cast("string")
    return rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("book_id"),
        F.col("p_name").alias("title"),
        F.concat_ws(" ", "p_brand", "p_type", "p_name", F.repeat("p_name", 20)).alias("description"),
        b.isbn_of("l_orderkey").alias("isbn"),
        text("l_quantity").alias("average_rating"),
        text("l_partkey").alias("ratings_count"),
        text("l_suppkey").alias("text_reviews_count"),
        F.year("l_shipdate").cast("string").alias("publication_year"),
        F.col("p_brand").alias("publisher"),
        F.lit("eng").alias("language_code"),
        F.when(F.col("p_size") % 2 == 0, "true").otherwise("false").alias("is_ebook"),
        F.array(F.struct(text("l_suppkey").alias("author_id"), F.lit("").alias("role"))).alias("authors"),
        F.transform(F.split("p_name", " "), lambda s: F.struct(F.lit("3").alias("count"), s.alias("name"))).alias("popular_shelves"),
        F.array(F.concat_ws("-", F.col("l_orderkey") + 1, F.lit(1)), F.lit("1-1")).alias("similar_books"),
    )


def megabytes(path: str) -> float:
    done = subprocess.run(["du", "-sk", path], capture_output=True, text=True, check=True)
    return int(done.stdout.split()[0]) / 1024


def main() -> None:
    spark = session(
        "bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false",
        spark__driver__memory="16g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    dump, raw, target = (scratch(spark, f"bench-{n}") for n in ("dump", "raw", "catalog"))
    edition_dump(spark).write.text(dump)
    w.append_books_json(raw_books(spark), raw)
    pages = scratch(spark, "bench-pages")
    b.crawled_pages(spark, D).repartition(int(CPUS)).write.parquet(pages)
    states = scratch(spark, "bench-states")
    b.state_pages(spark, D).repartition(int(CPUS)).write.parquet(states)
    n_records = spark.read.text(raw).count()

    run = lambda df: df.write.format("noop").mode("overwrite").save()
    catalog = lambda: r.load_catalog(spark, target)
    combined = SearchSpec(
        title_query="red w_dget", rating_min=10, publication_year_min=1996, publication_year_max=2000,
        is_ebook=True, shelf="widget", sort_by="rating", limit=10, offset=20,
    )
    jobs = {
        "dump_filter": lambda: run(novel_isbns(r.read_edition_dump(spark, dump))),
        "catalog_build": lambda: w.write_catalog(build_catalog(r.read_books_jsonl(spark, raw)), target),
        "search_combined": lambda: run(search(catalog(), combined)),
        "search_text": lambda: run(search(catalog(), SearchSpec(title_query="gizmo", sort_by="year"))),
        "search_rating": lambda: run(search(catalog(), SearchSpec(rating_min=45, sort_by="rating", limit=100))),
        "search_match_all": lambda: run(search(catalog(), SearchSpec())),
        "search_page_records": lambda: run(search_page(catalog(), combined)),
        "lookup_id": lambda: run(lookup(catalog(), "1000-1")),
        "scan_search": lambda: run(scan_search(r.read_books_jsonl(spark, raw), combined)),
        "similar_one_hop": lambda: run(similar(catalog(), catalog())),
        "extract_markup": lambda: run(extract_books(spark.read.parquet(pages))),
        "extract_state": lambda: run(extract_books(spark.read.parquet(states))),
        "triage_pages": lambda: run(triage_pages(spark.read.parquet(pages), order="pos")),
        "clean_books": lambda: run(clean_books(b.books(spark, D))),
        "resume_queue": lambda: run(
            build_queue(
                b.isbn_list(spark, D),
                b.order_sets(spark, D).select(F.col("isbn").alias("ISBN")),
                b.order_sets(spark, D),
            ).rows
        ),
    }
    # Every job runs twice: the first run also loads and compiles code.
    cold: dict[str, float] = {}
    times: dict[str, float] = {}
    for name, job in jobs.items():
        for taken in (cold, times):
            start = time.perf_counter()
            job()
            taken[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline jobs, second run of each",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "first_run": cold,
                "sf": D.rstrip("/").rsplit("sf", 1)[-1],
                "dump_mb_per_sec": round(megabytes(dump) / times["dump_filter"], 1),
                "catalog_books_per_sec": round(n_records / times["catalog_build"]),
                "scan_books_per_sec": round(n_records / times["scan_search"]),
                "dump_mb": round(megabytes(dump)),
                "raw_mb": round(megabytes(raw)),
                "records": n_records,
            }
        )
    )


if __name__ == "__main__":
    main()

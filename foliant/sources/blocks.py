"""An inverted index over blocks of the catalog: which blocks can hold what a search asks for.

A block is a run of rows of one file; files are sorted by ``book_id``, so a block is a
range of ids too, and a filter on ids makes the scan skip the pages outside it. Terms
are the trigrams of titles, descriptions and publishers, and the values of language, flag,
author and shelf. The posting list of a term is a bitmap over block numbers, cut into pieces of
32,768 bits. A search intersects the lists of all terms it needs, before the scan; the scan
then reads the blocks that are left and verifies every condition, so the result is
that of a search without the index.

Texts are folded as the search folds them. A part of a query text between wildcards
counts if it has three characters or more; a condition without such a part, and a search
without any condition the index knows, prunes nothing. Files that came after the index
are always read.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foliant.operators.predicates import SearchSpec
from foliant.plans.search import search

# Rows of a block; blocks that a search lists before it only names their files.
ROWS, RANGES = 4096, 256
TEXTS = ["title", "description", "publisher"]
VALUES = {"language_code": "language_code", "is_ebook": "is_ebook", "author": "author_ids", "shelf": "shelves"}
GRAM = 3


def _grams(chars: Column) -> Column:
    """The distinct trigrams of a list of characters."""
    triples = F.transform(
        F.arrays_zip(chars.alias("a"), F.slice(chars, 2, F.size(chars)).alias("b"), F.slice(chars, 3, F.size(chars)).alias("c")),
        lambda x: F.concat(x["a"], x["b"], x["c"]),
    )
    # The last two lack characters.
    return F.array_distinct(F.filter(triples, lambda g: g.isNotNull()))


def _characters(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), ""), lambda c: c != "")


def _terms(kind: str, values: Column) -> Column:
    return F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("term")))


def _blocks(spark: SparkSession, catalog: str, rows: int) -> DataFrame:
    """Catalog rows with the name of their file and their block in it."""
    place = (F.col("_metadata.row_index") / F.lit(rows)).cast("bigint")
    return spark.read.parquet(catalog).select("*", F.col("_metadata.file_name").alias("_file"), place.alias("_block"))


def write_block_index(spark: SparkSession, catalog: str, index: str, rows: int = ROWS, mode: str = "error") -> None:
    """Index the stored catalog: ``blocks`` (number, file, range of ids) and ``postings``."""
    placed = _blocks(spark, catalog, rows)
    blocks = placed.groupBy("_file", "_block").agg(F.min("book_id").alias("low"), F.max("book_id").alias("high"))
    # Files are few: each one's first number follows from the sizes of those before it.
    sizes = blocks.groupBy("_file").agg((F.max("_block") + 1).alias("n")).orderBy("_file").collect()
    firsts, at = [], 0
    for r in sizes:
        firsts.append((r["_file"], at))
        at += r["n"]
    first = F.broadcast(spark.createDataFrame(firsts, "_file string, _first bigint"))
    number = (F.col("_first") + F.col("_block")).alias("block")
    named = blocks.join(first, "_file").select(number, F.col("_file").alias("file"), "low", "high")
    named.orderBy("block").write.mode(mode).parquet(f"{index}/blocks")
    chars = placed.join(first, "_file").select(number, *VALUES.values(), *[_characters(F.col(c)).alias(c) for c in TEXTS])
    kinds = [_terms(c, _grams(F.col(c))) for c in TEXTS]
    for kind, column in VALUES.items():
        value = F.col(column)
        kinds.append(_terms(kind, value if kind in ("author", "shelf") else F.array(value.cast("string"))))
    found = chars.select("block", F.inline(F.concat(*kinds))).where("term IS NOT NULL").distinct()
    # Positions count from one.
    position = F.col("block") + 1
    lists = found.groupBy("kind", "term", F.bitmap_bucket_number(position).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(position)).alias("bits")
    )
    lists.repartitionByRange("kind", "term").sortWithinPartitions("kind", "term").write.mode(mode).parquet(f"{index}/postings")


def clauses(spec: SearchSpec) -> list[list[tuple[str, list[str]]]]:
    """What a search needs of a block: of each clause one alternative, of that every text or value."""
    parts = lambda text: [p for p in re.split("[%_]", text) if len(p) >= GRAM]
    found = []
    if spec.title_query and parts(spec.title_query):
        found.append([(column, parts(spec.title_query)) for column in ("title", "description")])
    if spec.publisher_query and parts(spec.publisher_query):
        found.append([("publisher", parts(spec.publisher_query))])
    if spec.language_code:
        found.append([("language_code", [spec.language_code])])
    if spec.is_ebook is not None:
        found.append([("is_ebook", [str(spec.is_ebook).lower()])])
    if spec.author_id:
        found.append([("author", [str(spec.author_id)])])
    if spec.shelf:
        found.append([("shelf", [spec.shelf.lower()])])
    return found


def candidate_blocks(spark: SparkSession, index: str, spec: SearchSpec) -> DataFrame | None:
    """(block, file, low, high) of the blocks that can hold a match; None if the index cannot tell."""
    wanted = clauses(spec)
    if not wanted:
        return None
    rows = [(n, m, kind, value) for n, clause in enumerate(wanted) for m, (kind, values) in enumerate(clause) for value in values]
    asked = spark.createDataFrame(rows, "clause int, way int, kind string, value string")
    asked = asked.select("clause", "way", "kind", "value", _characters(F.col("value")).alias("chars"))
    grams = F.when(F.col("kind").isin(TEXTS), _grams(F.col("chars"))).otherwise(F.array("value"))
    # As large as the query; its terms become a pushed filter.
    terms = asked.select("clause", "way", "kind", F.explode(grams).alias("term")).distinct().collect()
    names = sorted({t["term"] for t in terms})
    asked = F.broadcast(spark.createDataFrame(terms, "clause int, way int, kind string, term string"))
    lists = spark.read.parquet(f"{index}/postings").where(F.col("term").isin(names)).join(asked, ["kind", "term"])
    needed = F.broadcast(spark.createDataFrame(terms, "clause int, way int, kind string, term string").groupBy("clause", "way").agg(F.count(F.lit(1)).alias("needed")))
    ways = lists.groupBy("clause", "way", "piece").agg(F.count(F.lit(1)).alias("n"), F.bitmap_and_agg("bits").alias("bits"))
    ways = ways.join(needed, ["clause", "way"]).where("n = needed")
    either = ways.groupBy("clause", "piece").agg(F.bitmap_or_agg("bits").alias("bits"))
    both = either.groupBy("piece").agg(F.count(F.lit(1)).alias("n"), F.bitmap_and_agg("bits").alias("bits")).where(F.col("n") == len(wanted))
    # Bytes as numbers, then the bits that are set in each.
    bytes_ = F.transform(F.sequence(F.lit(0), F.length("bits") - 1), lambda i: F.struct(i.alias("i"), F.conv(F.hex(F.substring(F.col("bits"), i + 1, F.lit(1))), 16, 10).cast("int").alias("b")))
    set_ = both.select("piece", F.inline(F.filter(bytes_, lambda x: x["b"] > 0)))
    bit = F.explode(F.filter(F.sequence(F.lit(0), F.lit(7)), lambda k: F.call_function("shiftright", F.col("b"), k).bitwiseAND(F.lit(1)) == 1))
    numbers = set_.select("piece", "i", bit.alias("k")).select(((F.col("piece") - 1) * 32768 + F.col("i") * 8 + F.col("k")).cast("bigint").alias("block"))
    return spark.read.parquet(f"{index}/blocks").join(numbers, "block").select("block", "file", "low", "high")


def restricted(spark: SparkSession, catalog: str, index: str, spec: SearchSpec, ranges: int = RANGES) -> DataFrame:
    """The catalog without blocks that cannot hold a match of ``spec``.

    Names of files pass through the driver, which lists them for any scan, and up to
    ``ranges`` ranges of ids; where more blocks are left only whole files are skipped.
    """
    whole = spark.read.parquet(catalog)
    blocks = candidate_blocks(spark, index, spec)
    if blocks is None:
        return whole
    files = blocks.groupBy("file").agg(F.count(F.lit(1)).alias("n")).collect()
    indexed = {r["file"] for r in spark.read.parquet(f"{index}/blocks").select("file").distinct().collect()}
    left = {r["file"] for r in files}
    name = lambda path: path.rsplit("/", 1)[-1]
    paths = [p for p in whole.inputFiles() if name(p) in left or name(p) not in indexed]
    if not paths:
        return whole.where(F.lit(False))
    rows = spark.read.schema(whole.schema).parquet(*paths)
    if any(name(p) not in indexed for p in paths) or sum(r["n"] for r in files) > ranges:
        return rows
    spans: list[list] = []
    for r in blocks.orderBy("block").collect():
        if spans and spans[-1][0] == r["block"] - 1 and spans[-1][2] <= r["low"]:
            spans[-1][0], spans[-1][2] = r["block"], r["high"]
        else:
            spans.append([r["block"], r["low"], r["high"]])
    return rows.where(reduce(or_, [F.col("book_id").between(low, high) for _, low, high in spans]))


def search_blocks(spark: SparkSession, catalog: str, index: str, spec: SearchSpec) -> DataFrame:
    """``search`` of the stored catalog, through its index."""
    return search(restricted(spark, catalog, index, spec), spec)

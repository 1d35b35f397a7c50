"""The corpus pipeline: quality rules, near-duplicates, pseudonyms, mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliant.llm.common import materialize, table
from foliant.llm.mixing import mix
from foliant.llm.packing import pack
from foliant.llm.pii import mask
from foliant.llm.quality import keep_good
from foliant.llm.simhash import keep_one

# Each stage takes the session, what the stage before it kept, and the folder of the tables.
STAGES = [
    ("quality rules", lambda spark, docs, sf_dir: keep_good(docs)),
    ("near-duplicates", lambda spark, docs, sf_dir: keep_one(docs)),
    ("pseudonyms", lambda spark, docs, sf_dir: mask(docs)),
    ("source mix", lambda spark, docs, sf_dir: mix(docs)),
    ("packing", lambda spark, docs, sf_dir: pack(docs)),
]
# Pseudonyms and token ids are nothing SQL can express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

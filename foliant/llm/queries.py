"""One query per operator, over its whole table, next to the SQL that must agree with it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliant.llm import chat, lexical, licenses, mixing, quality, topk
from foliant.llm.common import table
from foliant.llm.packing import pack
from foliant.llm.pii import pii
from foliant.llm.repeats import repeats_digest
from foliant.llm.simhash import simhash_components
from foliant.llm.toxicity import toxicity
from foliant.llm.whitening import whiten
from foliant.llm.wrappers import main_texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": lambda spark, d: chat.chat(table(spark, d, "conversations")),
    "op2_license_scan": lambda spark, d: licenses.license_scan(table(spark, d, "documents")),
    "op3_exact_top_k": lambda spark, d: topk.top_k(table(spark, d, "embeddings")),
    "op4_best_fit_packing": lambda spark, d: pack(table(spark, d, "documents")),
    "op5_source_mix": lambda spark, d: mixing.mix_plan(table(spark, d, "documents")),
    "op6_simhash_components": lambda spark, d: simhash_components(table(spark, d, "documents")),
    "op7_quality_rules": lambda spark, d: quality.quality(table(spark, d, "documents")),
    "op8_toxicity": lambda spark, d: toxicity(table(spark, d, "documents"), table(spark, d, "labels")),
    "op9_pseudonyms": lambda spark, d: pii(table(spark, d, "documents")),
    "op10_main_text": lambda spark, d: main_texts(table(spark, d, "pages")),
    "op11_whitening": lambda spark, d: whiten(table(spark, d, "embeddings")),
    "op12_ranked_search": lambda spark, d: lexical.search(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op13_repeats": lambda spark, d: repeats_digest(table(spark, d, "documents")),
}

ORACLES: dict[str, str] = {
    "op1_chat_format": chat.SQL,
    "op2_license_scan": licenses.SQL,
    "op3_exact_top_k": topk.SQL,
    "op5_source_mix": mixing.SQL,
    "op7_quality_rules": quality.SQL,
    "op12_ranked_search": lexical.SQL,
}

"""Corpus pipeline over ``documents``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardenlake.llm import decontamination, language_id, line_dedup, near_dedup, packing
from wardenlake.llm.catalog import TOKENIZER
from wardenlake.llm.shared import keep, prepare, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence stay; empty texts and texts without letters go."""
    prepare(spark)
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text", "lang", "source")
    return language_id.identify_documents(rows).where("accepted").select("row.*")


def without_templates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur across documents are cut; every document stays."""
    prepare(spark)
    return line_dedup.drop_recurring_lines(docs)


def near_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles, similarity 0.8)."""
    prepare(spark)
    return near_dedup.drop_near_duplicates(docs, width=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, unchanged or with other parameters, go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences of at most 2048 tokens."""
    prepare(spark)
    return packing.pack(docs, TOKENIZER, packing.Capacity(tokens=2048))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("line_dedup", without_templates),
    ("near_dedup", near_documents),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: No SQL: the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the documents of the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Registered queries of the operators, with production parameters over whole tables, and their SQL texts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import chat, decontamination, language_id, lexical_search, line_dedup, near_dedup, packing, phrases, substring_dedup, token_counts, token_files, topk_search, warc
from .shared import table

#: Tokenizer of the token queries; every operator takes the path as a parameter.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_documents(table(spark, sf_dir, "documents")).select("doc_id", "language", "posterior", "accepted")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator over web pages, with markup and the hierarchy of addresses as evidence."""
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id as id", "text", "lang as language")
    return language_id.identify_pages(table(spark, sf_dir, "pages"), language_id.fit_text_model(docs))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), TOKENIZER, limit=1024)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_paragraphs(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.recurring_lines(table(spark, sf_dir, "documents")).drop("text_key")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, packing.Capacity(tokens=2048))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.search(table(spark, sf_dir, "embeddings"), k=10, every=20)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = token_files.write_ids(docs, TOKENIZER)
    return token_files.read_ids(files, token_files.places(files), digest=True)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_records(warc.write_archives(table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), least=100, inside=100, top=2000)


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.windows(turns.union(chat.awkward_conversation(spark)), budget=1024, history=128))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build_index(table(spark, sf_dir, "documents"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"), k=50)


_QUERIES = [
    op1_language_id, op2_token_counts, op3_substring_dedup, op4_line_dedup, op5_near_dedup, op6_packing, op7_decontamination,
    op8_topk_search, op9_token_files, op10_warc, op11_phrases, op12_chat_formatting, op13_lexical_search, language_id_pages,
]

_ORACLE = {
    "op4_line_dedup": line_dedup.SQL, "op8_topk_search": topk_search.SQL, "op10_warc": warc.SQL, "op11_phrases": phrases.SQL,
    "op12_chat_formatting": chat.SQL, "op13_lexical_search": lexical_search.SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)

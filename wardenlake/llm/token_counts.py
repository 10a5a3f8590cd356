"""Token counts with the whole-token shortcut."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_batches
from .units import Counter, SentencePieceCounter, prove_whole_tokens

_COUNTERS: dict[str, object] = {}


def _counter(path: str, whole_tokens: list[str]):
    """One counter per worker process and tokenizer, so that its memory of merged pieces serves all its tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = SentencePieceCounter(path) if path.endswith(".model") else Counter(path, whole_tokens)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs(doc_id, text)``.

    ``tokenizer`` is a .json file of the tokenizers library or a .model file of sentencepiece that every executor
    can open. Counts equal the library's for the whole text, without begin, end or added special tokens; strings of special
    tokens inside a text are handled as the library does by default. ``limit``: ``over_limit`` is n_tokens > limit.

    The whole-token table is proven on the driver (bounded by the vocabulary) and sent to the tasks once. Null texts
    read as empty and count 0. Repeated rows and null doc_ids give one row each. Other columns are not read; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    proven = [] if tokenizer.endswith(".model") else prove_whole_tokens(tokenizer)
    shared = spark.sparkContext.broadcast(proven)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer, shared.value)
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            numbers = pa.array(counter.count(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, numbers], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = map_batches(rows, count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

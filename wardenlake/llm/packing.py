"""Vector best-fit packing of tokenised documents into sequences.

A piece asks for tokens, one document place and attention cost (its length squared). All three follow from its length,
so pieces of one length are alike and the whole corpus is described by a histogram with at most ``capacity`` entries.
The bins are chosen from that histogram alone: sequences with the same residuals form one group, and a group takes as many
pieces of a length at once as it has sequences. The plan is bounded by the capacity, not by the corpus; the pieces look up
their places by length and rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import keep, map_batches
from .units import Encoder

_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and tokenizer."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


@dataclass(frozen=True)
class Capacity:
    """Capacities of a sequence: tokens, documents, and attention cost (sum of squared piece lengths).

    By default only the tokens bind: a sequence of at most ``tokens`` tokens never holds more than that many pieces nor
    costs more than their square. ``rule``: "norm" takes the bin with the smallest weighted residual after the piece,
    "dot" the one with the largest weighted dot product of residual and piece.
    """

    tokens: int = 2048
    documents: int | None = None
    cost: int | None = None
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)
    rule: str = "norm"

    def vector(self) -> tuple[int, int, int]:
        return (self.tokens, self.documents or self.tokens, self.cost or self.tokens**2)


def plan_bins(histogram: dict[int, int], capacity: Capacity) -> tuple[dict[int, tuple[list[int], list[int], list[int]]], int]:
    """Places of all pieces, and the number of sequences.

    ``histogram``: number of pieces of every length. Result per length: first rank, first sequence and offset of runs;
    the piece of rank r in a run lies in sequence ``first sequence + r - first rank`` at that offset. Lengths are taken
    in falling order. A length that fits no empty sequence raises ValueError.
    """
    full = capacity.vector()
    scale = np.array(capacity.weights) / np.array(full, float) ** 2
    groups: dict[tuple[int, int, int], list[tuple[int, int]]] = {}  # residuals -> intervals of sequences
    used, plan = 0, {}
    for length in sorted(histogram, reverse=True):
        ask, left, rank = (length, 1, length * length), histogram[length], 0
        if any(a > f for a, f in zip(ask, full, strict=True)):
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        runs: tuple[list[int], list[int], list[int]] = ([], [], [])

        def put(first: int, count: int, residual: tuple[int, int, int]) -> None:
            nonlocal rank
            for column, value in zip(runs, (rank, first, full[0] - residual[0]), strict=True):
                column.append(value)
            rank += count
            after = tuple(r - a for r, a in zip(residual, ask, strict=True))
            groups.setdefault(after, []).append((first, first + count))

        while left:
            states = [s for s in groups if all(r >= a for r, a in zip(s, ask, strict=True))]
            if not states:
                break
            residuals, piece = np.array(states, float), np.array(ask, float)
            if capacity.rule == "dot":
                score = -(residuals * piece * scale).sum(axis=1)
            else:
                score = ((residuals - piece) ** 2 * scale).sum(axis=1)
            best = states[int(score.argmin())]
            intervals = groups[best]
            first, end = intervals.pop()
            take = min(left, end - first)
            if first + take < end:
                intervals.append((first + take, end))
            if not intervals:
                del groups[best]
            put(first, take, best)
            left -= take
        if left:  # new sequences, each filled with as many pieces of this length as fit
            each = min(f // a for f, a in zip(full, ask, strict=True))
            whole, rest = divmod(left, each)
            for count, depth in ((whole, each), (1 if rest else 0, rest)):
                for step in range(depth if count else 0):
                    residual = tuple(f - step * a for f, a in zip(full, ask, strict=True))
                    if step:
                        groups[residual].remove((used, used + count))
                        if not groups[residual]:
                            del groups[residual]
                    put(used, count, residual)
                used += count
        plan[length] = runs
    return plan, used


def pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """(part, rank, doc_id, piece, start, length, ids_crc32[, ids]) of the token ids of every row, ``end_id`` added.

    Only documents longer than ``size`` are cut, into pieces of ``size`` ids of which the first may be shorter. ``rank``
    numbers the pieces of one length inside a part of the input.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer).encode, TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            first, ids = encode(batch.column(1))
            for doc_id, a, b in zip(batch.column(0).to_pylist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                whole = np.append(ids[a:b], np.uint32(end_id)).astype("<u4").tobytes()
                total = len(whole) // 4
                bounds = [0, *range(total % size or size, total + 1, size)]
                for number, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    raw = whole[4 * lo : 4 * hi]
                    values = (part, int(seen[hi - lo]), doc_id, number, lo, hi - lo, zlib.crc32(raw), raw)
                    seen[hi - lo] += 1
                    for column, value in zip(rows, values, strict=False):
                        column.append(value)
            arrays = [pa.array(v, t) for v, t in zip(rows, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["part", "rank", "doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * keep_ids
    schema = "part int, rank long, doc_id long, piece int, start long, length long, ids_crc32 long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(rows, cut, schema + ", ids binary" * keep_ids)


def pack(docs: DataFrame, tokenizer: str, capacity: Capacity = Capacity(), end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) of every piece of ``docs(doc_id, text)``.

    ``offset`` is the place in the sequence, gapless from 0. ``keep_ids`` adds the ids as little-endian unsigned 32-bit
    bytes; ``sequences`` puts them together.

    Null or empty texts are one piece that holds the end id. Repeated rows and null doc_ids are packed like any other row.
    Other columns are not read. An empty table gives no rows. Documents longer than ``capacity.tokens`` are cut; a
    piece that breaks another capacity alone raises ValueError.
    """
    spark = docs.sparkSession
    made = keep(pieces(docs, tokenizer, capacity.tokens, end_id, keep_ids), "pieces")
    counts = made.groupBy("length", "part").agg(F.count(F.lit(1)).alias("number"))
    before = F.sum("number").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = keep(counts.withColumn("before", F.coalesce(before, F.lit(0))), "counts")
    histogram = {r["length"]: r["number"] for r in counts.groupBy("length").agg(F.sum("number").alias("number")).collect()}
    plan, _ = plan_bins(histogram, capacity)
    shared = spark.sparkContext.broadcast(plan)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        for batch in batches:
            sequence, offset = [], []
            for length, rank in zip(batch.column("length").to_pylist(), batch.column("rank").to_pylist(), strict=True):
                ranks, firsts, offsets = runs[length]
                run = bisect_right(ranks, rank) - 1
                sequence.append(firsts[run] + rank - ranks[run])
                offset.append(offsets[run])
            kept = [batch.column(n) for n in names[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names)

    carried = ["ids"] * keep_ids + ["doc_id", "piece", "start", "length", "ids_crc32"]
    names = [*carried, "sequence_id", "offset"]
    ranked = made.join(counts.select("length", "part", "before"), ["length", "part"])
    ranked = ranked.select(*carried, (F.col("rank") + F.col("before")).alias("rank"))
    schema = "ids binary, " * keep_ids + "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    placed = map_batches(ranked, place, schema)
    return placed.select(*names[keep_ids:], *["ids"] * keep_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, doc_ids, ids) from ``pack(..., keep_ids=True)``. A sequence is bounded by its capacity."""
    order = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids", "length")))
    rows = packed.groupBy("sequence_id").agg(order.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    total = F.aggregate("parts", F.lit(0).cast("long"), lambda done, part: done + part["length"])
    return rows.select("sequence_id", total.alias("n_tokens"), F.col("parts.doc_id").alias("doc_ids"), joined.alias("ids"))

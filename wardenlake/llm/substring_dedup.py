"""Removal of passages that repeat across documents: MinHash banding of paragraphs, exact check, components.

Two sizes of paragraphs are compared. Lines are banded by MinHash and confirmed by exact Jaccard similarity, so a changed
line is found as well. Sentences (a line cut behind a full stop, and behind words that a hash of the word selects if
it has no full stops) are matched whole. Stretches of ``STRETCH`` words, of which the one with the least hash among
``NEIGHBOURS`` neighbouring ones is taken, depend on their own words only, so a passage that was pasted into the middle of
a line is found wherever its copies begin and end. Neighbouring repeated paragraphs of a document form a run; runs of
at least ``LEAST_WORDS`` words count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import shingles as sh
from .jaccard import similar
from .shared import keep, map_batches, small

#: Words of a shingle, similarity in percent, and the bands: a pair of lines at 0.8 shares no key with a probability of 4e-4.
WIDTH, PERCENT = 5, 80
BANDS = sh.Bands(bands=12, rows=3, both=False)

#: Least words of a line that is banded, and of a run that is removed.
LINE_WORDS, LEAST_WORDS = 20, 20

#: Words of a stretch, and neighbouring stretches of which one is taken. Any common run of ``STRETCH + NEIGHBOURS - 1`` words
#: shares a stretch. The first and the last that a longer run shares lie at most ``NEIGHBOURS - 1`` words from its ends and
#: those between overlap, so common runs of 50 words give runs of at least ``LEAST_WORDS``.
STRETCH, NEIGHBOURS = 20, 16

#: A sentence longer than this is cut behind words whose hash is divisible by ``CUT_EVERY``.
LONG_SENTENCE, CUT_EVERY = 30, 8

SENTENCES = "doc_id long, start int, words int, key long, stretch boolean"


def _ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per word of the rows: whether a sentence ends behind it."""
    body = ~sh._SEPARATOR[data]
    row_end = np.zeros(len(data) + 1, bool)
    row_end[offsets[1:]] = True
    close = body.copy()
    close[:-1] &= ~body[1:] | row_end[1 : len(data)]
    at = np.flatnonzero(close)  # last byte of every word
    stop = np.isin(data, np.frombuffer(b".!?", np.uint8))
    newline = np.append(data == 0x0A, True)
    # the word ends a line if a newline comes before the next word or row end
    following = np.append(at[1:], len(data))
    lines = np.concatenate([[0], np.cumsum(newline)])
    ends_line = lines[following + 1 if len(data) else following] > lines[at + 1] if len(at) else np.zeros(0, bool)
    return stop[at] | ends_line | row_end[at + 1]


_ODD, _TURN = 0x9E3779B97F4A7C15, np.uint64(0xC2B2AE3D27D4EB4F)


def _stretches(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words and keys of the chosen stretches of all rows; rows of fewer words than a stretch have none."""
    count = np.maximum(np.diff(first) - STRETCH + 1, 0)
    row = np.repeat(np.arange(len(count)), count)
    if not len(row):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    begin = np.cumsum(count) - count
    at = np.arange(len(row)) - begin[row] + first[row]
    # hashes of stretches from running sums of words times powers; the power of the place is taken out again
    size = len(hashes)
    up, down = np.full(size, _ODD, np.uint64), np.full(size, pow(_ODD, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    up, down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up, dtype=np.uint64)])
    value = sh.mix((sums[at + STRETCH] - sums[at]) * down[at])
    # place of the least value among the neighbours from every place on, by doubling; windows end with their row
    last = begin + count - 1
    least, span = np.arange(len(row)), 1
    while span < NEIGHBOURS:
        step = min(span, NEIGHBOURS - span)
        other = least[np.minimum(np.arange(len(row)) + step, last[row])]
        least = np.where(value[other] < value[least], other, least)
        span += step
    full = np.arange(len(row)) <= np.maximum(last - NEIGHBOURS + 1, begin)[row]
    chosen = np.unique(least[full])
    return at[chosen], sh.mix(value[chosen] ^ _TURN)


def sentences(docs: DataFrame) -> DataFrame:
    """(doc_id, start, words, key, stretch) of the sentences and the chosen stretches of every row of ``docs(doc_id, text)``:
    first word, number of words, a hash of its words (A-Z lower-cased) and whether it is a stretch."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, first = sh.words(batch.column(1))
            if not len(hashes):
                continue
            data, offsets = sh.buffers(batch.column(1))
            base = offsets[0]
            end = _ends(data[base : offsets[-1]], offsets - base)
            row = np.repeat(np.arange(len(first) - 1), np.diff(first))
            # number of words since the sentence began, to cut long ones by content
            number = np.concatenate([[0], np.cumsum(end)[:-1]])
            heads = np.flatnonzero(np.concatenate([[True], end[:-1]]))
            length = np.diff(np.append(heads, len(hashes)))
            end |= (length[number] > LONG_SENTENCE) & (hashes % np.uint64(CUT_EVERY) == 0)
            heads = np.flatnonzero(np.concatenate([[True], end[:-1]]))
            length = np.diff(np.append(heads, len(hashes)))
            place = np.arange(len(hashes)) - np.repeat(heads, length)
            key = sh.mix(np.add.reduceat(sh.mix(hashes + (place.astype(np.uint64) + np.uint64(1)) * sh._BASE), heads) + length.astype(np.uint64))
            places, keys = _stretches(hashes, first)
            stretch = np.repeat([False, True], [len(heads), len(places)])
            heads, key = np.concatenate([heads, places]), np.concatenate([key, keys])
            length = np.concatenate([length, np.full(len(places), STRETCH, length.dtype)])
            ids = batch.column(0).take(pa.array(row[heads]))
            start = heads - first[row[heads]]
            arrays = [ids, pa.array(start, pa.int32()), pa.array(length, pa.int32()), pa.array(key.view(np.int64)), pa.array(stretch)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "words", "key", "stretch"])

    return map_batches(docs.select("doc_id", "text"), cut, SENTENCES)


def lines(docs: DataFrame, least: int = LINE_WORDS) -> DataFrame:
    """(doc_id, start, words, text) of the lines with at least ``least`` words; ``start`` is the first word."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at = 0
                for line in (text or "").split("\n"):
                    parts = line.translate(_SPACES).split(" ")
                    count = len(parts) - parts.count("")
                    if count >= least:
                        for column, value in zip(out, (doc_id, at, count, line), strict=True):
                            column.append(value)
                    at += count
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], ["doc_id", "start", "words", "text"])

    return map_batches(docs.select("doc_id", "text"), cut, "doc_id long, start int, words int, text string")


_SPACES = {0x09: " ", 0x0A: " ", 0x0B: " ", 0x0C: " ", 0x0D: " "}


def repeated_paragraphs(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, start, words, keeper_doc_id, keeper_start, cluster) of the runs that repeat an earlier document.

    ``start`` and ``words`` count the words (runs without white space) of the text; ``keeper_*`` is a paragraph of the
    smallest doc_id that holds the same passage, which keeps it. ``cluster`` is the same for all copies of the run's first
    paragraph. Repetitions inside one document do not count.

    Null or empty texts hold nothing. Rows without doc_id are left out (their removals could not be named); rows that
    repeat a doc_id are one document with both texts, equal paragraphs at one place count once. Other columns are not
    read; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")

    # sentences that occur in several documents; a sentence that very many hold is one row per task before the shuffle
    pieces = sentences(rows)
    spread = pieces.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last")
    spread = small(keep(spread.select("key", "first"), "repeated-sentences"))
    same = keep(pieces.join(spread, "key"), "sentences")
    keepers = same.where("doc_id = first").groupBy("key").agg(F.min("start").alias("keeper_start"))
    same = same.join(small(keep(keepers, "keepers")), "key")
    same = same.select("doc_id", "start", "words", F.col("first").alias("keeper"), "keeper_start", F.col("key").alias("cluster"), "stretch")

    # lines that are similar to lines of other documents; every line is numbered as it is written, so that no text is shuffled
    named = keep(lines(rows).withColumn("id", F.monotonically_increasing_id()), "lines")
    groups = keep(similar(named, WIDTH, PERCENT, BANDS).select("id", "component"), "line-groups")
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("component")
    placed = named.select("id", "doc_id", "start", "words").join(groups.join(sizes, "component"), "id")
    placed = keep(placed, "line-members")
    first = placed.groupBy("component").agg(
        F.min(F.struct("doc_id", "start")).alias("first"), F.max("doc_id").alias("last"), F.min(F.xxhash64("doc_id", "start")).alias("cluster")
    )
    first = first.where("first.doc_id <> last")
    alike = placed.join(small(keep(first, "line-keepers")), "component").select(
        "doc_id", "start", "words", F.col("first.doc_id").alias("keeper"), F.col("first.start").alias("keeper_start"), "cluster",
        F.lit(False).alias("stretch"),
    )

    # runs of neighbouring repeated paragraphs that an earlier document keeps
    found = same.union(alike).where("doc_id <> keeper").distinct()
    found = found.withColumn("end", F.col("start") + F.col("words"))
    order = Window.partitionBy("doc_id").orderBy("start", "end", "keeper", "keeper_start", "cluster")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    found = found.withColumn("fresh", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int"))
    found = found.withColumn("run", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # which stretches are taken at the ends of a passage depends on the words around it, so the smallest doc_id that holds
    # the passage may keep only the next stretch
    found = found.withColumn("begin", F.min("start").over(Window.partitionBy("doc_id", "run")))
    leads = (F.col("start") == F.col("begin")) | (F.col("stretch") & (F.col("start") < F.col("begin") + NEIGHBOURS))
    head = F.min(F.when(leads, F.struct("keeper", "keeper_start", "cluster")))
    runs = found.groupBy("doc_id", "run", "begin").agg(head.alias("head"), F.max("end").alias("end"))
    runs = runs.select(
        "doc_id", F.col("begin").alias("start"), (F.col("end") - F.col("begin")).alias("words"),
        F.col("head.keeper").alias("keeper_doc_id"), F.col("head.keeper_start").alias("keeper_start"), F.col("head.cluster").alias("cluster"),
    )
    return runs.where(F.col("words") >= least_words)


def drop_repeated(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with the repeated runs cut out of the texts, words joined as they stood. No row is dropped."""
    runs = repeated_paragraphs(docs, least_words)
    spans = runs.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "words"))).alias("spans"))
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    joined = rows.join(small(keep(spans, "spans")), F.col("row.doc_id").cast("long") == F.col("doc_id"), "left")

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([cut_words(t, s) if t is not None and s else t for t, s in zip(texts.to_pylist(), spans.to_pylist(), strict=True)], pa.string())

    return joined.select(F.col("row").withField("text", cut("row.text", "spans")).alias("row")).select("row.*")


def cut_words(text: str, spans: list[dict]) -> str:
    """The text without the given spans of words and the white space behind them."""
    bounds, at = [], 0
    for word in text.translate(_SPACES).split(" "):
        if word:
            bounds.append(at)
        at += len(word) + 1
    bounds.append(len(text))
    out, done = [], 0
    for span in spans:
        out.append(text[done : bounds[min(span["start"], len(bounds) - 1)]])
        done = bounds[min(span["start"] + span["words"], len(bounds) - 1)]
    return "".join(out) + text[done:]

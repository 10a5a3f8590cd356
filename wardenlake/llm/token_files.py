"""Token-id files with a minimal perfect hash index.

``write_ids`` makes a folder of shards and index segments:

* A shard holds the raw ids of documents in ascending doc_id order, little-endian, in 2 bytes each if the vocabulary
  fits and else in 4, and nothing else. Shard numbers follow the order of the ids over all shards.
* A segment holds a minimal perfect hash of the document keys that fall to it, and one entry per key at the place
  the hash gives: fingerprint, shard, offset and length. A key costs a few bits beside its entry and a look-up reads one
  place whatever the number of keys. The hash is built in levels: a key that is alone on its bit is settled and its
  place is the number of set bits before it, the others go to the next level.

Everything is built by tasks that write one file each; the committed file tables name the files that count.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .packing import encoder
from .shared import attempt_name, fresh_folder, keep, map_batches, shuffle_parts, small, store
from .shingles import mix

#: Keys of one index segment on average, bits per open key of a level, and levels before the last keys are listed.
SEGMENT_KEYS, SPACE, LEVELS = 100_000, 2, 24

#: Bytes of text of one shard on average; a task holds and sorts the texts of one shard.
SHARD_TEXT = 32 * 1024 * 1024

#: Bytes that one read of a shard takes at most, unless a document alone is longer.
READ_BYTES = 8 * 1024 * 1024

ENTRY = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("length", "<u8")])
U64 = np.uint64


def key_hash(doc_ids: np.ndarray, seed: int) -> np.ndarray:
    return mix(doc_ids.astype(np.int64).view(np.uint64) * U64(0x9E3779B97F4A7C15) + U64(seed * 2 + 1))


def segment_of(doc_ids: np.ndarray, segments: int) -> np.ndarray:
    return (key_hash(doc_ids, 1001) % U64(segments)).astype(np.int64)


def fingerprint(doc_ids: np.ndarray) -> np.ndarray:
    return (key_hash(doc_ids, 2003) >> U64(32)).astype(np.uint32)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        self.sizes = [8 * len(level) for level in levels]
        self.starts = np.concatenate([[0], np.cumsum([int(np.bitwise_count(level).sum()) for level in levels])]).astype(np.int64)
        self.before = [np.concatenate([[0], np.cumsum(np.bitwise_count(level), dtype=np.int64)]) for level in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys) and len(levels) < LEVELS:
            size = max(64, -(-len(keys) * SPACE // 64) * 64)
            at = (key_hash(keys, len(levels)) % U64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            keys = keys[~alone[at]]
        return cls(levels, np.sort(keys.astype(np.int64)))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Place of every key; a key that was not in the set gets some place or -1."""
        out, open_at = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for number, level in enumerate(self.levels):
            at = (key_hash(keys[open_at], number) % U64(self.sizes[number])).astype(np.int64)
            byte, bit = level[at >> 3].astype(np.int64), at & 7
            hit = (byte >> bit) & 1 == 1
            inside = np.bitwise_count((byte & ((1 << bit) - 1)).astype(np.uint8))
            out[open_at[hit]] = (self.starts[number] + self.before[number][at >> 3] + inside)[hit]
            open_at = open_at[~hit]
        if len(open_at) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[open_at]), len(self.rest) - 1)
            hit = self.rest[at] == keys[open_at]
            out[open_at[hit]] = self.starts[-1] + at[hit]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), len(self.rest), *[len(level) for level in self.levels]], "<u8").tobytes()
        return head + b"".join(level.tobytes() for level in self.levels) + self.rest.astype("<i8").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> tuple[PerfectHash, int]:
        """The hash and the number of bytes it took."""
        count, rest = np.frombuffer(raw, "<u8", 2).tolist()
        sizes = np.frombuffer(raw, "<u8", count, 16).tolist()
        at, levels = 16 + 8 * count, []
        for size in sizes:
            levels.append(np.frombuffer(raw, np.uint8, size, at))
            at += size
        return cls(levels, np.frombuffer(raw, "<i8", rest, at)), at + 8 * rest


def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a task in the order of doc_id and text, nulls first, in batches of the size that came."""
    held = list(batches)
    if held:
        rows = pa.Table.from_batches(held)
        order = pc.sort_indices(rows, [("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start")
        step = held[0].num_rows
        held.clear()
        for at in range(0, len(order), step):
            yield from rows.take(order.slice(at, step)).combine_chunks().to_batches()


@dataclass(frozen=True)
class TokenFiles:
    """A written folder: ``documents(doc_id, ordinal, shard, offset, length)`` is the committed list of the
    writers, ``shards(shard, path, base)`` and ``segments(segment, path, keys)`` name the files."""

    shards: DataFrame
    segments: DataFrame
    documents: DataFrame
    segment_count: int
    width: int


def write_ids(docs: DataFrame, tokenizer: str, end_id: int = 0, parts: int | None = None) -> TokenFiles:
    """Write the ids of every row of ``docs(doc_id, text)``, ``end_id`` added, in ascending doc_id order.

    Null texts read as empty. Rows without doc_id come first and have no key, so only the list of the writers
    names them; rows that repeat a doc_id follow each other in the order of their texts and the key leads to the
    first of them. Other columns are not read. An empty table gives no files and empty tables.
    """
    spark = docs.sparkSession
    folder = fresh_folder(spark, "token-files")
    width = 2 if encoder(tokenizer).tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(tokenizer).encode, TaskContext.get().partitionId()
        system, path = store(folder)
        name = attempt_name("ids", shard, ".bin")
        done, last, ordinal, out = 0, None, 0, None
        try:
            for batch in ordered(batches):
                out = out or system.open_output_stream(f"{path}/{name}", compression=None)
                first, found = encode(batch.column(1))
                ids = np.insert(found.astype(f"<u{width}"), first[1:], end_id)
                out.write(ids.tobytes())
                lengths = np.diff(first) + 1
                ordinals = []
                for doc_id in batch.column(0).to_pylist():
                    ordinal = ordinal + 1 if doc_id == last else 0
                    last = doc_id
                    ordinals.append(ordinal)
                n = len(lengths)
                columns = [batch.column(0), pa.array(ordinals, pa.int64()), pa.array(np.full(n, shard, np.int32)), pa.array([f"{folder}/{name}"] * n)]
                columns += [pa.array(done + np.cumsum(lengths) - lengths), pa.array(lengths)]
                done += len(ids)
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ordinal", "shard", "path", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size")).first()["size"]
    ranges = rows.repartitionByRange(parts or max(shuffle_parts(spark), -(-size // SHARD_TEXT)), F.asc_nulls_first("doc_id"))
    listed = keep(map_batches(ranges, write, "doc_id long, ordinal long, shard int, path string, offset long, length long"), "listed")

    shards = listed.groupBy("shard", "path").agg(F.sum("length").alias("ids"))
    before = F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))  # one row per shard
    shards = keep(shards.select("shard", "path", F.coalesce(before, F.lit(0)).alias("base")), "shards")

    keyed = listed.where("doc_id is not null and ordinal = 0")
    segments = max(1, math.ceil(keyed.count() / SEGMENT_KEYS))
    return TokenFiles(shards, _write_index(keyed, folder, segments), listed.drop("path"), segments, width)


def _with_segment(rows: DataFrame, segments: int) -> DataFrame:
    """Column ``segment`` of every doc_id, shuffled so that a segment lies in one partition."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("segment", pa.array(segment_of(batch.column("doc_id").to_numpy(), segments), pa.int64()))

    fields = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    parts = max(1, min(segments, shuffle_parts(rows.sparkSession)))
    marked = map_batches(rows, add, fields + ", segment long")
    return marked.repartition(parts, "segment").sortWithinPartitions("segment")


def _groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[object, pa.Table]]:
    """Tables of equal neighbouring values of a column of batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            value = batch.column(column)[0]
            cut = pc.index(pc.equal(batch.column(column), value), False).as_py()
            cut = batch.num_rows if cut < 0 else cut
            if held and held[0].column(column)[0] != value:
                yield held[0].column(column)[0].as_py(), pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(0, cut))
            batch = batch.slice(cut)
    if held:
        yield held[0].column(column)[0].as_py(), pa.Table.from_batches(held)


def _write_index(keyed: DataFrame, folder: str, segments: int) -> DataFrame:
    """Write one file per segment and list them."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = store(folder)
        for segment, rows in _groups(batches, "segment"):
            keys = rows.column("doc_id").to_numpy()
            found = PerfectHash.build(keys)
            entries = np.zeros(len(keys), ENTRY)
            at = found.places(keys)
            entries["fingerprint"][at] = fingerprint(keys)
            for name in ("shard", "offset", "length"):
                entries[name][at] = rows.column(name).to_numpy()
            name = attempt_name("index", segment, ".mph")
            with system.open_output_stream(f"{path}/{name}") as out:
                out.write(found.to_bytes())
                out.write(entries.tobytes())
            yield pa.RecordBatch.from_pydict({"segment": [segment], "path": [f"{folder}/{name}"], "keys": [len(keys)]})

    rows = _with_segment(keyed.select("doc_id", "shard", "offset", "length"), segments)
    return keep(map_batches(rows, write, "segment long, path string, keys long"), "segments")


class Segment:
    """An index segment that was read back."""

    def __init__(self, uri: str):
        system, path = store(uri)
        with system.open_input_stream(path) as file:
            raw = file.read()
        self.hash, size = PerfectHash.from_bytes(raw)
        self.entries = np.frombuffer(raw, ENTRY, offset=size)

    def find(self, doc_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries of the keys, and whether the stored fingerprint confirms them."""
        at = self.hash.places(doc_ids)
        inside = (at >= 0) & (at < len(self.entries))
        found = np.zeros(len(doc_ids), ENTRY)
        found[inside] = self.entries[at[inside]]
        return found, inside & (found["fingerprint"] == fingerprint(doc_ids))


def look_up(files: TokenFiles, keys: DataFrame) -> DataFrame:
    """(doc_id, shard, offset, length) of the rows of ``keys(doc_id)`` that the index holds.

    A key that was never written is found with probability 2**-32 (the stored fingerprint). Null keys are not found.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, at = None, None
        for batch in batches:
            for path, rows in _groups(iter([batch]), "path"):
                if path != at:
                    segment, at = Segment(path), path
                doc_ids = rows.column("doc_id").to_numpy()
                found, confirmed = segment.find(doc_ids)
                columns = [pa.array(doc_ids[confirmed]), pa.array(found["shard"][confirmed].astype(np.int32))]
                columns += [pa.array(found[name][confirmed].astype(np.int64)) for name in ("offset", "length")]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "shard", "offset", "length"])

    asked = keys.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    asked = _with_segment(asked, files.segment_count)
    asked = asked.join(small(files.segments.select("segment", "path")), "segment")
    asked = asked.select("doc_id", "path").sortWithinPartitions("path")  # behind the join: Spark drops a sort in front of it
    return map_batches(asked, find, "doc_id long, shard int, offset long, length long")


def places(files: TokenFiles) -> DataFrame:
    """(doc_id, shard, offset, length) of every written row: over the index by its key; rows that repeat a doc_id and rows
    without one have no key of their own and come from the committed list of the writers."""
    first = F.col("doc_id").isNotNull() & (F.col("ordinal") == 0)
    others = files.documents.where(~first).select("doc_id", "shard", "offset", "length")
    return look_up(files, files.documents.where(first).select("doc_id")).unionByName(others)


def read_ids(files: TokenFiles, places: DataFrame, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of ``places(doc_id, shard, offset, length)`` from the shards.

    ``start`` counts the ids of all documents before. Neighbouring documents are read at once; the ids come as
    little-endian unsigned 32-bit bytes, or with ``digest`` as ``ids_crc32``, their unsigned crc32.
    """
    width, last_name = files.width, "ids_crc32" if digest else "ids"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*[batch.column(n).to_pylist() for n in ("path", "offset", "length")], strict=True))
            found: list = []
            while len(found) < len(rows):
                at = len(found)
                path, first, length = rows[at]
                stop, last = first + length, at + 1
                while last < len(rows) and rows[last][:2] == (path, stop) and (stop + rows[last][2] - first) * width <= READ_BYTES:
                    stop += rows[last][2]
                    last += 1
                system, place = store(path)
                with system.open_input_file(place) as file:
                    raw = file.read_at((stop - first) * width, first * width)
                ids = memoryview(np.frombuffer(raw, f"<u{width}").astype("<u4")).cast("B")
                for _, offset, length in rows[at:last]:
                    one = ids[4 * (offset - first) : 4 * (offset - first + length)]
                    found.append(zlib.crc32(one) if digest else bytes(one))
            columns = [batch.column("doc_id"), pc.add(batch.column("base"), batch.column("offset")), batch.column("length")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.int64() if digest else pa.binary())], ["doc_id", "start", "n_tokens", last_name])

    rows = places.join(small(files.shards), "shard").select("doc_id", "path", "base", "offset", "length")
    rows = rows.repartitionByRange(shuffle_parts(places.sparkSession), "path", "offset").sortWithinPartitions("path", "offset")
    return map_batches(rows, read, f"doc_id long, start long, n_tokens long, {last_name} " + ("long" if digest else "binary"))

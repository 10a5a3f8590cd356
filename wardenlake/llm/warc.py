"""Web archives with the index written first and read by coalesced byte ranges."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import attempt_name, fresh_folder, keep, map_batches, shuffle_parts, small, store

#: Fixed values of the format (WARC 1.1 and its revisit profile for equal payloads).
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Smallest payload that another record may revisit, in bytes.
LEAST_PAYLOAD = 1000

#: Bytes of one read at most (unless a record alone is longer), and unwanted bytes between two records that a read skips over.
READ_BYTES, GAP = 8 * 1024 * 1024, 64 * 1024

INDEX = "page_id long, url string, digest string, record_type string, path string, offset long, length long"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def decide(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """(page_id, url, html, n_bytes, digest, refers_to) of ``pages(page_id, url, html)``.

    Of equal payloads of at least ``least`` bytes the one with the largest page_id is stored, the others refer to
    it. Equal payloads are counted before the shuffle, so a payload that very many pages share costs one row per task;
    the list of shared payloads is broadcast only if its measured size allows it.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumns({"n_bytes": F.octet_length("html").cast("long"), "digest": F.sha1(F.col("html").cast("binary"))})
    shared = rows.where(F.col("n_bytes") >= least).groupBy("digest", "n_bytes")
    shared = shared.agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    shared = small(keep(shared.select("digest", "n_bytes", "holder"), "shared-payloads"))
    joined = rows.join(shared, ["digest", "n_bytes"], "left")
    refers = F.when(F.col("holder") != F.col("page_id"), F.col("holder"))
    return joined.select("page_id", "url", "html", "n_bytes", "digest", refers.alias("refers_to"))


def _record(page_id: int | None, url: str | None, html: str, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record as a gzip member."""
    payload = html.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = "none" if page_id is None else page_id
    head = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    squeeze = zlib.compressobj(4, zlib.DEFLATED, 31)
    return squeeze.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def write_archives(pages: DataFrame, least: int = LEAST_PAYLOAD, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write one record per row of ``pages`` and return the written index: page_id, url, digest, record_type, path, offset,
    length. Every task writes one archive of gzip members.

    Null html is an empty payload; a null url leaves out the target; a row without page_id is always a response; rows that
    repeat the page_id of the stored payload are responses as well. Other columns are not read. An empty table gives no
    archives and an empty index.
    """
    spark = pages.sparkSession
    folder = fresh_folder(spark, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = store(folder)
        name, out, at = attempt_name("pages", TaskContext.get().partitionId(), ".warc.gz"), None, 0
        try:
            for batch in batches:
                out = out or system.open_output_stream(f"{path}/{name}", compression=None)
                offsets, lengths, kinds = [], [], []
                columns = [batch.column(n).to_pylist() for n in ("page_id", "url", "html", "digest", "refers_to")]
                for row in zip(*columns, strict=True):
                    raw = _record(*row, date)
                    out.write(raw)
                    offsets.append(at)
                    lengths.append(len(raw))
                    kinds.append("response" if row[4] is None else "revisit")
                    at += len(raw)
                arrays = [batch.column("page_id"), batch.column("url"), batch.column("digest"), pa.array(kinds, pa.string())]
                arrays += [pa.array([f"{folder}/{name}"] * len(kinds)), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "digest", "record_type", "path", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    return keep(map_batches(decide(pages, least), write, INDEX), "warc-index")


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one gzip member."""
    head, _, rest = zlib.decompress(raw, 31).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    return headers, rest[: int(headers["Content-Length"])]


def _number(urn: str | None) -> int | None:
    name = urn[len("<urn:page:") : -1] if urn else "none"
    return None if name == "none" else int(name)


def read_records(selected: DataFrame) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload, payload_bytes, payload_digest) of index rows, from the archives.

    ``selected`` holds any rows of the index. They are dealt out by archive and offset; each task reads neighbouring
    records in one range. For responses size and digest are those of the payload that was read; a revisit stores no
    payload (null) and they come from its headers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*[batch.column(n).to_pylist() for n in ("path", "offset", "length")], strict=True))
            out: list[tuple] = []
            while len(out) < len(rows):
                path, first, length = rows[len(out)]
                stop, last = first + length, len(out) + 1
                while last < len(rows) and rows[last][0] == path:
                    end = rows[last][1] + rows[last][2]
                    if rows[last][1] > stop + GAP or end - first > READ_BYTES:
                        break
                    stop, last = max(stop, end), last + 1
                system, place = store(path)
                with system.open_input_file(place) as file:
                    raw = file.read_at(stop - first, first)
                for _, offset, length in rows[len(out) : last]:
                    headers, block = parse(raw[offset - first : offset - first + length])
                    http, _, payload = block.partition(b"\r\n\r\n")
                    revisit = headers["WARC-Type"] == "revisit"
                    size = int(http.rpartition(b"Content-Length: ")[2]) if revisit else len(payload)
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else hashlib.sha1(payload).hexdigest()
                    refers = _number(headers.get("WARC-Refers-To")) if revisit else None
                    page, url = _number(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI")
                    out.append((page, url, headers["WARC-Type"], refers, None if revisit else payload.decode(), size, digest))
            names = ["page_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest"]
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
            arrays = [pa.array(values, kind) for values, kind in zip(zip(*out, strict=True), kinds, strict=True)]
            if arrays:
                yield pa.RecordBatch.from_arrays(arrays, names)

    rows = selected.select("path", "offset", "length")
    rows = rows.repartitionByRange(shuffle_parts(selected.sparkSession), "path", "offset").sortWithinPartitions("path", "offset")
    schema = "page_id long, url string, record_type string, refers_to long, payload string, payload_bytes long, payload_digest string"
    return map_batches(rows, read, schema)


#: Oracle of the round trip (payload sizes in UTF-8, digests in lower-case hex).
SQL = f"""
with payloads as (
  select page_id, coalesce(html, '') as html, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes, sha1(coalesce(html, '')) as payload_digest
  from pages
),
holders as (select html, max(page_id) as holder from payloads where payload_bytes >= {LEAST_PAYLOAD} group by html)
select page_id, payload_bytes, payload_digest,
  case when holder is not null and holder <> page_id then 'revisit' else 'response' end as record_type,
  case when holder <> page_id then holder end as refers_to
from payloads left join holders using (html)
"""

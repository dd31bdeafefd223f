"""WARC archives compressed record by record with a Zstandard dictionary of their own."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreframe.llm.common import materialise, slices

#: Bytes of records in an archive, of its dictionary, and of the records the dictionary is made from.
ARCHIVE_BYTES = 4 << 20
DICTIONARY_BYTES = 32 << 10
SAMPLE_BYTES = 1 << 20
#: Fixed value: magic number of the skippable frame that holds a dictionary.
DICTIONARY_FRAME = 0x184D2A5D
_DATE = "1970-01-01T00:00:00Z"


def _line(text: str | None) -> str:
    return "" if text is None else text.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record with the payload, or a revisit record of a page with an equal one."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {_DATE}"]
    head += [f"WARC-Target-URI: {_line(url)}"] if url is not None else []
    head += [f"WARC-Payload-Digest: sha256:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on records spread over the archive; where they are too few to train on, their own bytes."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    sample = [r[: 128 << 10] for r in records[::step]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(sample)[:DICTIONARY_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_archive(records: list[bytes], level: int = 3) -> bytes:
    """The dictionary in a leading skippable frame, then one frame for each record."""
    words = dictionary(records)
    raw = words.as_bytes()
    pack = zstandard.ZstdCompressor(level=level, dict_data=words).compress
    return b"".join([struct.pack("<II", DICTIONARY_FRAME, len(raw)), raw, *map(pack, records)])


def read_archive(archive: bytes) -> Iterator[bytes]:
    magic, size = struct.unpack_from("<II", archive)
    if magic != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame")
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(archive[8 : 8 + size]))
    view, at = memoryview(archive), 8 + size
    while at < len(view):
        frame, out, step = unpack.decompressobj(), [], 4096
        while not frame.eof:
            if at >= len(view):
                raise ValueError("archive ends inside a record")
            part = view[at : at + step]
            out.append(frame.decompress(part))
            at += len(part) - len(frame.unused_data)
            step = 65536
        yield b"".join(out)


def parse_record(raw: bytes) -> tuple[int | None, int, str, str, int | None]:
    """page_id, payload bytes, digest, type and refers_to; a response's size and digest are taken from its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    page = fields["WARC-Record-ID"][len("<urn:page:") : -1]
    digest, size, other = fields["WARC-Payload-Digest"].removeprefix("sha256:"), len(payload), None
    if fields["WARC-Type"] == "revisit":
        size = int(http.rpartition(b"Content-Length: ")[2])
        other = int(fields["WARC-Refers-To"][len("<urn:page:") : -1])
    elif hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of page {page} doesn't have its digest")
    return int(page) if page else None, size, digest, fields["WARC-Type"], other


def archives(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Archives of pages(page_id, url, html) as rows (archive, records, content), content being a whole .warc.zst file.

    Of pages with equal payloads (html in UTF-8, null: empty) of at least `least_bytes`, that with the least page_id is a
    response and the others are revisits; a page without id is always a response, as are rows that repeat the least id.
    Groups of equal payloads are found by digest with a partial minimum, and html moves once, by page_id.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload"), F.sha2(html, 256).alias("digest"))
    ids = rows.where(F.octet_length("payload") >= least_bytes).select("page_id", "digest")
    first = ids.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("refers_to != last").select("digest", "refers_to")
    again = ids.join(first, "digest").where("page_id != refers_to").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, records = TaskContext.get().partitionId(), 0, 0, []

        def file() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f"pages-{part:06d}-{number:06d}.warc.zst"]), pa.array([len(records)], pa.int64()), pa.array([write_archive(records)], pa.binary())], names=["archive", "records", "content"])

        for batch in batches:
            for some in slices(batch, "payload"):
                for row in zip(*[some.column(x).to_pylist() for x in ("page_id", "url", "payload", "digest", "refers_to")], strict=True):
                    records.append(record(*row))
                    held += len(records[-1])
                    if held >= ARCHIVE_BYTES:
                        yield file()
                        number, held, records = number + 1, 0, []
        if records:
            yield file()

    return rows.join(again, ["page_id", "digest"], "left").select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(run, "archive string, records long, content binary")


def archived_pages(files: DataFrame) -> DataFrame:
    """What the archives hold: page_id, payload_bytes, payload_digest, record_type and refers_to of each record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                found = zip(*map(parse_record, read_archive(content.as_py())), strict=True)
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(found, types, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return files.select("content").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_pages(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Write the archives to the shared folder and read them back: a row per page."""
    return archived_pages(materialise(archives(pages, least_bytes), "archives"))


ARCHIVED_SQL = """
WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT payload_digest AS digest, min(page_id) AS least FROM d GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id != least THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id != least THEN least END AS refers_to
FROM d JOIN m ON payload_digest = digest
"""

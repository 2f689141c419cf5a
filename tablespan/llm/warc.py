"""WARC records in Zstandard archives: one frame per record, a dictionary in the leading frame.

An archive is a binary value: a skippable frame (magic 0x184D2A5D) that holds the dictionary, then
one frame for each record. Archives are rows of a table (archive, content), as Spark's `binaryFile`
source gives them for `*.warc.zst` files, so reading never opens a path outside Spark.

Equal payloads: the record with the largest identifier is the `response`, the others are `revisit`
records that refer to it and carry only the HTTP head. Several rows with that largest identifier are
all responses. A NULL identifier is never the largest unless all are NULL; then all are responses.
A NULL payload is empty. Other columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespan.llm.registry import query, read
from tablespan.llm.words import batch
from tablespan.sources.shared import kept

#: Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

ARCHIVE_BYTES = 16 << 20  # of records before compression, in one archive
DICTIONARY_BYTES = 16 << 10
SAMPLE_BYTES = 1 << 20  # of the first records, from which an archive's dictionary is trained
CRAWL_DATE = "2026-01-01T00:00:00Z"  # the tables have none

ARCHIVES = pa.schema([("archive", pa.string()), ("content", pa.binary())])
RECORDS = pa.schema(
    [
        ("archive", pa.string()),
        ("position", pa.int64()),
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("target_uri", pa.string()),
        ("refers_to", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
        ("error", pa.string()),
    ]
)


def marked(pages: DataFrame, record_id: str, uri: str, payload: str) -> DataFrame:
    """(record_id, uri, payload, sha1, refers_to): refers_to is set for revisits only.

    Groups are counted before they are shuffled; only digests that occur twice are joined back, and a
    digest that most rows share is split by the adaptive skew join.
    """
    rows = pages.select(
        F.col(f"`{record_id}`").cast("string").alias("record_id"),
        F.col(f"`{record_id}`").alias("rank"),
        F.col(f"`{uri}`").cast("string").alias("uri"),
        F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    groups = (
        rows.groupBy("sha1")
        .agg(F.max("rank").alias("last"), F.count("*").alias("copies"))
        .filter((F.col("copies") > 1) & F.col("last").isNotNull())
        .select(F.col("sha1").alias("group_sha1"), "last")
    )
    other = F.col("last").isNotNull() & ~F.col("rank").eqNullSafe(F.col("last"))
    return rows.join(groups, rows.sha1 == groups.group_sha1, "left").select(
        "record_id", "uri", "payload", "sha1", F.when(other, F.col("last").cast("string")).alias("refers_to")
    )


def _identifier(value: str | None) -> str:
    return f"<urn:record:{'' if value is None else value}>"


def _record(record_id: str | None, uri: str | None, payload: bytes, sha1: str, refers_to: str | None) -> bytes:
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_identifier(record_id)}", f"WARC-Date: {CRAWL_DATE}"]
    if uri is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Refers-To: {_identifier(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _archive(records: list[bytes]) -> bytes:
    samples, size = [], 0
    for record in records:
        samples.append(record[:SAMPLE_BYTES])
        size += len(samples[-1])
        if size >= SAMPLE_BYTES:
            break
    try:
        dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:  # too little to train on: the samples' own bytes serve
        dictionary = zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    stored = zstandard.ZstdCompressor(write_content_size=True).compress(dictionary.as_bytes())
    pack = zstandard.ZstdCompressor(dict_data=dictionary, write_checksum=True, write_content_size=True)
    return struct.pack("<II", DICTIONARY_FRAME, len(stored)) + stored + b"".join(map(pack.compress, records))


def write_archives(rows: DataFrame) -> DataFrame:
    """(archive, content) of rows as `marked` gives them; a task's archives hold its rows in order."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        waiting: list[bytes] = []
        size = 0

        def flushed() -> pa.RecordBatch:
            nonlocal n, size
            made = batch(ARCHIVES, archive=[f"part-{part:06d}-{n:04d}.warc.zst"], content=[_archive(waiting)])
            n, size = n + 1, 0
            waiting.clear()
            return made

        for rows in batches:
            for row in zip(*(rows.column(c) for c in ("record_id", "uri", "payload", "sha1", "refers_to")), strict=True):
                waiting.append(_record(*(x.as_py() for x in row)))
                size += len(waiting[-1])
                if size >= ARCHIVE_BYTES:
                    yield flushed()
        if waiting:
            yield flushed()

    return rows.mapInArrow(pack, "archive string, content binary")


def _frames(content: bytes) -> Iterator[tuple[int, bytes]]:
    """Position and decoded bytes of each record's frame."""
    view, at, dictionary = memoryview(content), 0, None
    while at < len(view):
        if len(view) - at < 8:
            raise ValueError(f"{len(view) - at} stray bytes at {at}")
        magic, size = struct.unpack_from("<II", view, at)
        if magic in SKIPPABLE:
            if at + 8 + size > len(view):
                raise ValueError(f"the skippable frame at {at} is cut off")
            if at == 0 and magic == DICTIONARY_FRAME:
                held = bytes(view[8 : 8 + size])
                if held.startswith(ZSTD_MAGIC):
                    held = zstandard.ZstdDecompressor().decompress(held)
                dictionary = zstandard.ZstdCompressionDict(held)
            at += 8 + size
            continue
        frame = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        out, begin, step = [], at, 1 << 13
        while not frame.eof:
            if at >= len(view):
                raise ValueError(f"the frame at {begin} is cut off")
            out.append(frame.decompress(view[at : at + step]))
            at = min(at + step, len(view))
            step *= 2
        at -= len(frame.unused_data)
        yield begin, b"".join(out)


def _fields(lines: list[bytes]) -> dict[str, str]:
    found = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise ValueError(f"not a header line: {line[:80]!r}")
        found[name.strip().lower().decode("ascii")] = value.strip().decode()
    return found


def _reference(value: str | None) -> str | None:
    found = re.fullmatch(r"<urn:record:(.*)>", value or "", re.S)
    return (found[1] or None) if found else value


def _parsed(record: bytes) -> dict:
    """A record's fields; ValueError unless its headers and lengths hold together."""
    head, end, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if first not in (b"WARC/1.0", b"WARC/1.1") or not end:
        raise ValueError("no WARC version line or no end of headers")
    fields = _fields(lines)
    if missing := [x for x in REQUIRED if x not in fields]:
        raise ValueError(f"headers are missing: {missing}")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length is {length}, the block with its end has {len(rest)} bytes")
    status, _, payload = rest[:length].partition(b"\r\n\r\n")
    opening, *lines = status.split(b"\r\n")
    if not opening.startswith(b"HTTP/"):
        raise ValueError("the block is no HTTP message")
    size = int(_fields(lines)["content-length"])
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if fields["warc-type"] == "response":
        if len(payload) != size:
            raise ValueError(f"the payload has {len(payload)} bytes, not {size}")
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError("the payload's digest differs")
    elif fields["warc-type"] != "revisit" or payload or "warc-refers-to" not in fields:
        raise ValueError(f"not a response or a bare revisit: {fields['warc-type']}")
    return {
        "record_id": _reference(fields["warc-record-id"]),
        "record_type": fields["warc-type"],
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": _reference(fields.get("warc-refers-to")),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if fields["warc-type"] == "response" else None,
    }


def read_archives(archives: DataFrame, payloads: bool = True, strict: bool = True) -> DataFrame:
    """The records of (archive, content) rows.

    A record that does not hold together raises; with `strict=False` it becomes a row with `error`
    set, and an archive that cannot be cut into frames ends with such a row. A NULL or empty archive
    has no records. `payloads=False` leaves the payloads out once they are checked.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list[dict]) -> pa.RecordBatch:
            return batch(RECORDS, **{f: [r.get(f) for r in rows] for f in RECORDS.names})

        for given in batches:
            for name, content in zip(given.column("archive"), given.column("content"), strict=True):
                rows: list[dict] = []
                size, at = 0, 0
                try:
                    for at, record in _frames(content.as_py() or b""):
                        row = {"archive": name.as_py(), "position": at}
                        try:
                            row |= _parsed(record)
                        except (ValueError, KeyError) as problem:
                            if strict:
                                raise
                            row["error"] = str(problem)
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        size += len(row.get("payload") or b"") + 200
                        if size > 4 << 20:
                            yield made(rows)
                            rows, size = [], 0
                except (ValueError, KeyError, zstandard.ZstdError) as problem:
                    if strict:
                        raise ValueError(f"{name.as_py()} at {at}: {problem}") from problem
                    rows.append({"archive": name.as_py(), "position": at, "error": str(problem)})
                if rows:
                    yield made(rows)

    wanted = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'binary' if f.type == pa.binary() else 'string'}" for f in RECORDS)
    return archives.select("archive", "content").mapInArrow(unpack, wanted)


@query(
    """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
    h AS (SELECT page_id, octet_length(body) AS size, sha1(body) AS hex FROM p),
    g AS (SELECT hex, max(page_id) AS last FROM h GROUP BY hex)
    SELECT page_id, size AS payload_bytes,
           array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             CAST(1 + (CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS INTEGER)
                       >> CAST(15 - 5 * (i % 4) AS INTEGER)) % 32 AS INTEGER), 1)), '') AS payload_digest,
           CASE WHEN page_id IS DISTINCT FROM last AND last IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
    FROM h JOIN g USING (hex)
    """
)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record, written to archives in the shared folder and read back from them."""
    pages = read(spark, sf_dir, "pages")
    archives = kept(spark, write_archives(marked(pages, "page_id", "url", "html")))
    return read_archives(archives, payloads=False).select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )

"""WARC archives: one gzip member per record, written and read by Spark tasks.

The reader is splittable.  A task looks for the gzip magic in its byte range,
takes a candidate for a record only if it decodes to a WARC header, and owns the
records that start inside its range; the last one it reads to its end beyond.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floorline.llm.common import opened, shuffle_partitions

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
SPLIT_BYTES = 8 << 20
READ_BYTES = 1 << 20
BATCH_BYTES = 4 << 20


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_value(text: str) -> str:
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in text)


def record(page, url: str | None, payload: bytes, first) -> bytes:
    """One gzip member; ``first`` is the id of the response it revisits, or None."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    lines = [
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {header_value(url)}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{first}>"] if first is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def first_pages(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Per page and payload (``later``, ``later_sha``): ``first``, the smallest page with that payload if it is another one.

    Only ids and digests are moved, and they are summed up before the shuffle.
    """
    keys = pages.select("page", "sha", "size").distinct()
    groups = keys.filter(F.col("size") >= min_bytes).groupBy("sha").agg(F.min("page").alias("least"))
    return keys.join(groups, "sha").filter(~F.col("page").eqNullSafe(F.col("least"))).select(
        F.col("page").alias("later"), F.col("sha").alias("later_sha"), F.col("least").alias("first"))


def write_warc(pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url",
               payload_column: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write a record per row below ``folder``; returns ``path``, ``bytes`` and ``records`` of each file.

    Of rows with equal payloads of at least ``min_bytes`` bytes the one with the
    smallest id is a response, the others revisit it; all smaller payloads are
    responses.  A null payload is empty; a null url leaves out its header; a null
    id comes after all others.  Rows that repeat an id with its payload are of
    one kind.  A file is written under another name and then moved, so a task
    that runs again replaces its own file; an empty table writes none.
    """
    plain = pages.select(
        F.col(id_column).cast("long").alias("page"), F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.col(payload_column).cast("string"), F.lit("")).alias("payload"),
    ).select("*", F.sha1(F.col("payload").cast("binary")).alias("sha"), F.octet_length("payload").alias("size"))
    roles = first_pages(plain, min_bytes)
    dealt = plain.join(roles, F.col("page").eqNullSafe(F.col("later")) & (F.col("sha") == F.col("later_sha")), "left").select(
        "page", "url", "payload", "first")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, size, count, out = f"part-{TaskContext.get().partitionId():08d}.warc.gz", 0, 0, None
        system, base = opened(folder)
        for batch in batches:
            for row in zip(*(batch[c] for c in ("page", "url", "payload", "first"))):
                page, url, payload, first = (x.as_py() for x in row)
                if out is None:
                    system.create_dir(base, recursive=True)
                    own = f"{base}/.{name}-{uuid.uuid4().hex}"
                    out = system.open_output_stream(own, compression=None)
                data = record(page, url, payload.encode(), first)
                out.write(data)
                size, count = size + len(data), count + 1
        if out is not None:
            out.close()
            system.move(own, f"{base}/{name}")
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": [size], "records": [count]})

    return dealt.mapInArrow(write, "path string, bytes long, records long")


class Range:
    """Bytes of a file from an offset on, read as they are asked for."""

    def __init__(self, file: pa.NativeFile, start: int, size: int):
        self.file, self.base, self.size, self.data = file, start, size, b""

    def more(self) -> bool:
        at = self.base + len(self.data)
        if at >= self.size:
            return False
        self.file.seek(at)
        self.data += self.file.read(min(READ_BYTES, self.size - at))
        return True

    def forget(self, upto: int) -> None:
        self.data, self.base = self.data[upto - self.base:], upto


def member(source: Range, at: int) -> tuple[bytes, int] | None:
    """What the gzip member at ``at`` holds and where the next one begins; None if none with a WARC header starts there."""
    unpack, parts, fed = zlib.decompressobj(31), [], at - source.base
    known = False
    while not unpack.eof:
        if fed >= len(source.data) and not source.more():
            return None
        piece = source.data[fed:]
        try:
            parts.append(unpack.decompress(piece))
        except zlib.error:
            return None
        fed += len(piece)
        if not known:
            head = b"".join(parts)[:len(VERSION)]
            known = len(head) == len(VERSION)
            if not VERSION.startswith(head[:len(VERSION)]):
                return None
    return (b"".join(parts), source.base + fed - len(unpack.unused_data)) if known else None


def records_in(file: pa.NativeFile, size: int, begin: int, end: int) -> Iterator[bytes]:
    """The records that start in a byte range."""
    source, at = Range(file, begin, size), begin
    while at < end:
        found = source.data.find(MAGIC, at - source.base)
        if found < 0:
            # The magic may lie across the end of what has been read.
            at = max(at, source.base + len(source.data) - len(MAGIC) + 1)
            if not source.more():
                return
            continue
        at = source.base + found
        if at >= end:
            return
        source.forget(at)
        got = member(source, at)
        if got:
            yield got[0]
            at = got[1]
        else:
            at += 1


def fields(lines: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in lines.decode("utf-8", "replace").split("\r\n") if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def page_number(urn: str | None) -> int | None:
    text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


RECORD = pa.schema([
    ("page", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
])


def parsed(data: bytes) -> tuple:
    head, _, rest = data.partition(b"\r\n\r\n")
    own = fields(head)
    block = rest[:int(own["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = own["warc-payload-digest"].removeprefix("sha1:")
    kind = own["warc-type"]
    if kind == "response" and digest(payload) != told:
        raise ValueError(f"payload of {own['warc-record-id']} does not match its digest")
    return (page_number(own["warc-record-id"]), own.get("warc-target-uri"), kind, page_number(own.get("warc-refers-to")),
            told, int(fields(http)["content-length"]), payload if kind == "response" else None)


def read_warc(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records below ``folder``: page, url, type, page referred to, digest and bytes of the full payload, payload.

    A revisit has no payload of its own.  A folder without archives gives no rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("path", "length")
    splits = files.select("path", "length", F.explode(
        F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))).alias("begin"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length, begin in zip(*(batch[c].to_pylist() for c in ("path", "length", "begin"))):
                system, name = opened(path)
                rows, held = [], 0
                with system.open_input_file(name) as file:
                    for data in records_in(file, length, begin, min(length, begin + split_bytes)):
                        rows.append(parsed(data))
                        held += len(data)
                        if held > BATCH_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), RECORD.types)], schema=RECORD)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), RECORD.types)], schema=RECORD)

    # A number of partitions, as the few small rows would end in one task otherwise.
    return splits.repartition(shuffle_partitions(spark), "path", "begin").mapInArrow(
        read, "page long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary")

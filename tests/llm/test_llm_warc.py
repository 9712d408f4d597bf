from __future__ import annotations

import gzip
import io
import zlib
from pathlib import Path

import pyarrow as pa
from llm_helpers import clashing, rows

from floorline.llm import warc
from floorline.llm.warc import digest, read_warc, records_in, write_warc
from floorline.streaming.workspace import shared_folder

SCHEMA = "page_id long, url string, html string"


def test_round_trip_with_nulls_repeats_and_small_ranges(spark):
    big = "".join(chr(32 + (k * k + k // 7) % 90) for k in range(300_000))
    data = [(1, "http://a", "x"), (2, None, "x"), (3, "http://b\r\nX: y", None), (4, "http://c", ""), (5, "http://d", big),
            (6, "http://e", big), (None, "http://f", "x"), (None, "http://g", "only"), (2, None, "x"), (1, "http://a", "x"), (7, "ü", "é" * 10)]
    folder = shared_folder(spark, "warc-test")
    manifest = write_warc(clashing(spark.createDataFrame(data, SCHEMA)), folder).collect()
    assert sum(r["records"] for r in manifest) == len(data)
    first = {"x": 1, "": 3, big: 5, "only": None, "é" * 10: 7}
    expected = sorted([(i, len((h or "").encode()), digest((h or "").encode()), *(
        ("response", None) if first[h or ""] == i else ("revisit", first[h or ""]))) for i, _, h in data], key=repr)
    for split in (1 << 10, 1 << 16, 1 << 30):
        found = read_warc(spark, folder, split)
        assert rows(found, "page", "payload_bytes", "payload_digest", "record_type", "refers_to") == expected
    payloads = {r["page"]: bytes(r["payload"]) for r in found.filter("record_type = 'response'").collect()}
    assert payloads[5] == big.encode() and payloads[7].decode() == "é" * 10
    assert found.filter("page = 3").first()["url"] == "http://b%0D%0AX: y"


def test_files_are_plain_gzip_members(spark):
    folder = shared_folder(spark, "warc-test")
    paths = [r["path"] for r in write_warc(spark.createDataFrame([(1, "http://a", "hello"), (2, "http://b", "hello")], SCHEMA), folder).collect()]
    text = b"".join(gzip.open(p).read() for p in paths)
    assert text.count(b"WARC/1.1\r\n") == 2 and text.count(b"hello") == 1 and b"WARC-Refers-To: <urn:page:1>" in text


def test_min_bytes_leaves_small_payloads_responses(spark):
    folder = shared_folder(spark, "warc-test")
    write_warc(spark.createDataFrame([(1, "a", "xx"), (2, "a", "xx"), (3, "a", "long one"), (4, "a", "long one")], SCHEMA), folder,
               min_bytes=5).collect()
    assert rows(read_warc(spark, folder), "page", "record_type") == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]


def test_empty_table(spark):
    folder = shared_folder(spark, "warc-test")
    assert write_warc(spark.createDataFrame([], SCHEMA), folder).count() == 0
    Path(folder.removeprefix("file://")).mkdir(parents=True, exist_ok=True)
    assert read_warc(spark, folder).count() == 0


def test_magic_inside_and_between_members_is_not_a_record():
    """Members that decode to something else, magic bytes that decode to nothing, and magic across reads."""
    one = warc.record(1, "u", b"a" * 50_000, None)
    fake = zlib.compressobj(6, zlib.DEFLATED, 31)
    fake = fake.compress(b"not a header " * 10) + fake.flush()
    data = warc.MAGIC + b"junk" + one + fake + warc.MAGIC + one + b"\x1f\x8b"
    for step in (1, 7, 100, len(data)):
        got = [x for a in range(0, len(data), step) for x in records_in(
            pa.PythonFile(io.BytesIO(data), "r"), len(data), a, min(len(data), a + step))]
        assert len(got) == 2 and all(x.startswith(b"WARC/1.1") for x in got)

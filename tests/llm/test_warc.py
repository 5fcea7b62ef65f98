from __future__ import annotations

import base64
import gzip
import hashlib
import io
import os
import zlib

import pytest
from llm_cases import by_name, oracle, spark_by_name

from pricecube.llm import warc
from pricecube.llm.queries import QUERIES
from pricecube.session import scratch_path


def test_query_equals_sql(spark, sf_dir):
    assert spark_by_name(QUERIES["op10_warc"](spark, sf_dir)) == by_name(oracle(warc.OP10_SQL, sf_dir))


def awkward_pages(spark):
    rows = [(1, None, None), (2, "http://a/ b\r\nX: y", ""), (3, "http://a", "WARC/1.1\r\n\r\nContent-Length: 9\r\n\r\n"), (4, "é", "漢字" * 10), (4, "é", "漢字" * 10), (5, "x", "漢字" * 10), (6, "y", "y" * 3_000_000), (7, "z", "\r\n\r\n\x00")]
    rows += [(None, None, "no id"), (None, "u", "no id"), (8, "u", "one id"), (None, "u", "one id")]
    return spark.createDataFrame([(*r, "d", 1) for r in rows], "page_id bigint, url string, html string, digest string, id int")


def test_awkward_rows(spark, sf_dir):
    pages = awkward_pages(spark)
    assert spark_by_name(warc.archive(pages)) == by_name(oracle(warc.OP10_SQL, sf_dir, pages=pages.toArrow()))
    assert warc.archive(pages.limit(0)).collect() == []


def test_small_payloads_are_no_revisits(spark):
    out = warc.archive(awkward_pages(spark), least=50).collect()
    assert sorted(r.page_id for r in out if r.record_type == "revisit") == [4, 4]


def test_files(spark):
    """Archives roll, the normaliser gives the same records, and the sidecar its members."""
    pages = awkward_pages(spark).repartition(1)
    folder = scratch_path(spark, "warc-test")
    raw = warc.write_monolithic(warc.with_roles(pages, "page_id", "url", "html"), f"{folder}/raw", roll=1000).collect()
    assert sum(r.records for r in raw) == pages.count() and len(raw) > 1
    index = warc.normalise(spark.createDataFrame(raw), f"{folder}/normal").collect()
    before = b"".join(sorted(gzip.open(r.path).read() for r in raw))
    names = sorted({r.archive for r in index})
    assert b"".join(sorted(gzip.open(n).read() for n in names)) == before
    for name in names:
        with open(name, "rb") as f:
            data = f.read()
        with open(f"{name}.idx") as f:
            side = [line.rstrip("\n").split("\t") for line in f]
        assert [(int(s[0]), int(s[1])) for s in side] == sorted((r.offset, r.length) for r in index if r.archive == name)
        assert sum(int(s[1]) for s in side) == len(data)
        for offset, length, record_id, _ in side:
            one = zlib.decompress(data[int(offset) : int(offset) + int(length)], warc.GZIP)
            assert warc.header_fields(one[: one.index(warc.END)])["WARC-Record-ID"] == record_id
    again = warc.normalise(spark.createDataFrame([(n,) for n in names], "path string"), f"{folder}/again").count()
    assert again == pages.count()  # archives of many members are read too


def test_broken_archives_are_reported():
    one = warc.record(1, "u", b"payload", "D", None)
    for bad in (one[:-6], b"HTTP/1.1 200\r\n\r\n"):
        try:
            list(warc.split_records(warc.inflated(io.BytesIO(gzip.compress(bad)))))
        except (ValueError, KeyError):
            continue
        raise AssertionError(bad)


def foreign(*fields: str, block: bytes = b"") -> bytes:
    return "\r\n".join(["WARC/1.0", *fields]).encode() + warc.END + block + warc.END


def put(folder: str, name: str, data: bytes) -> str:
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as f:
        f.write(data)
    return f"{folder}/{name}"


def test_archives_of_others(spark, tmp_dir):
    """Names in any case, no space after the colon, folded lines, HTTP messages, other
    kinds of records, digests of other kinds or none, and archives without records."""
    body = "<p>\u00e9</p>\r\n\r\nmore".encode()
    message = b"HTTP/1.1 200 OK\r\nContent-Length: 3" + warc.END + body
    sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
    records = [
        foreign("warc-type:warcinfo", "warc-record-id:<urn:uuid:0>", "content-length:3", block=b"a:b"),
        foreign("WARC-Type: response", "WARC-Record-ID: <urn:uuid:1>", f"WARC-Payload-Digest: SHA1:{sha.lower()}", "Content-Type: application/http;\r\n msgtype=response", f"CONTENT-LENGTH:  {len(message)} ", block=message),
        foreign("WARC-Type: response", "WARC-Record-ID: <urn:uuid:2>", "WARC-Payload-Digest: sha256:00", "Content-Length: 0"),
        foreign("WARC-Type: revisit", "WARC-Record-ID: <urn:uuid:3>", "WARC-Refers-To: <urn:uuid:1>", "Content-Length: 0"),
    ]
    paths = [
        put(tmp_dir, "one.warc.gz", gzip.compress(b"".join(records))),
        put(tmp_dir, "none.warc.gz", gzip.compress(b"")),
        put(tmp_dir, "bytes.warc.gz", b""),
    ]
    index = warc.normalise(spark.createDataFrame([(p,) for p in paths], "path string"), f"{tmp_dir}/normal")
    index.write.parquet(f"{tmp_dir}/index")
    rows = warc.read_members(spark.read.parquet(f"{tmp_dir}/index"), f"{tmp_dir}/normal", with_payload=True).collect()
    got = {r.id: (r.record_type, r.payload_bytes, r.payload_digest, r.refers_to, bytes(r.payload)) for r in rows}
    assert got["<urn:uuid:1>"] == ("response", len(body), sha, None, body)
    assert got["<urn:uuid:0>"][:2] == ("warcinfo", 3) and got["<urn:uuid:2>"][:2] == ("response", 0)
    assert got["<urn:uuid:3>"] == ("revisit", None, None, "<urn:uuid:1>", b"") and len(rows) == 4


def test_unfinished_archives_are_reported():
    whole = gzip.compress(warc.record(1, "u", b"payload", "D", None))
    assert len(list(warc.split_records(warc.inflated(io.BytesIO(whole + whole))))) == 2
    for cut in (1, 4, 8, 20):  # within the length, the checksum, the block
        for data in (whole[:-cut], whole + whole[:-cut]):
            with pytest.raises(ValueError, match="ends within"):
                list(warc.split_records(warc.inflated(io.BytesIO(data))))


def test_headers_that_say_too_little():
    for fields in (["WARC-Type: response", "Content-Length: 0"], ["WARC-Type: response", "WARC-Record-ID: <a>"], ["WARC-Type: response", "WARC-Record-ID: <a>", "Content-Length: -1"]):
        with pytest.raises(ValueError, match="a WARC record"):
            list(warc.split_records(iter([foreign(*fields)])))

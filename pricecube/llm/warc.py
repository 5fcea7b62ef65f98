"""WARC archives: written as whole-file gzip streams, normalised to a gzip
member for each record with a sidecar offset index, and read back through it.

A monolithic ``.warc.gz`` (one gzip stream over all records) can only be read
from its start.  The normaliser inflates such a stream once, in pieces, writes
every record as a member of its own and notes each member's place in a sidecar
file beside the archive, so that any record can be read alone.

Files go to the cluster's shared folder under names that no other attempt of a
task uses.  Only files that a finished task has reported are read on, so a lost
executor leaves at most unused files behind.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricecube.session import scratch_path

from .common import filesystem, map_batches, table, written

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Uncompressed bytes after which a task starts another archive, size of the
#: pieces in which streams are inflated, compression level, and longest header.
ROLL, PIECE, LEVEL, HEADER = 64 << 20, 1 << 20, 4, 1 << 20
#: Payloads shorter than this are never revisits.
LEAST_PAYLOAD = 0
GZIP = 31  # zlib's window bits for gzip framing
END = b"\r\n\r\n"


def digest32(payload: Column) -> Column:
    """Base32 SHA-1: eight groups of five hex digits make four letters each."""
    hexed = F.sha1(payload)
    letters = []
    for group in range(8):
        value = F.conv(F.substring(hexed, 1 + 5 * group, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(value, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def with_roles(pages: DataFrame, id_col: str, url_col: str, html_col: str, least: int = LEAST_PAYLOAD) -> DataFrame:
    """(id, url, payload, digest, refers_to): of equal payloads of ``least`` bytes
    or more the row with the largest id is the response, the others refer to it.
    Equal payloads are counted before anything is joined, from (digest, id) rows."""
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", digest32(F.col("payload")))
    groups = written(
        rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"),
        "payload-groups",
    )
    refers = F.when(F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last")) & (F.octet_length("payload") >= least), F.col("last"))
    return rows.join(groups, "digest", "left").select("id", "url", "payload", "digest", refers.alias("refers_to"))


# --- records -----------------------------------------------------------------


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record.  A revisit has no block; its header keeps the digest
    and the length of the payload it stands for."""
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>"]
    if url is not None:  # no line may break in a header
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    block = payload if refers_to is None else b""
    lines += ["Content-Type: text/html", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + END + block + END


#: The fields that are looked at; their names come in any case.
FIELDS = ("WARC-Type", "WARC-Record-ID", "WARC-Payload-Digest", "WARC-Refers-To", "X-Payload-Length", "Content-Length", "Content-Type")
_FIELD = {f.lower(): f for f in FIELDS}


def header_fields(head: bytes) -> dict[str, str]:
    """Fields by name, those of ``FIELDS`` as written there.  A line that begins with a
    space goes on with the one before; of repeated fields the first counts."""
    version, *lines = re.sub(r"\r\n[ \t]+", " ", head.decode("utf-8", "replace")).split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if colon:
            fields.setdefault(_FIELD.get(name.strip().lower(), name.strip()), value.strip())
    for name in ("WARC-Type", "WARC-Record-ID", "Content-Length"):
        if name not in fields:
            raise ValueError(f"a WARC record without {name}")
    if not re.fullmatch("[0-9]+", fields["Content-Length"]):
        raise ValueError(f"a WARC record of length {fields['Content-Length'][:40]!r}")
    return fields


def inflated(source: BinaryIO) -> Iterator[bytes]:
    """The bytes of a gzip file in pieces, whether of one member or of many.  An empty
    file has none; one that ends before its last member does is an error."""
    gz, begun = zlib.decompressobj(GZIP), False
    while data := source.read(PIECE):
        while data:
            begun = True
            if piece := gz.decompress(data, PIECE):
                yield piece
            data = gz.unconsumed_tail
            if gz.eof:
                data, gz, begun = gz.unused_data, zlib.decompressobj(GZIP), False
    if begun:
        if tail := gz.flush():
            yield tail
        if not gz.eof:
            raise ValueError("the archive ends within a gzip member")


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of an inflated stream; holds one record and one piece."""
    buffer = bytearray()

    def more() -> bool:
        piece = next(pieces, None)
        buffer.extend(piece or b"")
        return piece is not None

    while buffer or more():
        at = buffer.find(END)
        while at < 0:
            if len(buffer) > HEADER or not more():
                raise ValueError("a WARC header does not end")
            at = buffer.find(END)
        size = at + 4 + int(header_fields(bytes(buffer[:at]))["Content-Length"]) + 4
        while len(buffer) < size:
            if not more():
                raise ValueError("the archive ends within a record")
        yield bytes(buffer[:size])
        del buffer[:size]


# --- Spark jobs ---------------------------------------------------------------


def write_monolithic(rows: DataFrame, folder: str, roll: int = ROLL) -> DataFrame:
    """Writes rows of ``with_roles`` to archives of one gzip stream each; (path, records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        out, done = None, []

        def close() -> None:
            out.write(gz.flush())
            out.close()
            done.append((path, count))

        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*batch.columns, strict=True):
                if out is None:
                    path, count, size = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out, gz = fs.open_output_stream(path, compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                one = record(page_id.as_py(), url.as_py(), payload.as_py(), digest.as_py(), refers_to.as_py())
                out.write(gz.compress(one))
                count, size = count + 1, size + len(one)
                if size >= roll:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict({"path": pa.array([p for p, _ in done], pa.string()), "records": pa.array([c for _, c in done], pa.int64())})

    return map_batches(rows.select("id", "url", "payload", "digest", "refers_to"), run, "path string, records long")


INDEX = "archive string, offset long, length long, record_id string, record_type string"


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrites each archive (a ``path`` column) record by record, with a sidecar
    ``.idx`` file of (offset, length, record id, type) lines; returns the index.  An
    archive without records has no rows there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                target, offset, index = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, []
                with fs.open_input_stream(path, compression=None) as source, fs.open_output_stream(target, compression=None) as out:
                    for one in split_records(inflated(source)):
                        fields = header_fields(one[: one.index(END)])
                        gz = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                        member = gz.compress(one) + gz.flush()
                        out.write(member)
                        index.append((target, offset, len(member), fields["WARC-Record-ID"], fields["WARC-Type"]))
                        offset += len(member)
                with fs.open_output_stream(f"{target}.idx", compression=None) as side:
                    for row in index:
                        side.write("\t".join(map(str, row[1:])).encode() + b"\n")
                if not index:
                    continue
                names = [c.split()[0] for c in INDEX.split(", ")]
                yield pa.RecordBatch.from_pydict({n: pa.array(v) for n, v in zip(names, zip(*index, strict=True), strict=True)})

    return map_batches(archives.select("path"), run, INDEX)


def read_members(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Reads each indexed member alone; ids come as text.  A response's length and
    digest are those of the payload read; a revisit's are the ones its header keeps (null
    where it keeps none).  The payload of an HTTP message is its body.  A SHA-1 that a
    header claims is compared; record ids that are no page's stay as they are."""
    schema = "id string, payload_bytes long, payload_digest string, record_type string, refers_to string" + ", payload binary" * with_payload

    def page(urn: str | None):
        own = re.fullmatch("<urn:page:(.*)>", urn or "")
        return (own[1] if own else urn) or None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        name, source = None, None
        for batch in batches:
            out: list[tuple] = []
            for archive, offset, length in zip(*[batch.column(c).to_pylist() for c in ("archive", "offset", "length")], strict=True):
                if archive != name:
                    name, source = archive, fs.open_input_file(archive)
                one = zlib.decompress(source.read_at(length, offset), GZIP)
                at = one.index(END)
                fields = header_fields(one[:at])
                payload = one[at + 4 : at + 4 + int(fields["Content-Length"])]
                if fields.get("Content-Type", "").startswith("application/http"):
                    payload = payload.partition(END)[2]
                size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                kind, _, claimed = fields.get("WARC-Payload-Digest", "").rpartition(":")
                if fields["WARC-Type"] == "revisit":
                    size, digest = int(fields["X-Payload-Length"]) if "X-Payload-Length" in fields else None, claimed or None
                elif kind.lower() == "sha1" and digest != claimed.upper():
                    raise ValueError(f"{archive} at {offset}: the payload does not match its digest")
                out.append((page(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], page(fields.get("WARC-Refers-To")), payload))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
            values = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
            names = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            if with_payload:
                values.append(pa.array(columns[5], pa.binary()))
                names.append("payload")
            yield pa.RecordBatch.from_arrays(values, names)

    return map_batches(index, run, schema)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_PAYLOAD) -> DataFrame:
    """Writes, normalises and reads back; (id, payload_bytes, payload_digest,
    record_type, refers_to), a row per input row.

    Null html is an empty payload, and empty payloads are equal to each other.
    Null urls leave out the target URI.  A null id is smaller than any other;
    rows that share the largest id of a group are all responses, and so is a
    group without ids.  Ids are integers or text without ``>``.  An empty table
    writes no archive.  Other columns are ignored.
    """
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    raw = written(write_monolithic(with_roles(pages, id_col, url_col, html_col, least), f"{folder}/raw"), "archives")
    # Archives are few and large, records many and small: deal out both.
    archives = raw.repartition(max(1, min(raw.count(), spark.sparkContext.defaultParallelism * 4)), "path")
    index = written(normalise(archives, f"{folder}/normal"), "warc-index")
    id_type = pages.schema[id_col].dataType
    out = read_members(index, f"{folder}/normal")
    return out.withColumn("refers_to", F.col("refers_to").cast(id_type)).select(
        F.col("id").cast(id_type).alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_warc(spark, sf_dir: str) -> DataFrame:
    return archive(table(spark, sf_dir, "pages"))


_GROUPS = "\n    || ".join(
    f"substr('{BASE32}', 1 + ((('0x' || substr(h, {1 + 5 * g}, 5))::bigint >> {s}) & 31)::int, 1)" for g in range(8) for s in (15, 10, 5, 0)
)
OP10_SQL = f"""
with p as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as h from pages),
d as (select page_id, payload_bytes, h, max(page_id) over (partition by h) as last from p)
select page_id,
       payload_bytes,
       {_GROUPS} as payload_digest,
       case when page_id is not distinct from last then 'response' else 'revisit' end as record_type,
       case when page_id is distinct from last then last end as refers_to
from d
"""

"""Legacy archives (ARC) to WARC.

``arc_archives`` lays web pages out as ARC archives, ``parse_arc`` reads any
ARC archive: the version block names the version and the field list, each
record's header line is read by that version's fields, and its content by the
declared length. ``convert`` synthesises the WARC records: an identifier (a
UUID of source and payload digest), an ISO time from the 14-digit date, a
type, and base32 SHA-1 digests of payload and block. Records with equal
payloads of at least ``min_bytes`` become one response (the largest source id)
and revisits that refer to it; the decision is a grouped aggregation of
digests, and only digests that repeat are joined back.

Archives are written record by record (each its own gzip member) under another
name and renamed when whole, so a repeated task leaves one file. Readers check
lengths and digests.

ARC versions: 1 = "URL IP-address Archive-date Content-type Archive-length",
2 = "... Content-type Result-code Checksum Location Offset Filename
Archive-length". An archive without a known version, or with a record that
ends early, raises.

Defined results: null html is an empty payload; a null url becomes
"urn:unknown"; white space and control characters in urls are percent-encoded;
a null page_id gives records without a source id, which never are the
response others refer to; rows sharing a page_id are separate records, and all
with the largest id of a group are responses; an empty table writes no
archive; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexisieve.llm.tasks import WholeFile, batch_rows, map_arrow, open_file
from lexisieve.session import broadcast_if_small, materialize, scratch_path

#: Fixed by the format: the fields of a record's header line.
ARC_FIELDS = {
    1: ("url", "ip", "date", "mime", "length"),
    2: ("url", "ip", "date", "mime", "result", "checksum", "location", "offset", "filename", "length"),
}
ARCHIVE_BYTES = 2 << 20
_SOURCE = b"X-Source-Id"
_SPACE = uuid.UUID("5f0c2c4e-8f5b-4d0c-9a53-3d1f1c0b7a11")


class ArcRecord(NamedTuple):
    url: str
    ip: str
    date: str
    mime: str
    content: bytes


def write_arc(records: list[ArcRecord], version: int, name: str = "archive.arc") -> bytes:
    """One ARC archive with its version block."""
    if version == 1:
        names = "URL IP-address Archive-date Content-type Archive-length"
    else:
        names = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
    body = f"{version} 0 lexisieve\n{names}\n".encode()

    def head(r: ArcRecord, at: int) -> bytes:
        more = [] if version == 1 else ["200", "-", "-", str(at), name]
        return " ".join([r.url, r.ip, r.date, r.mime, *more, str(len(r.content))]).encode() + b"\n"
    out = io.BytesIO()
    out.write(head(ArcRecord(f"filedesc://{name}", "0.0.0.0", "19960101000000", "text/plain", body), 0) + body + b"\n")
    for r in records:
        out.write(head(r, out.tell()) + r.content + b"\n")
    return out.getvalue()


def parse_arc(data: io.BufferedIOBase) -> Iterator[ArcRecord]:
    """The records of an ARC archive after its version block."""
    first = data.readline().decode("utf-8").rstrip("\r\n").split(" ")
    if not first[0].startswith("filedesc:"):
        raise ValueError("not an ARC archive")
    block = data.read(int(first[-1]))
    lead = block.split(b"\n", 2)
    version = int(lead[0].split()[0])
    if version not in ARC_FIELDS:
        raise ValueError(f"ARC version {version}")
    fields = ARC_FIELDS[version]
    while line := data.readline():
        if not line.strip():
            continue
        parts = line.decode("utf-8").rstrip("\r\n").split(" ")
        if len(parts) != len(fields):
            raise ValueError(f"{len(parts)} fields in a version {version} header")
        named = dict(zip(fields, parts))
        content = data.read(int(named["length"]))
        if len(content) != int(named["length"]):
            raise ValueError("an ARC record ends early")
        yield ArcRecord(named["url"], named["ip"], named["date"], named["mime"], content)


def safe_url(url: str | None) -> str:
    return re.sub(r"[\s\x00-\x20\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8")), url or "") or "urn:unknown"


def _archives(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("content", pa.binary())])
        for batch in batches:
            held, size = [], 0
            for page_id, url, html in zip(*(batch.column(c) for c in ("page_id", "url", "html"))):
                body = html.as_buffer().to_pybytes() if html.is_valid else b""
                source = _SOURCE + b": %d\r\n" % page_id.as_py() if page_id.is_valid else b""
                content = b"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + source + b"\r\n" + body
                held.append(ArcRecord(safe_url(url.as_py()), "0.0.0.0", date, "text/html", content))
                size += len(content)
                if size >= ARCHIVE_BYTES:
                    yield batch_rows(schema, [(write_arc(held, 1 + len(held) % 2),)])
                    held, size = [], 0
            if held:
                yield batch_rows(schema, [(write_arc(held, 1 + len(held) % 2),)])
    return run


def arc_archives(pages: DataFrame, date: str = "20000101000000") -> DataFrame:
    """(content): pages (page_id, url, html) as ARC archives of about 2 MB."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return map_arrow(rows, _archives(date), "content binary")


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """(head, payload) of an HTTP message; other content is all payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    at = content.find(b"\r\n\r\n")
    return (content, b"") if at < 0 else (content[:at + 4], content[at + 4:])


def source_id(head: bytes) -> int | None:
    m = re.search(rb"\r\n" + _SOURCE + rb": (-?[0-9]+)\r\n", head)
    return int(m[1]) if m else None


def record_id(source: int | None, digest: str, more: str = "") -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{source}|{digest}|{more if source is None else str()}')}>"


def warc_date(arc: str) -> str:
    d = (arc + "00000000000000")[:14]
    return f"{d[:4]}-{max(d[4:6], '01')}-{max(d[6:8], '01')}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(r: ArcRecord, refers_to: int | None, digest: str | None = None) -> bytes:
    """One WARC record; a revisit if ``refers_to`` is given."""
    head, payload = split_http(r.content)
    source, digest = source_id(head), digest or digest32(payload)
    revisit = refers_to is not None
    block = head if revisit else r.content
    kind = "revisit" if revisit else "response" if head else "resource"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(source, digest, f'{r.url} {r.date}')}",
             f"WARC-Date: {warc_date(r.date)}", f"WARC-Target-URI: {r.url}", f"WARC-IP-Address: {r.ip}",
             f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{digest32(block)}",
             f"X-Payload-Length: {len(payload)}"]
    if source is not None:
        lines.append(f"X-Source-Id: {source}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Source-Id: {refers_to}"]
    lines += [f"Content-Type: {'application/http; msgtype=response' if head else r.mime}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_warc(data: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record."""
    while line := data.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers = {}
        while (line := data.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8").rstrip("\r\n").partition(": ")
            headers[name] = value
        block = data.read(int(headers["Content-Length"]))
        if len(block) != int(headers["Content-Length"]) or data.read(4) != b"\r\n\r\n":
            raise ValueError("a WARC record ends early")
        yield headers, block


_PARSED = pa.schema([("source", pa.int64()), ("digest", pa.string()), ("bytes", pa.int64()), ("url", pa.string()),
                     ("ip", pa.string()), ("date", pa.string()), ("mime", pa.string()), ("content", pa.binary())])


def _parse(with_content: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                out = []
                for r in parse_arc(io.BytesIO(content.as_buffer())):
                    head, payload = split_http(r.content)
                    out.append((source_id(head), digest32(payload), len(payload), r.url, r.ip, r.date, r.mime,
                                r.content if with_content else None))
                yield batch_rows(_PARSED, out)
    return run


def arc_records(archives: DataFrame, with_content: bool = True) -> DataFrame:
    """One row per ARC record of the archives (column ``content``)."""
    return map_arrow(archives.select("content"), _parse(with_content),
                     "source long, digest string, bytes long, url string, ip string, date string, mime string, content binary")


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        location = f"{folder}/part-{TaskContext.get().partitionId():08d}.warc.gz"
        out, n = None, 0
        for batch in batches:
            cols = [batch.column(c) for c in ("url", "ip", "date", "mime", "content", "refers_to", "digest")]
            for *fields, refers_to, digest in zip(*cols):
                r = ArcRecord(*(x.as_py() for x in fields))
                out = out or WholeFile(location)
                out.write(gzip.compress(warc_record(r, refers_to.as_py(), digest.as_py()), 3, mtime=0))
                n += 1
        if out:
            out.close()
            yield batch_rows(pa.schema([("location", pa.string()), ("records", pa.int64())]), [(location, n)])
    return run


def convert(archives: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write the archives' records as WARC files under ``folder`` and return
    the manifest (location, records), one row per file."""
    folder = folder or scratch_path(archives.sparkSession, "warc")
    repeated = arc_records(archives, False).where(F.col("bytes") >= min_bytes).groupBy("digest") \
        .agg(F.max("source").alias("holder"), F.count(F.lit(1)).alias("_n")).where("_n > 1 and holder is not null")
    repeated = materialize(repeated.select(F.col("digest").alias("_d"), "holder"), "repeated-payloads")
    records = arc_records(archives)
    records = records.join(broadcast_if_small(repeated), (F.col("digest") == F.col("_d")) & (F.col("bytes") >= min_bytes),
                           "left")
    refers = F.when(F.coalesce(F.col("source") != F.col("holder"), F.col("holder").isNotNull()), F.col("holder"))
    made = map_arrow(records.withColumn("refers_to", refers).drop("_d", "holder"), _write(folder),
                     "location string, records long")
    return materialize(made, "warc-manifest")


_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()),
                   ("warc_date", pa.string()), ("url", pa.string())])


def _number(x: str | None) -> int | None:
    return None if x is None else int(x)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for location in batch.column("location").to_pylist():
            out = []
            with open_file(location) as f, gzip.GzipFile(fileobj=f, mode="rb") as data:
                for h, block in parse_warc(io.BufferedReader(data, 1 << 16)):
                    digest, size = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["X-Payload-Length"])
                    if digest32(block) != h["WARC-Block-Digest"].removeprefix("sha1:"):
                        raise ValueError(f"{location}: block digest differs")
                    if h["WARC-Type"] != "revisit":
                        payload = split_http(block)[1]
                        if len(payload) != size or digest32(payload) != digest:
                            raise ValueError(f"{location}: payload digest differs")
                    out.append((_number(h.get("X-Source-Id")), size, digest, h["WARC-Type"],
                                _number(h.get("X-Refers-To-Source-Id")), h["WARC-Record-ID"], h["WARC-Date"],
                                h["WARC-Target-URI"]))
                    if len(out) >= 4096:
                        yield batch_rows(_READ, out)
                        out = []
            yield batch_rows(_READ, out)


def read_warc(manifest: DataFrame) -> DataFrame:
    """One row per record of the files, read back and checked."""
    files = manifest.repartition(max(1, manifest.count()))
    return map_arrow(files.select("location"), _read,
                     "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
                     "record_id string, warc_date string, url string")

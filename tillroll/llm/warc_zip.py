"""WARC archives inside ZIP packages: writing them from a table of pages, and reading records by range.

A package holds `archive/data.warc.gz` (stored, one gzip member per record) and `indexes/index.cdxj` (one line per record
with its offset and length in the archive). `read_directory` parses the end record, the ZIP64 locator and end record
where present, and the central directory; `read_packages` finds the stored archive and its index and reads each record
by its range, so nothing is ever extracted and a task holds one record at a time.

Of equal payloads of at least `min_bytes`, the page with the smallest id becomes the response and the others become
revisits that refer to it; a revisit keeps the HTTP header, so the full payload's length stays known.

Writing: pages meet the smallest id of their payload in one join on the payload's hash (adaptive execution splits a hot
payload), and each task streams packages of about `package_bytes` to the shared folder under a name of its own attempt.
Only packages named in the manifest count, and the manifest is written by Spark's own commit, so a lost executor or a
repeated task leaves at most an unnamed file behind.

Defined cases: null html is an empty payload; null url is written as an empty target; a null id counts as larger than
any other; repeated rows with one id and one payload are all responses if the id is the smallest; an empty table gives
no package and no record; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import scratch, staged

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
READ_TASKS = 10_000  # tasks that read; with more packages each reads several
PACKAGE_BYTES = 32 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"

RECORD_SCHEMA = (
    "package string, offset long, length long, record_id string, record_type string, target_uri string, "
    "refers_to string, payload_digest string, payload_bytes long, payload binary"
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def build_record(page_id: int | None, url: str, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit with the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to else 'response'}",
        f"WARC-Record-ID: {record_name(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        *([f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {PROFILE}"] if refers_to else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + CRLF * 2 + block + CRLF * 2


def parse_record(record: bytes) -> dict:
    """The fields of RECORD_SCHEMA that lie in the record itself. A payload that its digest denies is an error."""
    head, _, rest = record.partition(CRLF * 2)
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:20]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(CRLF * 2)
    declared = next(
        (int(v) for k, _, v in (x.partition(b":") for x in http.split(CRLF)) if k.lower() == b"content-length"), None
    )
    stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    revisit = fields["warc-type"] == "revisit"
    if not revisit and stated and digest(payload) != stated:
        raise ValueError(f"payload of {fields.get('warc-record-id')} does not match its digest")
    return {
        "record_id": fields.get("warc-record-id"),
        "record_type": fields["warc-type"],
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "payload_digest": stated or digest(payload),
        "payload_bytes": declared if revisit else len(payload),
        "payload": None if revisit else payload,
    }


@dataclass
class Member:
    name: str
    method: int
    size: int
    header: int

    def start(self, file: pa.NativeFile) -> int:
        """Where the stored bytes begin, from the member's local header. A compressed member cannot be read by range."""
        if self.method != 0:
            raise ValueError(f"member {self.name} is not stored")
        local = file.read_at(30, self.header)
        if local[:4] != b"PK\x03\x04":
            raise ValueError(f"no local header for {self.name}")
        return self.header + 30 + sum(struct.unpack("<HH", local[26:30]))


def read_directory(file: pa.NativeFile) -> list[Member]:
    """All members of a ZIP or ZIP64 file, by its central directory."""
    size = file.size()
    low = max(0, size - (1 << 16) - 22 - 20)
    tail = file.read_at(size - low, low)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    entries, length, offset = struct.unpack_from("<HII", tail, at + 10)
    if at >= 20 and tail[at - 20 : at - 16] == b"PK\x06\x07":
        end64 = file.read_at(56, struct.unpack_from("<Q", tail, at - 12)[0])
        if end64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        entries, length, offset = struct.unpack_from("<QQQ", end64, 32)
    data, at, members = file.read_at(length, offset), 0, []
    for _ in range(entries):
        if data[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        method = struct.unpack_from("<H", data, at + 10)[0]
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", data, at + 20)
        header = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46 : at + 46 + n_name].decode()
        extra, wide = data[at + 46 + n_name : at + 46 + n_name + n_extra], iter(())
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
            extra = extra[4 + n :]
        plain = next(wide) if plain == 0xFFFFFFFF else plain
        packed = next(wide) if packed == 0xFFFFFFFF else packed
        header = next(wide) if header == 0xFFFFFFFF else header
        members.append(Member(name, method, packed, header))
        at += 46 + n_name + n_extra + n_comment
    return members


def read_package(path: str) -> Iterator[dict]:
    """Every record that the index of a package names, each by its own range."""
    system, local = fs.FileSystem.from_uri(path)
    with system.open_input_file(local) as file:
        members = {m.name: m for m in read_directory(file)}
        if ARCHIVE not in members or INDEX not in members:
            raise ValueError(f"{path} holds no {ARCHIVE if ARCHIVE not in members else INDEX}")
        base, index = members[ARCHIVE].start(file), members[INDEX]
        lines = io.BytesIO(file.read_at(index.size, index.start(file)))
        for line in lines:
            place = json.loads(line.split(b" ", 2)[2])
            raw = file.read_at(place["length"], base + place["offset"])
            yield {"package": path, "offset": place["offset"], "length": place["length"]} | parse_record(zlib.decompress(raw, 31))


class PackageWriter:
    """One package, streamed: the archive first, then its index, then the directory."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"
        system, local = fs.FileSystem.from_uri(self.path)
        system.create_dir(local.rsplit("/", 1)[0], recursive=True)
        self.stream = system.open_output_stream(local)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.index: list[str] = []
        self.bytes = 0

    def add(self, page_id: int | None, url: str | None, payload: bytes, refers_to: str | None) -> None:
        url = "".join(c for c in url or "" if c not in "\r\n")
        packer = zlib.compressobj(3, zlib.DEFLATED, 31)
        raw = packer.compress(build_record(page_id, url, payload, refers_to)) + packer.flush()
        place = {"offset": self.bytes, "length": len(raw), "filename": ARCHIVE.rsplit("/", 1)[-1]}
        self.index.append(f"{record_name(page_id)} 20000101000000 {json.dumps(place)}\n")
        self.member.write(raw)
        self.bytes += len(raw)

    def close(self) -> tuple[str, int]:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(self.index))
        self.zip.close()
        self.stream.close()
        return self.path, len(self.index)


def write_packages(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = 0,
    package_bytes: int = PACKAGE_BYTES,
) -> DataFrame:
    """Write every row of `pages` as a record; the manifest (package, records) names the packages that count."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("hash", F.sha2("payload", 256))
    long_enough = rows.select("id", "hash", F.octet_length("payload").alias("n")).filter(F.col("n") >= min_bytes)
    firsts = long_enough.groupBy("hash").agg(F.min("id").alias("first"), F.lit(True).alias("shared"))
    joined = rows.join(firsts, "hash", "left")
    revisit = F.coalesce("shared", F.lit(False)) & ~F.col("id").eqNullSafe(F.col("first"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                page_id, url, payload, is_revisit, first = (c[i].as_py() for c in columns)
                writer = writer or PackageWriter(folder)
                writer.add(page_id, url, payload, record_name(first) if is_revisit else None)
                if writer.bytes >= package_bytes:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        paths, counts = zip(*done) if done else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64())], ["package", "records"])

    ready = joined.select("id", "url", "payload", revisit.alias("revisit"), "first")
    return staged(ready.mapInArrow(write, "package string, records long"), "warc-manifest")


def read_packages(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """The records (RECORD_SCHEMA) of all packages named in the column `package`; payloads are left out on request."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for record in read_package(path):
                    held += len(record["payload"] or b"")
                    rows.append(record if payloads else record | {"payload": None})
                    if len(rows) == 1000 or held > 1 << 24:
                        yield pa.RecordBatch.from_pylist(rows, schema=ARROW_RECORDS)
                        rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema=ARROW_RECORDS)

    # A stated number of partitions is not merged again, so packages are read side by side.
    tasks = max(1, min(packages.count(), READ_TASKS))
    return packages.select("package").repartition(tasks).mapInArrow(read, RECORD_SCHEMA)


ARROW_RECORDS = pa.schema(
    [
        (name, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[kind])
        for name, kind in (field.split() for field in RECORD_SCHEMA.split(", "))
    ]
)


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every page, as read back from the packages."""
    manifest = write_packages(pages, scratch(spark, "warc"), min_bytes=min_bytes)
    return read_packages(manifest, payloads=False).select(
        _page(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        _page(F.col("refers_to")).alias("refers_to"),
    )


def _page(name):
    return F.regexp_extract(name, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")

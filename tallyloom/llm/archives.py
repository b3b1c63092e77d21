"""WARC records in ZIP packages: written by tasks, read back by ranges, never unpacked.

Records are written one after the other, each compressed by itself, into
`archive/data.warc.gz` of a package, a stored member that ZIP does not compress again,
followed by `indexes/records.idx`, a stored member with a line per record: its place and
length. Packages are limited in size and their names are new for every
attempt of a task; only those that the written manifest names are read, so a lost task leaves
at most an unused file. A reader looks for the end of the central directory, takes the ZIP64
directory where there is one, finds both members by their local headers, and reads index and
records by ranges of bytes.

Of records with equal payloads of at least LEAST bytes, the one with the smallest page_id is
the response, the others revisit it and carry no payload. The smallest id of a payload is an
aggregate over digests, so a payload that a third of all pages share is no hot spot.

Cases: null html is empty. A null page_id is written and read as null; it sorts behind all
others. Repeated ids are pages of their own; of equal payloads with one id, each is the
response. An empty table writes no package.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, shared_folder

LEAST = 100  # bytes of a payload that others may revisit
PACKAGE_BYTES = 64 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/records.idx"
LEVEL = 6  # of gzip
DAY = "2020-01-01T00:00:00Z"  # records of a page table have no date of their own

MANIFEST = "path string, records long"
RECORDS = ("page_id long, url string, payload binary, payload_bytes long, "
           "payload_digest string, record_type string, refers_to long")

# Signatures and layouts of the ZIP format.
LOCAL, CENTRAL, END, END64, LOCATOR = (b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06",
                                       b"PK\x06\x06", b"PK\x06\x07")
LOCAL_HEAD = struct.Struct("<4sHHHHHIIIHH")
CENTRAL_HEAD = struct.Struct("<4sHHHHHHIIIHHHHHII")
END_HEAD = struct.Struct("<4sHHHHIIH")
END64_HEAD = struct.Struct("<4sQHHIIQQQQ")
LOCATOR_HEAD = struct.Struct("<4sIQI")
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF


@dataclass
class Member:
    name: str
    method: int
    size: int
    header: int  # where its local header begins


class PackageWriter:
    """Stored members written in one pass, sizes and checksums in the ZIP64 directory.

    With `wide`, every directory entry uses the ZIP64 fields, otherwise only large ones.
    """

    def __init__(self, out: BinaryIO, wide: bool = False):
        self.out, self.wide, self.at, self.done = out, wide, 0, []

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.header, self.crc, self.size = name.encode(), self.at, 0, 0
        # flag 8: sizes follow the data, flag 0x800: the name is UTF-8
        self.write(LOCAL_HEAD.pack(LOCAL, 45, 0x808, 0, 0, 0x21, 0, FULL32, FULL32,
                                   len(self.name), 20) + self.name
                   + struct.pack("<HHQQ", 1, 16, 0, 0))

    def add(self, data: bytes) -> int:
        """Appends to the open member; returns where in it the data begins."""
        before = self.size
        self.write(data)
        self.crc, self.size = zlib.crc32(data, self.crc), before + len(data)
        return before

    def finish(self) -> None:
        self.write(struct.pack("<4sIQQ", b"PK\x07\x08", self.crc, self.size, self.size))
        self.done.append((self.name, self.crc, self.size, self.header))

    def close(self) -> None:
        begin = self.at
        for name, crc, size, header in self.done:
            wide = self.wide or max(size, header) >= FULL32
            extra = struct.pack("<HHQQQ", 1, 24, size, size, header) if wide else b""
            small = (FULL32,) * 3 if wide else (size, size, header)
            self.write(CENTRAL_HEAD.pack(CENTRAL, 45, 45, 0x808, 0, 0, 0x21, crc, *small[:2],
                                         len(name), len(extra), 0, 0, 0, 0, small[2])
                       + name + extra)
        size, n, end = self.at - begin, len(self.done), self.at
        if self.wide or max(size, begin) >= FULL32 or n >= FULL16:
            self.write(END64_HEAD.pack(END64, 44, 45, 45, 0, 0, n, n, size, begin))
            self.write(LOCATOR_HEAD.pack(LOCATOR, 0, end, 1))
            size, begin, n = FULL32, FULL32, FULL16
        self.write(END_HEAD.pack(END, 0, 0, n, n, size, begin, 0))


class PackageReader:
    """Members of a package and ranges of them, by seeks."""

    def __init__(self, source: BinaryIO, size: int):
        self.source, self.size = source, size
        self.members = {m.name: m for m in self._directory()}

    def _range(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def _directory(self) -> Iterator[Member]:
        tail_at = max(0, self.size - END_HEAD.size - FULL16)
        tail = self._range(tail_at, self.size - tail_at)
        found = tail.rfind(END)
        while found >= 0:  # a comment may hold the signature too
            if (len(tail) - found >= END_HEAD.size and found + END_HEAD.size
                    + END_HEAD.unpack_from(tail, found)[7] == len(tail)):
                break
            found = tail.rfind(END, 0, found)
        if found < 0:
            raise ValueError("no end of a central directory: not a ZIP package")
        _, _, _, _, n, size, begin, _ = END_HEAD.unpack_from(tail, found)
        if n == FULL16 or FULL32 in (size, begin):
            locator = self._range(tail_at + found - LOCATOR_HEAD.size, LOCATOR_HEAD.size)
            if locator[:4] == LOCATOR:
                end64 = self._range(LOCATOR_HEAD.unpack(locator)[2], END64_HEAD.size)
                n, size, begin = END64_HEAD.unpack(end64)[7:]
        data, at = self._range(begin, size), 0
        for _ in range(n):
            head = CENTRAL_HEAD.unpack_from(data, at)
            if head[0] != CENTRAL:
                raise ValueError("broken central directory")
            packed, plain, header = head[8], head[9], head[16]
            name_n, extra_n, note_n = head[10:13]
            at += CENTRAL_HEAD.size
            name = data[at:at + name_n].decode()
            extra, x = data[at + name_n:at + name_n + extra_n], 0
            while x + 4 <= len(extra):
                kind, n_bytes = struct.unpack_from("<HH", extra, x)
                if kind == 1:
                    wide = iter(struct.unpack_from(f"<{n_bytes // 8}Q", extra, x + 4))
                    plain = next(wide) if plain == FULL32 else plain
                    packed = next(wide) if packed == FULL32 else packed
                    header = next(wide) if header == FULL32 else header
                x += 4 + n_bytes
            at += name_n + extra_n + note_n
            yield Member(name, head[4], packed, header)

    def begin_of(self, name: str) -> int:
        """Where the data of a stored member begins."""
        m = self.members[name]
        if m.method:
            raise ValueError(f"{name} is compressed: it can't be read by ranges")
        head = LOCAL_HEAD.unpack(self._range(m.header, LOCAL_HEAD.size))
        if head[0] != LOCAL:
            raise ValueError(f"no local header of {name}")
        return m.header + LOCAL_HEAD.size + head[9] + head[10]

    def read(self, name: str) -> bytes:
        return self._range(self.begin_of(name), self.members[name].size)

    def records(self) -> Iterator[dict]:
        """All WARC records that the index lists."""
        begin = self.begin_of(DATA)
        for line in self.read(INDEX).decode().splitlines():
            at, n = map(int, line.split())
            yield parse_record(self._range(begin + at, n))


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str,
                refers_to: int | None, revisit: bool) -> bytes:
    """A compressed WARC/1.1 record; the payload is a response's block, a revisit has none."""
    head = [("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DAY)]
    if url is not None:
        clean = "".join(f"%{ord(c):02X}" if c < " " else c for c in url)
        head.append(("WARC-Target-URI", clean))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    head += [("WARC-Payload-Digest", f"sha256:{digest}"),
             ("X-Payload-Length", str(len(payload)))]
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/"
                  "identical-payload-digest"), ("X-Refers-To-Page-ID", str(refers_to))]
        payload = b""
    head += [("Content-Type", "text/html"), ("Content-Length", str(len(payload)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    whole = b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + payload + b"\r\n\r\n"
    return gzip.compress(whole, LEVEL, mtime=0)


def parse_record(data: bytes) -> dict:
    """A record, compressed or plain."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    top, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = top.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = dict(line.split(": ", 1) for line in lines)
    number = {k: int(v) for k, v in head.items() if k.startswith("X-")}
    return {"page_id": number.get("X-Page-ID"), "url": head.get("WARC-Target-URI"),
            "payload": rest[:int(head["Content-Length"])],
            "payload_bytes": number["X-Payload-Length"],
            "payload_digest": head["WARC-Payload-Digest"].removeprefix("sha256:"),
            "record_type": head["WARC-Type"], "refers_to": number.get("X-Refers-To-Page-ID")}


def with_responses(pages: DataFrame, key: str = "page_id", url: str = "url",
                   html: str = "html") -> DataFrame:
    """page_id, url, payload, digest, refers_to (null for responses), revisit."""
    slim = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    first = slim.where(F.octet_length("payload") >= LEAST).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = slim.join(first.withColumnRenamed("digest", "first_digest"),
                       F.col("digest") == F.col("first_digest"), "left")
    revisit = (F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")))
    return joined.select("page_id", "url", "payload", "digest",
                         F.when(revisit, F.col("first_id")).alias("refers_to"),
                         revisit.alias("revisit"))


def write_packages(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url",
                   html: str = "html", package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes all pages; returns the manifest (path, records), itself written."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        package = out = None

        def close() -> pa.RecordBatch:
            package.finish()
            package.begin(INDEX)
            package.add(index.getvalue())
            package.finish()
            package.close()
            out.close()
            return pa.record_batch({"path": pa.array([path]), "records": pa.array([n])})

        for batch in batches:
            for row in batch.to_pylist():
                if package is None:
                    path, n, index = f"{root}/{uuid.uuid4().hex}.zip", 0, io.BytesIO()
                    out = store.open_output_stream(path)
                    package = PackageWriter(out)
                    package.begin(DATA)
                record = warc_record(row["page_id"], row["url"], row["payload"], row["digest"],
                                     row["refers_to"], row["revisit"])
                index.write(b"%d %d\n" % (package.add(record), len(record)))
                n += 1
                if package.size >= package_bytes:
                    yield close()
                    package = None
        if package is not None:
            yield close()

    return cut(with_responses(pages, key, url, html).mapInArrow(task, MANIFEST))


def read_packages(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """All records of the packages, found by their indexes. A package is one task's work."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()),
                            ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("record_type", pa.string()),
                            ("refers_to", pa.int64())])
        for batch in batches:
            for path, n in zip(*(c.to_pylist() for c in batch.columns)):
                with store.open_input_file(path) as source:
                    rows, seen, held = [], 0, 0
                    for row in PackageReader(source, source.size()).records():
                        block = row["payload"]
                        if row["record_type"] == "response" and hashlib.sha256(
                                block).hexdigest() != row["payload_digest"]:
                            raise ValueError(f"a record of {path} does not match its digest")
                        row["payload"] = block if payloads else None
                        rows.append(row)
                        seen, held = seen + 1, held + len(block)
                        if held > 8 << 20 or len(rows) >= 10_000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    if seen != n:
                        raise ValueError(f"{path} has {seen} records, not {n}")
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    parts = max(1, manifest.sparkSession.sparkContext.defaultParallelism * 4)
    return manifest.repartition(parts, "path").mapInArrow(task, RECORDS)


def round_trip(pages: DataFrame, spark: SparkSession, payloads: bool = False) -> DataFrame:
    """Writes packages to the shared folder and reads them back."""
    folder = shared_folder(spark, "packages")
    folder = folder if "://" in folder else f"file://{folder}"
    return read_packages(write_packages(pages, folder), folder, payloads)

"""WARC archives in ZIP packages: written by tasks, read by byte ranges without extraction.

A package holds `archive/data.warc.gz` (one gzip member a record) and `indexes/index.cdxj`,
both stored, not deflated, by the ZIP. The reader parses the end of the file, its ZIP64
counterparts and the central directory, finds where stored members begin, takes record places
from the index, and reads just the ranges of the records it is asked for.

Of records with equal payloads of `least_bytes` or more the one with the smallest page_id is a
response; others are revisits of it, without payload but with its digest and length. Groups
of equal payloads are found by a combined aggregate over digests, whatever their size.

A task writes packages under names of its own and reports them; the report is stored once and
only packages in it are read. Defined results: a null html is an empty payload; smaller
payloads are always responses; rows that repeat a page_id with one payload are responses
alike; a null page_id is never a response's target but may revisit one; an empty table writes
nothing and reads nothing; other columns are left out.
"""

from __future__ import annotations

import json
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm.shared_files import at, made
from hazeline.llm.shipping import ship
from hazeline.scratch import new_dir

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES = 512_000_000
RANGE_BYTES = 4_000_000
LEAST_BYTES = 100
WHEN = "2024-01-01T00:00:00Z"

# Signatures of the ZIP format.
_LOCAL, _CENTRAL, _END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
_END64, _LOCATOR = b"PK\x06\x06", b"PK\x06\x07"
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int  # as it lies in the package
    header: int


class Package:
    """The members of a ZIP, from its central directory."""

    def __init__(self, uri: str):
        system, path = at(uri)
        self.file = system.open_input_file(path)
        self.length = self.file.size()
        self.members = {m.name: m for m in self._central()}

    def read(self, start: int, size: int) -> bytes:
        return self.file.read_at(size, start)

    def _central(self) -> Iterator[Member]:
        # The end record is 22 bytes and a comment of at most 65,535.
        tail_at = max(0, self.length - 22 - 65_535)
        tail = self.read(tail_at, self.length - tail_at)
        end = tail.rfind(_END)
        if end < 0:
            raise ValueError("no end of central directory: this is no ZIP file")
        entries, size, start = struct.unpack_from("<HII", tail, end + 10)
        if entries == _FULL16 or size == _FULL32 or start == _FULL32:
            locator_at = tail_at + end - 20
            locator = self.read(locator_at, 20)
            if locator[:4] != _LOCATOR:
                raise ValueError("the ZIP64 locator is missing")
            record = self.read(struct.unpack_from("<Q", locator, 8)[0], 56)
            if record[:4] != _END64:
                raise ValueError("the ZIP64 end record is missing")
            entries, size, start = struct.unpack_from("<QQQ", record, 32)
        directory = self.read(start, size)
        place = 0
        for _ in range(entries):
            if directory[place : place + 4] != _CENTRAL:
                raise ValueError("the central directory is cut short")
            method = struct.unpack_from("<H", directory, place + 10)[0]
            packed, plain = struct.unpack_from("<II", directory, place + 20)
            names, extras, comments = struct.unpack_from("<HHH", directory, place + 28)
            header = struct.unpack_from("<I", directory, place + 42)[0]
            name = directory[place + 46 : place + 46 + names].decode()
            extra = directory[place + 46 + names : place + 46 + names + extras]
            packed, header = self._wide(extra, plain, packed, header)
            yield Member(name, method, packed, header)
            place += 46 + names + extras + comments

    @staticmethod
    def _wide(extra: bytes, plain: int, packed: int, header: int) -> tuple[int, int]:
        """Size and place, from the ZIP64 field where the short ones are full."""
        at_ = 0
        while at_ + 4 <= len(extra):
            kind, size = struct.unpack_from("<HH", extra, at_)
            if kind == 1:
                values = iter(struct.unpack_from(f"<{size // 8}Q", extra, at_ + 4))
                if plain == _FULL32:
                    next(values)
                packed = next(values) if packed == _FULL32 else packed
                header = next(values) if header == _FULL32 else header
            at_ += 4 + size
        return packed, header

    def start(self, name: str) -> int:
        """Where a stored member's bytes begin."""
        member = self.members[name]
        if member.method != 0:
            raise ValueError(f"{name} is compressed by the ZIP; ranges of it can't be read")
        local = self.read(member.header, 30)
        if local[:4] != _LOCAL:
            raise ValueError(f"{name} is not where the directory says")
        names, extras = struct.unpack_from("<HH", local, 26)
        return member.header + 30 + names + extras

    def index(self) -> Iterator[dict]:
        lines = self.read(self.start(INDEX), self.members[INDEX].size)
        for line in lines.split(b"\n"):
            if line:
                yield json.loads(line)


def _line(value: str) -> str:
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in value)


def record_bytes(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member."""
    revisit = refers_to is not None
    body = b"" if revisit else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
        f"WARC-Date: {WHEN}",
        f"WARC-Target-URI: {_line(url)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    if revisit:
        head += [
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To-Length: {len(payload)}",
        ]
    packer = zlib.compressobj(5, zlib.DEFLATED, 31)
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    return packer.compress(whole) + packer.flush()


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, names in lower case, and content of one gzip member."""
    whole = zlib.decompress(data, 31)
    end = whole.index(b"\r\n\r\n")
    lines = whole[:end].decode().split("\r\n")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    return headers, whole[end + 4 : end + 4 + int(headers["content-length"])]


def _page(urn: str) -> int | None:
    text = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "none" else int(text)


def write_packages(pages: DataFrame, least_bytes: int = LEAST_BYTES, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write a record for each page; the stored report: path and number of records."""
    spark = pages.sparkSession
    ship(spark)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    held = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"))
    held = held.withColumn("digest", F.sha2("payload", 256))
    groups = (
        held.filter(F.octet_length("payload") >= least_bytes)
        .groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1 AND first IS NOT NULL").select("digest", "first")
    )
    # Stored, so that the join below knows how small it is before it moves any page.
    stored = new_dir(spark, "payload-groups")
    groups.write.parquet(stored)
    rows = held.join(spark.read.parquet(stored), "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.coalesce(F.col("page_id") != F.col("first"), F.lit(True)), F.col("first")).alias("refers_to"),
    )
    folder = new_dir(spark, "packages")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made(folder)
        written: list[tuple[str, int]] = []
        rows_left = ((row for row in batch.to_pylist()) for part in batches for batch in _small(part))
        stream = (row for batch in rows_left for row in batch)
        row = next(stream, None)
        while row is not None:
            uri = f"{folder}/{uuid4().hex}.wacz"
            system, path = at(uri)
            index, offset = [], 0
            with system.open_output_stream(path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
                with package.open(ARCHIVE, "w", force_zip64=True) as member:
                    while row is not None and offset < package_bytes:
                        data = record_bytes(*(row[k] for k in ("page_id", "url", "payload", "digest", "refers_to")))
                        member.write(data)
                        index.append((row["url"], offset, len(data)))
                        offset += len(data)
                        row = next(stream, None)
                with package.open(INDEX, "w", force_zip64=True) as member:
                    for url, start, size in index:
                        line = json.dumps({"url": url, "offset": start, "length": size, "filename": ARCHIVE})
                        member.write(line.encode() + b"\n")
            written.append((uri, len(index)))
        if written:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*written)], names=["path", "records"])

    report = new_dir(spark, "package-report")
    rows.mapInArrow(write, "path string, records long").write.parquet(report)
    return spark.read.parquet(report)


def _small(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def read_packages(spark: SparkSession, report: DataFrame) -> DataFrame:
    """page_id, url, record_type, refers_to, digest and size as the record states them, and
    payload (null for a revisit)."""
    ship(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of records of about RANGE_BYTES, by the index."""
        kinds = [pa.string(), pa.int64(), pa.list_(pa.int64())]
        for batch in batches:
            for row in batch.to_pylist():
                package = Package(row["path"])
                start = package.start(ARCHIVE)
                runs: list[tuple[str, int, list[int]]] = []
                for entry in package.index():
                    if not runs or sum(runs[-1][2][-1:]) >= RANGE_BYTES or not runs[-1][2]:
                        runs.append((row["path"], start + entry["offset"], [0]))
                    runs[-1][2].append(runs[-1][2][-1] + entry["length"])
                if runs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*runs), kinds)], names=["path", "start", "marks"]
                    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        names = ["page_id", "url", "record_type", "refers_to", "digest", "size", "payload"]
        for batch in batches:
            for run in batch.to_pylist():
                system, path = at(run["path"])
                marks = run["marks"]
                with system.open_input_file(path) as file:
                    data = file.read_at(marks[-1], run["start"])
                rows = []
                for a, b in zip(marks, marks[1:]):
                    head, payload = parse_record(data[a:b])
                    revisit = head["warc-type"] == "revisit"
                    rows.append(
                        (
                            _page(head["warc-record-id"]), head["warc-target-uri"], head["warc-type"],
                            _page(head["warc-refers-to"]) if revisit else None,
                            head["warc-payload-digest"].removeprefix("sha256:"),
                            int(head["warc-refers-to-length"]) if revisit else len(payload),
                            None if revisit else payload,
                        )
                    )
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    runs = report.select("path").repartition(parts, "path").mapInArrow(
        locate, "path string, start long, marks array<long>"
    )
    return runs.repartition(parts, "path", "start").mapInArrow(
        read,
        "page_id long, url string, record_type string, refers_to long, digest string, size long, payload binary",
    )

"""WARC records in ZIP packages: written per task, read by ranges through the packages' own directories."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fitledger.session import broadcast_if_small, saved_table

RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
READ_BYTES, MAX_READERS = 4 << 20, 20_000
MANIFEST_SCHEMA = "path string, n_records long, n_bytes long"
RECORD_SCHEMA = ("record_id string, url string, record_type string, refers_to string, payload_digest string, "
                 "payload_bytes long, payload binary")
_END, _END64, _LOCATOR = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_ENTRY, _LOCAL = b"PK\x01\x02", b"PK\x03\x04"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


# ---- writing

def _record(kind: str, record_id: str, url: str | None, date: str, payload: bytes, digest: str,
            refers_to: str | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if kind == "response" else b"")
    head = {
        "WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": date,
        "WARC-Target-URI": None if url is None else "".join(
            c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace"))
            for c in url),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Refers-To": None if refers_to is None else f"<{refers_to}>",
        "WARC-Profile": None if kind == "response"
        else "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block)),
    }
    lines = "".join(f"{name}: {value}\r\n" for name, value in head.items() if value is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


class _Package:
    """One ZIP package under way: a stored member of gzipped records, then a stored index of them."""

    def __init__(self, folder: str):
        system, path = _filesystem(f"{folder}/{uuid.uuid4().hex}.wacz")
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.uri = f"{folder}/{path.rpartition('/')[2]}"
        self.stream = system.open_output_stream(path)
        self.package = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.package.open(zipfile.ZipInfo(RECORDS), "w", force_zip64=True)
        self.index, self.offset = [], 0

    def add(self, record_id: str, record: bytes) -> None:
        packed = gzip.compress(record, 6, mtime=0)
        self.member.write(packed)
        self.index.append(json.dumps({"id": record_id, "offset": self.offset, "length": len(packed)}))
        self.offset += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        with self.package.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as member:
            member.write("\n".join(self.index).encode())
        self.package.close()
        self.stream.close()
        return self.uri, len(self.index), self.offset


def write_archives(records: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z",
                   package_bytes: int = 64 << 20) -> DataFrame:
    """Write (record_id, url, payload, record_type, refers_to) rows as packages; returns the lazy manifest.

    Each task streams its rows into packages of some ``package_bytes`` under names of their own. A task
    that is run again writes new ones, and only packages of successful tasks are in the manifest, so
    materialise it once and read by it, never by listing the folder. Null payloads are empty.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        package = None
        for batch in batches:
            for row in batch.itertuples():
                if package is None:
                    package = _Package(folder)
                payload = b"" if row.payload is None else row.payload.encode()
                package.add(row.record_id, _record(
                    row.record_type, row.record_id, row.url, date, payload, base32_sha1(payload), row.refers_to))
                if package.offset >= package_bytes:
                    yield pd.DataFrame([package.close()], columns=["path", "n_records", "n_bytes"])
                    package = None
        if package is not None:
            yield pd.DataFrame([package.close()], columns=["path", "n_records", "n_bytes"])

    return records.select("record_id", "url", "payload", "record_type", "refers_to").mapInPandas(write, MANIFEST_SCHEMA)


# ---- reading

def members(read_at, size: int) -> dict[str, tuple[int, int, int]]:
    """Name to (method, offset of data, stored bytes), from the central directory, ZIP64 fields included."""
    tail = read_at(max(0, size - 65_557 - 20), min(size, 65_557 + 20))
    end = tail.rfind(_END)
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if end >= 20 and tail[end - 20:end - 16] == _LOCATOR and (count == 0xFFFF or 0xFFFFFFFF in (length, start)):
        at, = struct.unpack_from("<Q", tail, end - 12)
        end64 = read_at(at, 56)
        if end64[:4] != _END64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", end64, 32)
    directory, at, found = read_at(start, length), 0, {}
    for _ in range(count):
        if directory[at:at + 4] != _ENTRY:
            raise ValueError("broken central directory")
        method, = struct.unpack_from("<H", directory, at + 10)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, at + 20)
        local, = struct.unpack_from("<I", directory, at + 42)
        name = directory[at + 46:at + 46 + n_name].decode()
        extra, field = directory[at + 46 + n_name:at + 46 + n_name + n_extra], 0
        while field + 4 <= len(extra):
            tag, n = struct.unpack_from("<HH", extra, field)
            if tag == 1:  # the fields that are full in the entry, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, field + 4))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                local = next(wide) if local == 0xFFFFFFFF else local
            field += 4 + n
        head = read_at(local, 30)
        if head[:4] != _LOCAL:
            raise ValueError("broken local header")
        found[name] = (method, local + 30 + sum(struct.unpack_from("<HH", head, 26)), packed)
        at += 46 + n_name + n_extra + n_comment
    return found


def _headers(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)


def parse_record(raw: bytes) -> tuple:
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = _headers(head)
    http, _, payload = rest[:int(warc["Content-Length"])].partition(b"\r\n\r\n")
    digest = warc["WARC-Payload-Digest"].removeprefix("sha1:")
    if warc["WARC-Type"] == "response" and base32_sha1(payload) != digest:
        raise ValueError("payload differs from its digest")
    refers_to = warc.get("WARC-Refers-To")
    return (warc["WARC-Record-ID"].strip("<>"), warc.get("WARC-Target-URI"), warc["WARC-Type"],
            refers_to and refers_to.strip("<>"), digest, int(_headers(http)["Content-Length"]), payload)


def read_package(uri: str) -> Iterator[tuple]:
    """The records of one package, by ranges of neighbouring records of some 4 MB."""
    system, path = _filesystem(uri)
    with system.open_input_file(path) as file:
        read_at = lambda offset, n: file.read_at(n, offset)
        found = members(read_at, file.size())
        for name in (RECORDS, INDEX):
            if found[name][0] != zipfile.ZIP_STORED:
                raise ValueError(f"{name} isn't stored")
        _, base, _ = found[RECORDS]
        lines = read_at(found[INDEX][1], found[INDEX][2]).splitlines()
        entries = sorted((e["offset"], e["length"]) for e in map(json.loads, lines))
        first = 0
        while first < len(entries):
            last, start = first, entries[first][0]
            while last + 1 < len(entries) and sum(entries[last + 1]) - start <= READ_BYTES:
                last += 1
            block = read_at(base + start, sum(entries[last]) - start)
            for offset, length in entries[first:last + 1]:
                yield parse_record(gzip.decompress(block[offset - start:offset - start + length]))
            first = last + 1


def read_archives(manifest: DataFrame, partitions: int | None = None) -> DataFrame:
    """All records of the packages in a manifest: id, url, type, digest, payload's full length and payload.

    Packages are of about one size and are dealt evenly over tasks: one for each, up to ``MAX_READERS`` tasks.
    """
    names = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]
    schema = pa.schema([(n, pa.binary() if n == "payload" else pa.int64() if n == "payload_bytes" else pa.string())
                        for n in names])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                held, size = [], 0
                for record in read_package(uri):
                    held.append(record)
                    size += len(record[-1])
                    if size >= READ_BYTES or len(held) >= 1024:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in held], schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in held], schema)

    if partitions is None:
        partitions = max(1, min(MAX_READERS, manifest.count()))
    paths = manifest.select("path").repartition(partitions)
    return paths.mapInArrow(read, RECORD_SCHEMA)


# ---- duplicates

def with_revisits(pages: DataFrame, id_column: str = "page_id", url_column: str = "url",
                  payload_column: str = "html", min_bytes: int = 0) -> DataFrame:
    """Rows for :func:`write_archives`: of equal payloads that with the smallest id is the response.

    The others are revisits that refer to it. Payloads below ``min_bytes`` are always responses, and so
    are rows that share the smallest id, and payloads whose rows have no id at all. The id becomes the last part
    of the record's URN; a null id is left out there. Only ids and digests are grouped, so a payload that a
    third of the rows share costs one row for each task of the grouping; the payloads themselves are shuffled, by digest, only
    where more than a million of them repeat.
    """
    payload = F.coalesce(F.col(payload_column), F.lit(""))
    rows = pages.select(F.col(id_column).cast("string").alias("id"), F.col(id_column).alias("number"),
                        F.col(url_column).alias("url"), payload.alias("payload"), F.sha1(payload).alias("digest"))
    firsts = (rows.where(F.octet_length("payload") >= min_bytes)
              .groupBy("digest").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("copies"))
              .where("copies > 1 and first is not null").select("digest", "first"))
    # Written once, so that counting them is cheap; if they are few, no payload is shuffled.
    firsts = broadcast_if_small(saved_table(firsts, "archive-firsts"))
    revisit = F.coalesce((F.octet_length("payload") >= min_bytes) & F.col("first").isNotNull()
                         & ~F.col("number").eqNullSafe(F.col("first")), F.lit(False))
    return rows.join(firsts, "digest", "left").select(
        _urn(F.col("id")).alias("record_id"), "url", "payload",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, _urn(F.col("first").cast("string"))).alias("refers_to"))


def _urn(id_):
    return F.concat(F.lit("urn:page:"), F.coalesce(id_, F.lit("")))


def urn_id(column: str):
    """The id within a record's URN; null where the row had none."""
    found = F.substring_index(column, ":", -1)
    return F.when(found != "", found.cast("long"))

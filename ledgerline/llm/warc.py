"""WARC records in ZIP packages: write, then range-read without extraction.

Writing: of records with equal payloads the smallest page_id is the response
and the others are revisits that name it. That is one small group-by and a join
by digest (a hot digest is split like any skewed join). Every task streams its
rows into one package in the shared folder: a stored member
``archive/data.warc.gz`` (one gzip member per record) and a stored member
``indexes/index.cdxj`` (one sorted line per record: key, time and a JSON object
with offset, length and file name). The package's name is unique to the attempt, and only names that come back through the
written manifest are read, so a lost or repeated task leaves no trace.

Reading: the end record of a package (or its ZIP64 form) gives the central
directory, that gives the place of the stored members, the indexes (CDXJ or CDX
lines, gzipped or not, over any number of ``archive/`` members) give byte
ranges. Ranges are dealt out in blocks over as many tasks as the packages' bytes
ask for, and each block is read by position; nothing is unpacked to disk.
Payload digests are worked out anew from what was read and must agree with the
record's header. Packages made elsewhere are read too: request, metadata and
other records that hold no page are left out, and what a record doesn't state
(page id, referred page, digest) is NULL or worked out.

Defined results: a NULL payload is empty (0 bytes, the digest of nothing);
records smaller than ``min_bytes`` are always responses; repeated rows with one
page_id and payload are responses each (none revisits itself); NULL page_ids
come after all others; an empty table gives no package; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import os
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import checkpoint_dir
from ledgerline.sources.tables import materialize

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
BLOCK_BYTES = 4 << 20
GAP_BYTES = 64 << 10         # between records that are read together
MOST_TASKS = 100_000         # of one stage; each then reads several blocks
_BLOCK = ["package", "size", "member", "start", "offsets", "lengths"]
GZIP_LEVEL = 4
DATE = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Signatures and sizes of the ZIP format.
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
STORED, ZIP64_EXTRA, MAX32, MAX16 = 0, 1, 0xFFFFFFFF, 0xFFFF


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- WARC records ---------------------------------------------------------

def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One response record, or a revisit record that holds the response's headers only."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    target = "".join(c for c in (url or "") if c not in "\r\n")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{page_id}')}>"),
        ("WARC-Date", DATE), ("WARC-Target-URI", target), ("WARC-Page-ID", "" if page_id is None else str(page_id)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        *([("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{refers_to}')}>"),
           ("WARC-Refers-To-Page", str(refers_to))] if revisit else []),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields (names in lower case) and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:20]!r}")
    fields = _fields(lines)
    block = rest[:int(fields["content-length"])]
    if len(block) != int(fields["content-length"]):
        raise ValueError("a WARC record breaks off")
    if not fields.get("content-type", "").startswith("application/http"):
        return fields, {}, block
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, _fields(http.decode("utf-8", "replace").split("\r\n")[1:]), payload


def _fields(lines: list[str]) -> dict[str, str]:
    """Header lines by lower-case name; a line that begins with white space goes on with the one before."""
    found, last = {}, None
    for line in lines:
        if line[:1] in (" ", "\t") and last:
            found[last] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = name.strip().lower()
            found[last] = value.strip()
    return found


# --- ZIP packages ---------------------------------------------------------

class Member(NamedTuple):
    name: str
    method: int
    size: int
    header_at: int


class Package:
    """Central directory of a ZIP file, read by position from its end."""

    def __init__(self, file, size: int | None = None):
        self.file = file
        self.size = size if size is not None else file.seek(0, os.SEEK_END)
        count, length, at = self._directory()
        self.members = {m.name: m for m in self._entries(self.read(at, length), count)}

    def read(self, at: int, length: int) -> bytes:
        self.file.seek(at)
        data = self.file.read(length)
        if len(data) != length:
            raise ValueError(f"package ends before {at + length}")
        return data

    def _directory(self) -> tuple[int, int, int]:
        """Number of entries, length and place of the central directory."""
        tail_at = max(0, self.size - (22 + MAX16))
        tail = self.read(tail_at, self.size - tail_at)
        found = len(tail)
        while (found := tail.rfind(END, 0, found)) >= 0:  # the comment may hold the signature too
            if found + 22 <= len(tail) and found + 22 + struct.unpack_from("<H", tail, found + 20)[0] == len(tail):
                break
        else:
            raise ValueError("no end record: not a ZIP package")
        count, length, at = struct.unpack_from("<HII", tail, found + 10)
        if count == MAX16 or length == MAX32 or at == MAX32:
            place = tail_at + found - 20
            locator = self.read(place, 20) if place >= 0 else b""
            if locator[:4] == LOCATOR64:
                record = self.read(struct.unpack_from("<Q", locator, 8)[0], 56)
                if record[:4] != END64:
                    raise ValueError("no ZIP64 end record where its locator points")
                count, length, at = struct.unpack_from("<QQQ", record, 32)
        return count, length, at

    @staticmethod
    def _entries(directory: bytes, count: int) -> Iterator[Member]:
        at = 0
        for _ in range(count):
            if directory[at:at + 4] != ENTRY:
                raise ValueError("the central directory breaks off")
            flags, method = struct.unpack_from("<HH", directory, at + 8)
            packed, size, name_n, extra_n, comment_n = struct.unpack_from("<IIHHH", directory, at + 20)
            header_at, = struct.unpack_from("<I", directory, at + 42)
            name = directory[at + 46:at + 46 + name_n].decode("utf-8" if flags & 0x800 else "cp437")
            wide = Package._zip64(directory[at + 46 + name_n:at + 46 + name_n + extra_n])
            # the 64-bit values stand in this order, each only where its short form is full
            if size == MAX32:
                size = next(wide)
            if packed == MAX32:
                packed = next(wide)
            if header_at == MAX32:
                header_at = next(wide)
            yield Member(name, method, packed, header_at)
            at += 46 + name_n + extra_n + comment_n

    @staticmethod
    def _zip64(extra: bytes) -> Iterator[int]:
        at = 0
        while at + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, at)
            if kind == ZIP64_EXTRA:
                return iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            at += 4 + n
        return iter(())

    def data_at(self, name: str) -> int:
        """Place of a stored member's first byte (names in local headers may differ in length)."""
        member = self.members[name]
        if member.method != STORED:
            raise ValueError(f"{name} is compressed: it can't be range-read")
        header = self.read(member.header_at, 30)
        if header[:4] != LOCAL:
            raise ValueError(f"no local header of {name}")
        name_n, extra_n = struct.unpack_from("<HH", header, 26)
        return member.header_at + 30 + name_n + extra_n

    def range(self, name: str, offset: int, length: int) -> bytes:
        if offset + length > self.members[name].size:
            raise ValueError(f"range beyond {name}")
        return self.read(self.data_at(name) + offset, length)

    def member(self, name: str) -> bytes:
        return self.range(name, 0, self.members[name].size)


def _file_system(uri: str):
    """A file system that executors share, by the URI of the folder (local path, hdfs, s3, ...)."""
    from pyarrow import fs
    system, path = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
    return system, path


def write_package(stream: io.RawIOBase, records: Iterator[tuple[int | None, str, str, bytes]]) -> tuple[int, int]:
    """Write gzipped records (page_id, url, digest, bytes) and their index as stored members; the number of records and the data's bytes."""
    index, at = [], 0
    with zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED, allowZip64=True) as package:
        with package.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as data:
            for page_id, url, digest, raw in records:
                packed = gzip.compress(raw, GZIP_LEVEL, mtime=0)
                data.write(packed)
                entry = {"url": url, "digest": f"sha1:{digest}", "mime": "text/html", "status": "200", "offset": str(at),
                         "length": str(len(packed)), "filename": DATA.rsplit("/", 1)[1], "page_id": page_id}
                index.append(f"{sort_key(url)} {''.join(c for c in DATE if c.isdigit())} {json.dumps(entry)}")
                at += len(packed)
        with package.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as out:
            out.write("\n".join(sorted(index)).encode())
    return len(index), at


def sort_key(url: str) -> str:
    """Host parts from the right, then the rest: pages of one site stand together in an index."""
    host, _, path = re.sub(r"^\w+://(?:www\d*\.)?", "", url.lower()).partition("/")
    return re.sub(r"\s", "%20", f"{','.join(reversed(host.split('.')))})/{path}")


def index_lines(text: str) -> Iterator[tuple[str, int, int]]:
    """(file name, offset, length) of CDXJ lines (key, time, JSON) or of CDX lines, whose first line names the fields."""
    letters: list[str] = []
    for line in text.splitlines():
        if line.lstrip().startswith("CDX "):
            letters = line.split()[1:]
        elif "{" in line and not line.startswith("!"):
            entry = json.loads(line[line.index("{"):])
            yield entry.get("filename", ""), int(entry["offset"]), int(entry["length"])
        elif letters and len(cells := line.split()) == len(letters):
            entry = dict(zip(letters, cells))
            yield entry["g"], int(entry["V"]), int(entry["S"])


def read_index(package: Package) -> list[tuple[str, int, int]]:
    """(member, offset, length) of every indexed record, in the order of their places."""
    found = set()
    for name in package.members:
        if not re.fullmatch(r"indexes/.+\.cdxj?(\.gz)?", name):
            continue
        raw = package.member(name)
        for filename, offset, length in index_lines((gzip.decompress(raw) if name.endswith(".gz") else raw).decode()):
            member = next((m for m in (f"archive/{filename}", filename) if m in package.members), None)
            if member is None:
                raise ValueError(f"an index names {filename!r}, which the package doesn't hold")
            found.add((member, offset, length))
    return sorted(found)


# --- Spark ----------------------------------------------------------------

def with_references(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Add payload, digest and refers_to (the smallest page_id of equal payloads, for the others)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    first = (rows.where(F.octet_length("payload") >= min_bytes).groupBy(F.col("digest").alias("of"))
             .agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies"))
    joined = rows.join(first, rows["digest"] == first["of"], "left")
    return joined.withColumn("refers_to", F.when(F.col("page_id").isNull() | (F.col("first") < F.col("page_id")), F.col("first"))).drop("of", "first")


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write one record per page into packages in a shared folder; their manifest (path, size, records)."""
    spark = pages.sparkSession
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/archives-{uuid.uuid4().hex[:12]}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _file_system(folder)

        def records(first: pa.RecordBatch) -> Iterator[tuple[int | None, str, str, bytes]]:
            batch = first
            while batch is not None:
                for i, (page_id, url, digest, ref) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("page_id", "url", "digest", "refers_to")))):
                    payload = batch.column("payload")[i].as_py()
                    b32 = base64.b32encode(bytes.fromhex(digest)).decode()
                    yield page_id, url or "", b32, record_bytes(page_id, url, payload, b32, ref)
                batch = next(batches, None)

        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        system.create_dir(path, recursive=True)
        name = f"pages-{uuid.uuid4().hex}.zip"
        with system.open_output_stream(f"{path}/{name}") as out:
            count, _ = write_package(out, records(first))
        size = system.get_file_info(f"{path}/{name}").size
        yield pa.RecordBatch.from_pydict({"package": [f"{folder}/{name}"], "size": [size], "records": [count]})

    rows = with_references(pages, min_bytes)
    return materialize(rows.mapInArrow(write, "package string, size long, records long"), "manifest")


def manifest_of(spark: SparkSession, packages: list[str]) -> DataFrame:
    """A manifest (package, size) of packages that were made elsewhere."""

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uris = batch.column(0).to_pylist()
            places = [_file_system(uri) for uri in uris]
            yield pa.RecordBatch.from_pydict({"package": uris, "size": [system.get_file_info(path).size for system, path in places]})

    return materialize(spark.createDataFrame([(p,) for p in packages], "package string").mapInArrow(sized, "package string, size long"), "manifest")


def read_blocks(manifest: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Byte ranges of whole records, from each package's directory and indexes: package, size, member, start, offsets, lengths."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, size in zip(*(batch.column(n).to_pylist() for n in ("package", "size"))):
                system, path = _file_system(uri)
                with system.open_input_file(path) as file:
                    index = read_index(Package(file, size))
                out: list[tuple] = []
                for member, offset, length in index:
                    last = out[-1] if out else None
                    # a block ends at its size, with its member and at a wide gap between records
                    if (last is None or last[2] != member or offset + length - last[3] > block_bytes
                            or offset - (last[3] + last[4][-1] + last[5][-1]) > GAP_BYTES):
                        out.append((uri, size, member, offset, [0], [length]))
                    else:
                        last[4].append(offset - last[3])
                        last[5].append(length)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (
                        pa.string(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())))], _BLOCK)

    packages = max(1, min(manifest.count(), MOST_TASKS))
    return manifest.select("package", "size").repartition(packages, "package").mapInArrow(
        blocks, "package string, size long, member string, start long, offsets array<bigint>, lengths array<bigint>")


def read_archives(manifest: DataFrame, block_bytes: int = BLOCK_BYTES, with_payload: bool = True) -> DataFrame:
    """Every record of the packages: page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * with_payload
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def rows_of(block: bytes, offsets: list[int], lengths: list[int]) -> Iterator[tuple]:
        for at, length in zip(offsets, lengths):
            raw = block[at:at + length]
            fields, http, payload = parse_record(zlib.decompress(raw, wbits=31) if raw[:2] == b"\x1f\x8b" else raw)
            kind = fields["warc-type"]
            if kind not in ("response", "revisit", "resource"):
                continue
            revisit, stated = kind == "revisit", fields.get("warc-payload-digest", "")
            digest = stated.removeprefix("sha1:") or (None if revisit else digest_of(payload))
            if not revisit and stated.startswith("sha1:") and digest_of(payload) != digest:
                raise ValueError(f"payload of record {fields.get('warc-record-id')} differs from its digest")
            size = int(http.get("content-length", 0)) if revisit else len(payload)
            yield (_number(fields.get("warc-page-id")), fields.get("warc-target-uri") or None, size, digest, kind,
                   _number(fields.get("warc-refers-to-page")), None if revisit else payload)[:len(names)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, size, member, start, offsets, lengths in zip(*(batch.column(n).to_pylist() for n in _BLOCK)):
                system, path = _file_system(uri)
                with system.open_input_file(path) as file:
                    block = Package(file, size).range(member, start, offsets[-1] + lengths[-1])
                rows = list(rows_of(block, offsets, lengths))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    # the exchange holds ranges only, a few bytes for megabytes to read: their number, not its size, says how many tasks
    total = manifest.agg(F.sum("size")).first()[0] or 0
    tasks = max(1, min(-(-total // block_bytes), MOST_TASKS))
    dealt = read_blocks(manifest, block_bytes).repartition(tasks, "package", "member", "start")
    return dealt.mapInArrow(read, schema + ", payload binary" * with_payload)


def _number(text: str | None) -> int | None:
    return int(text) if text else None

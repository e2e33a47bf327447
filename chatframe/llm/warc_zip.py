"""WARC records in ZIP-packaged archives, written and range-read by Spark.

*Writing.*  Every page is one gzip member: a ``response`` record, or, for
payloads of at least ``least`` bytes that equal another page's, a ``revisit``
of the page with the largest id.  Equal means equal SHA-1 and length.  Digests
are stored once, and light rows without payloads decide: revisits are written
from them.  Payloads are read twice more: those that a ``BitSet`` of fixed size
rules out of any group, which go straight to their archive, and those it can't,
of which only the groups' responses and false hits meet the exact join.
A task packs its records into archives of about ``ARCHIVE_BYTES``: a ZIP file
whose stored members are the WARC file and its CDXJ index, always with ZIP64
directories.  Each archive is one row of Spark's text writer (its line end is
the ZIP comment), so lost and repeated tasks are the commit protocol's work
and any file system of Spark's can hold the archives.

*Reading.*  ``ZipArchive`` reads the end record, the ZIP64 records and the
central directory, finds stored members, and reads a record by its index entry
as one byte range; nothing is extracted.  Archives on a mounted path are read
by ranges; elsewhere Spark hands over the (bounded) archive.

Defined cases: null html is the empty payload; payloads below ``least`` bytes
are all responses; rows that repeat the largest id are all responses; a null
id is a response that nothing refers to; payloads of any length are one record,
and may make an archive longer; line ends in urls are escaped, a null url is
left out; an empty table writes no archive; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import quote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatframe.llm.kernels import BitSet
from chatframe.llm.spark_util import bit_set, stored
from chatframe.session import work_dir

LEAST = 1000
ARCHIVE_BYTES = 8 << 20
SET_BITS = 22
DATE = "2000-01-01T00:00:00Z"
WARC_MEMBER, INDEX_MEMBER = "archive/pages.warc.gz", "indexes/index.cdxj"
# Fixed values of the WARC and ZIP formats.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LOCAL, CENTRAL, END, END64, LOCATOR64 = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
ZIP64_EXTRA, STORED, U16, U32 = 1, 0, 0xFFFF, 0xFFFFFFFF


# ------------------------------------------------------------------ records ---
def record(page_id: str | None, url: str | None, sha1: bytes, size: int, payload: bytes | None,
           refers_to: str | None) -> bytes:
    """One WARC record; without ``payload`` a revisit of ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{page_id or ''}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(sha1).decode())
    if payload is None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers (names in lower case) and payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    warc = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[:int(warc["content-length"])]
    if len(block) != int(warc["content-length"]) or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("record length is wrong")
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in http.decode().split("\r\n")[1:])}
    return warc, fields, payload


# ---------------------------------------------------------------------- ZIP ---
def zip_archive(members: list[tuple[str, bytes]], comment: bytes = b"\n") -> bytes:
    """A ZIP file of stored members with ZIP64 records."""
    out, central = io.BytesIO(), []
    for name, data in members:
        at, crc, n = out.tell(), zlib.crc32(data), name.encode()
        extra = struct.pack("<HHQQ", ZIP64_EXTRA, 16, len(data), len(data))
        out.write(struct.pack("<IHHHHHIIIHH", LOCAL, 45, 0x800, STORED, 0, 33, crc, U32, U32, len(n), len(extra)))
        out.write(n + extra)
        out.write(data)
        extra = struct.pack("<HHQQQ", ZIP64_EXTRA, 24, len(data), len(data), at)
        central.append(struct.pack("<IHHHHHHIIIHHHHHII", CENTRAL, 45, 45, 0x800, STORED, 0, 33, crc, U32, U32,
                                   len(n), len(extra), 0, 0, 0, 0, U32) + n + extra)
    at, size, k = out.tell(), sum(map(len, central)), len(central)
    out.write(b"".join(central))
    out.write(struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, k, k, size, at))
    out.write(struct.pack("<IIQI", LOCATOR64, 0, at + size, 1))
    out.write(struct.pack("<IHHHHIIH", END, 0, 0, U16, U16, U32, U32, len(comment)) + comment)
    return out.getvalue()


@dataclass
class Member:
    name: str
    method: int
    size: int
    header: int       # offset of the local header
    crc: int


class ZipArchive:
    """Directory of a ZIP or ZIP64 file and byte ranges of its stored members."""

    def __init__(self, f: BinaryIO, size: int):
        self.f, self.size = f, size
        self.starts: dict[str, int] = {}
        self.members = {m.name: m for m in self._directory()}

    def _at(self, start: int, n: int) -> bytes:
        self.f.seek(start)
        data = self.f.read(n)
        if len(data) != n:
            raise ValueError("archive ends early")
        return data

    def _directory(self) -> Iterator[Member]:
        tail = min(self.size, 22 + U16)
        end = self._at(self.size - tail, tail)
        i = len(end) - 22
        while i >= 0:
            i = end.rfind(struct.pack("<I", END), 0, i + 4)
            if i >= 0 and len(end) - i >= 22 and i + 22 + struct.unpack_from("<H", end, i + 20)[0] == len(end):
                break
            i -= 1
        if i < 0:
            raise ValueError("no end record")
        count, size, at = struct.unpack_from("<HII", end, i + 10)
        where = self.size - tail + i - 20
        if where >= 0 and (count == U16 or size == U32 or at == U32):
            sign, _, end64, _ = struct.unpack("<IIQI", self._at(where, 20))
            if sign == LOCATOR64:
                rec = self._at(end64, 56)
                if struct.unpack_from("<I", rec)[0] != END64:
                    raise ValueError("no ZIP64 end record")
                count, size, at = struct.unpack_from("<QQQ", rec, 32)
        data, p = self._at(at, size), 0
        for _ in range(count):
            (sign, _, _, _, method, _, _, crc, packed, full, n, x, c, _, _, _, header) = struct.unpack_from(
                "<IHHHHHHIIIHHHHHII", data, p)
            if sign != CENTRAL:
                raise ValueError("central directory is broken")
            name = data[p + 46:p + 46 + n].decode()
            extra, q = data[p + 46 + n:p + 46 + n + x], 0
            while q + 4 <= len(extra):
                tag, m = struct.unpack_from("<HH", extra, q)
                if tag == ZIP64_EXTRA:  # holds only the fields that don't fit
                    big = list(struct.unpack_from(f"<{m // 8}Q", extra, q + 4))
                    full = big.pop(0) if full == U32 else full
                    packed = big.pop(0) if packed == U32 else packed
                    header = big.pop(0) if header == U32 else header
                q += 4 + m
            yield Member(name, method, packed, header, crc)
            p += 46 + n + x + c

    def read(self, name: str, start: int = 0, n: int | None = None) -> bytes:
        """A range of a stored member (checked against the CRC if whole)."""
        m = self.members[name]
        if m.method != STORED:
            raise ValueError(f"{name} is not stored")
        if name not in self.starts:
            sign, a, b = struct.unpack("<I22xHH", self._at(m.header, 30))
            if sign != LOCAL:
                raise ValueError("local header is broken")
            self.starts[name] = m.header + 30 + a + b
        want = m.size - start if n is None else n
        if start < 0 or start + want > m.size:
            raise ValueError("range is outside of the member")
        data = self._at(self.starts[name] + start, want)
        if want == m.size and zlib.crc32(data) != m.crc:
            raise ValueError("CRC does not match")
        return data

    def records(self) -> Iterator[bytes]:
        """Every record of the archive, by its index entry."""
        for line in self.read(INDEX_MEMBER).decode().splitlines():
            entry = json.loads(line.split(" ", 2)[2])
            yield gzip.decompress(self.read(WARC_MEMBER, entry["offset"], entry["length"]))


# -------------------------------------------------------------------- Spark ---
def _pack(batches: Iterator[pa.RecordBatch], least_bytes: int) -> Iterator[pa.RecordBatch]:
    parts: list[bytes] = []
    index: list[str] = []
    size = 0

    def archive() -> pa.RecordBatch:
        data = zip_archive([(WARC_MEMBER, b"".join(parts)), (INDEX_MEMBER, "".join(sorted(index)).encode())])
        return pa.RecordBatch.from_arrays([pa.array([data[:-1]], pa.binary())], ["value"])

    for b in batches:
        ids, urls, digest, n, refers = (b.column(c).to_pylist() for c in ("id", "url", "sha", "n", "refers"))
        body = b.column("body")
        for i in range(b.num_rows):
            payload = body[i].as_py()
            sha = bytes.fromhex(digest[i])
            data = gzip.compress(record(ids[i], urls[i], sha, n[i], payload, refers[i]), 1, mtime=0)
            entry = {"url": urls[i], "digest": digest[i], "offset": size, "length": len(data), "filename": WARC_MEMBER}
            index.append(f"page:{ids[i] or ''} {DATE} {json.dumps(entry)}\n")
            parts.append(data)
            size += len(data)
            if size >= least_bytes:
                yield archive()
                parts, index, size = [], [], 0
    if parts:
        yield archive()


def decided(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """id (as string), url, sha (hex SHA-1), n, refers (null: response), body."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("body")).select(
        "page_id", "url", "body", F.sha1("body").alias("sha"), F.octet_length("body").cast("long").alias("n"))
    light = stored(rows.select("page_id", "url", "sha", "n"), "digests")
    copies = stored(light.where(F.col("n") >= least).groupBy("sha", "n")
                    .agg(F.count("*").alias("copies"), F.max("page_id").alias("last")).where("copies > 1"), "copies")
    key = F.conv(F.substring("sha", 1, 16), 16, -10).cast("long")
    taken = bit_set(copies, key, SET_BITS)

    def among(df: DataFrame, tests: list[tuple[BitSet, Column]], wanted: bool = True) -> DataFrame:
        """Rows that are in all of the sets (not ``wanted``: the others)."""
        cols, sets = df.columns, [keep for keep, _ in tests]

        def run(batches):
            for b in batches:
                ok = np.ones(b.num_rows, bool)
                for i, keep in enumerate(sets):
                    ok &= keep.has(b.column(f"k{i}").to_numpy(zero_copy_only=False).view(np.uint64))
                yield b.filter(pa.array(ok == wanted)).select(cols)

        return df.withColumns({f"k{i}": of for i, (_, of) in enumerate(tests)}).mapInArrow(run, df.schema)

    large = F.col("n") >= least
    met = stored(among(light.where(large), [(taken, key)]).join(copies, ["sha", "n"], "left"), "met")
    # responses of groups, and rows that only look like copies, need their payload
    asked = met.where("copies IS NULL OR page_id IS NULL OR page_id = last")
    mine = F.xxhash64("sha", "page_id")
    chosen = bit_set(asked, mine, SET_BITS)
    alone = rows.where(~large).unionByName(among(rows.where(large), [(taken, key)], False))
    full = among(rows.where(large), [(taken, key), (chosen, mine)])
    first = full.join(copies, ["sha", "n"], "left").where("copies IS NULL OR page_id IS NULL OR page_id = last")
    cols = ["page_id", "url", "sha", "n", "body"]
    whole = alone.select(cols).unionByName(first.select(cols))
    nothing = F.lit(None).cast("string")
    revisit = met.where("copies > 1 AND page_id < last")
    return whole.select(F.col("page_id").cast("string").alias("id"), "url", "sha", "n", nothing.alias("refers"),
                        "body").unionByName(revisit.select(
                            F.col("page_id").cast("string").alias("id"), "url", "sha", "n",
                            F.col("last").cast("string").alias("refers"), F.lit(None).cast("binary").alias("body")))


def write_archives(pages: DataFrame, path: str, least: int = LEAST, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write the pages' records as archives under ``path``."""
    packed = decided(pages, least).mapInArrow(lambda it: _pack(it, archive_bytes), "value binary")
    (packed.select(F.col("value").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).option("compression", "none").text(path))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record under ``path``: id, url, payload_bytes, payload_digest,
    record_type, refers_to, payload (null for revisits)."""
    mounted = urlparse(path).scheme in ("", "file")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    files = files.select("path", "length") if mounted else files.select("path", "length", "content")

    def page(uri: str) -> str | None:
        return uri.removeprefix("<urn:page:").removesuffix(">") or None

    def row(data: bytes) -> tuple:
        warc, http, payload = parse_record(data)
        sha = base64.b32decode(warc["warc-payload-digest"].removeprefix("sha1:")).hex()
        kind = warc["warc-type"]
        if kind == "response" and (hashlib.sha1(payload).hexdigest() != sha or len(payload) != int(http["content-length"])):
            raise ValueError("payload does not match its digest")
        return (page(warc["warc-record-id"]), warc.get("warc-target-uri"), int(http["content-length"]), sha, kind,
                page(warc["warc-refers-to"]) if kind == "revisit" else None, payload if kind == "response" else None)

    names = ["id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                at, size = b.column("path")[i].as_py(), b.column("length")[i].as_py()
                f = open(urlparse(at).path, "rb") if mounted else io.BytesIO(b.column("content")[i].as_py())
                with f:
                    rows = []
                    for data in ZipArchive(f, size).records():
                        rows.append(row(data))
                        if len(rows) == 512:
                            yield _rows(rows, names, types)
                            rows = []
                    yield _rows(rows, names, types)

    return files.mapInArrow(run, "id string, url string, payload_bytes long, payload_digest string, "
                                 "record_type string, refers_to string, payload binary")


def _rows(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)


def round_trip(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Write the pages to a new shared folder and read the records back."""
    spark = pages.sparkSession
    path = work_dir(spark, "warc")
    write_archives(pages, path, least)
    return read_archives(spark, path)

"""WARC records in ZIP packages, written by tasks and read back by ranges.

A package is a ZIP file with two stored members: ``archive/data.warc.gz``, WARC records compressed one by one, and
``indexes/index.cdxj``, one JSON line per record with its offset and length in the archive member. Because members are
stored, a record's place in the package is the member's place plus its offset. The reader finds the directory from the
end of the file (ZIP64 included), then the index, and then takes each record by one range, without unpacking anything.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidewick.llm import files
from tidewick.llm.common import bytes_at_most, whole
from tidewick.session import fresh_path, written

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES = 64 << 20  # a package is closed at the first record end after so many bytes
READ_AT_ONCE = 4 << 20  # neighbouring records are read together up to so many bytes
LEAST_REVISIT = 0  # payloads of fewer bytes are always responses
_DATE = "2024-01-01T00:00:00Z"


# ---- records
def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """A WARC/1.1 response, or a revisit without block; both name digest and length of the whole payload."""
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {_DATE}",
        "WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A"), f"WARC-Payload-Digest: sha1:{digest_of(payload)}", f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    block = b"" if revisit else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """Headers (lower-cased names) and the payload of one record; a revisit's payload is None."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    out = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(out["content-length"])]
    out["payload"] = block.partition(b"\r\n\r\n")[2] if out["warc-type"] == "response" else None
    return out


# ---- packages
class PackageWriter:
    """Records go straight to the stream; the index is kept until the end."""

    def __init__(self, stream, zip64: bool = True):
        self.zip = zipfile.ZipFile(_Forward(stream), "w", zipfile.ZIP_STORED)
        self.member, self.at, self.lines, self.zip64 = self.zip.open(DATA, "w", force_zip64=zip64), 0, [], zip64

    def add(self, raw: bytes, **about) -> None:
        pressed = gzip.compress(raw, 6, mtime=0)
        self.member.write(pressed)
        self.lines.append(json.dumps({"offset": self.at, "length": len(pressed), **about}))
        self.at += len(pressed)

    def close(self) -> None:
        self.member.close()
        with self.zip.open(INDEX, "w", force_zip64=self.zip64) as member:
            for line in self.lines:
                member.write(line.encode() + b"\n")
        self.zip.close()


class _Forward(io.RawIOBase):
    """A stream that only goes forward, as object stores have it."""

    def __init__(self, stream):
        self.stream, self.at = stream, 0

    def writable(self):
        return True

    def seekable(self):
        return False

    def write(self, data):
        self.stream.write(bytes(data))
        self.at += len(data)
        return len(data)

    def flush(self):
        pass


def directory(read, size: int) -> dict[str, tuple[int, int]]:
    """{name: (offset of the data, length)} of the stored members of a ZIP file.

    ``read(offset, length)`` takes ranges. The end record is looked for in the last 64 KB; where its fields are at
    their limits, or a ZIP64 locator precedes it, offsets and counts come from the ZIP64 end record, and those of a
    member from its ZIP64 extra field. Compressed or encrypted members are left out.
    """
    tail_at = max(0, size - 65_557)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    end = tail_at + at
    locator = read(end - 20, 20) if end >= 20 else b""
    if locator[:4] == b"PK\x06\x07":
        where = struct.unpack_from("<Q", locator, 8)[0]
        far = read(where, 56)
        if far[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", far, 32)
    raw, at, out = read(start, length), 0, {}
    for _ in range(count):
        if raw[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", raw, at + 8)
        pressed, plain, name_n, extra_n, note_n = struct.unpack_from("<IIHHH", raw, at + 20)
        local = struct.unpack_from("<I", raw, at + 42)[0]
        name = raw[at + 46 : at + 46 + name_n].decode("utf-8" if flags & 0x800 else "cp437")
        extra, e = raw[at + 46 + name_n : at + 46 + name_n + extra_n], 0
        while e + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, e)
            if kind == 1:  # only the fields at their limits are there, in this order
                f = e + 4
                if plain == 0xFFFFFFFF:
                    plain, f = struct.unpack_from("<Q", extra, f)[0], f + 8
                if pressed == 0xFFFFFFFF:
                    pressed, f = struct.unpack_from("<Q", extra, f)[0], f + 8
                if local == 0xFFFFFFFF:
                    local = struct.unpack_from("<Q", extra, f)[0]
            e += 4 + n
        if method == 0 and not flags & 1:
            header = read(local, 30)  # its name and extra field may differ in length from the directory's
            if header[:4] != b"PK\x03\x04":
                raise ValueError("broken local header")
            out[name] = (local + 30 + sum(struct.unpack_from("<HH", header, 26)), plain)
        at += 46 + name_n + extra_n + note_n
    return out


def index_of(read, size: int) -> list[tuple[int, int]]:
    """(offset in the package, length) of every record of its archive."""
    members = directory(read, size)
    base, length = members[DATA]
    at, n = members[INDEX]
    places = [(base + e["offset"], e["length"]) for e in map(json.loads, read(at, n).splitlines())]
    if any(a < base or a + n > base + length for a, n in places):
        raise ValueError("a record lies outside its archive")
    return places


# ---- data sets
def with_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, html and first: the page that holds the payload, if another page does.

    Of pages with equal payloads the one with the largest page_id holds it (rows that repeat that page_id hold it too);
    a null page_id is smaller than any. Only payloads that occur more than once are joined, by digest and length.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), whole(F.col("html")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html")).withColumn("bytes", F.octet_length("html"))
    held = rows.where(F.col("bytes") >= least).groupBy("digest", "bytes").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    held = written(held.select("digest", "bytes", "first"), "warc-payloads")
    return rows.join(held, ["digest", "bytes"], "left").select("page_id", "url", "html", "first")


def write_packages(pages: DataFrame, folder: str | None = None, least: int = LEAST_REVISIT, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """One record per page; returns the stored list of packages (path, records).

    Null html is an empty payload, null page_id an empty record name; an empty table gives no package. Each file has a
    name of its own and counts only through the list, so a repeated task leaves no trace in it.
    """
    spark = pages.sparkSession
    folder = folder or fresh_path(spark, "warc")

    def run(frames):
        out = stream = None

        def closed():
            out.close()
            stream.close()
            return pd.DataFrame({"path": [where], "records": [len(out.lines)]})

        for frame in bytes_at_most(frames, "html"):
            for page_id, url, html, first in zip(frame["page_id"], frame["url"], frame["html"], frame["first"]):
                page_id, first = (None if pd.isna(x) else int(x) for x in (page_id, first))
                if out is None:
                    where = f"{folder}/{uuid.uuid4().hex}.wacz"
                    stream = files.create(where)
                    out = PackageWriter(stream)
                payload = html.encode("utf-8", "surrogatepass")
                revisit = first is not None and first != page_id
                out.add(record(page_id, url, payload, first, revisit), page=page_id)
                if out.at >= package_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return written(with_revisits(pages, least).mapInPandas(run, "path string, records long"), "warc-packages")


def record_places(packages: DataFrame) -> DataFrame:
    """(path, offset, length) of every record, from the packages' directories and indexes alone."""

    def run(frames):
        for frame in frames:
            for path in frame["path"]:
                with files.opened(path) as (read, size):
                    yield pd.DataFrame([(path, a, n) for a, n in index_of(read, size)], columns=["path", "offset", "length"])

    return _spread(packages.select("path")).mapInPandas(run, "path string, offset long, length long")


def _spread(rows: DataFrame) -> DataFrame:
    return rows.repartition(max(1, min(rows.count(), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))))


def read_records(places: DataFrame) -> DataFrame:
    """Records at ``places``, neighbours read together: page_id, payload_bytes, payload_digest, record_type, refers_to,
    url, payload (null in revisits)."""

    def number(name: str | None):
        digits = (name or "")[len("<urn:page:") : -1]
        return int(digits) if digits else None

    def run(frames):
        for frame in frames:
            for path, some in frame.groupby("path", sort=False):
                some = some.sort_values("offset")
                with files.opened(path) as (read, _):
                    rows = []
                    for group in ranges(some["offset"].tolist(), some["length"].tolist()):
                        start = group[0][0]
                        raw = read(start, group[-1][0] + group[-1][1] - start)
                        for a, n in group:
                            r = parsed(gzip.decompress(raw[a - start : a - start + n]))
                            payload = r["payload"]
                            size, digest = int(r["x-payload-length"]), r["warc-payload-digest"].removeprefix("sha1:")
                            if payload is not None and (len(payload) != size or digest_of(payload) != digest):
                                raise ValueError(f"damaged record at {a} of {path}")
                            rows.append((number(r["warc-record-id"]), size, digest, r["warc-type"], number(r.get("warc-refers-to")), r["warc-target-uri"], payload))
                        yield _frame(rows)
                        rows = []

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
    return places.mapInPandas(run, schema)


def _frame(rows) -> pd.DataFrame:
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    return pd.DataFrame(rows, columns=columns).astype({"page_id": "Int64", "refers_to": "Int64"})


def ranges(offsets: list[int], lengths: list[int], most: int = READ_AT_ONCE):
    """Neighbouring places in groups that span at most ``most`` bytes (one record at least), gaps not included."""
    group: list[tuple[int, int]] = []
    for a, n in zip(offsets, lengths):
        if group and (a != group[-1][0] + group[-1][1] or a + n - group[0][0] > most):
            yield group
            group = []
        group.append((a, n))
    if group:
        yield group


ORACLE = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (SELECT *, list_aggregate(list_transform(range(1, 41), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111', strpos('0123456789abcdef', substr(hex, i, 1)) * 4 - 3, 4)), 'string_agg', '') AS bits FROM p)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
           + 16 * CAST(substr(bits, i * 5 + 1, 1) AS INTEGER) + 8 * CAST(substr(bits, i * 5 + 2, 1) AS INTEGER) + 4 * CAST(substr(bits, i * 5 + 3, 1) AS INTEGER)
           + 2 * CAST(substr(bits, i * 5 + 4, 1) AS INTEGER) + CAST(substr(bits, i * 5 + 5, 1) AS INTEGER) AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = max(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = max(page_id) OVER w THEN NULL ELSE max(page_id) OVER w END AS refers_to
FROM b WINDOW w AS (PARTITION BY hex, payload_bytes)
"""

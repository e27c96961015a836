"""WARC archives and their two-level capture index.

Write: one gzip member per record, files rolled at a size, one file name per
task attempt.  Equal payloads are stored once; the others become revisit
records.  Index: captures sorted by reversed-host URL key into compressed
blocks, one index file per range of keys, with a sparse directory (first key,
place) of its blocks at the file's end.  Look-up: the range is found among the
files' first keys, the block by binary search in the file's directory, the
capture by binary search in the block, then the record by a range read.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelic.llm.common import fresh_folder, stored
from allelic.llm.files import open_read, open_write, own_name, read_range

#: Payloads below this many bytes are always stored.
LEAST_REVISIT = 100
#: A new archive file begins beyond this many bytes.
FILE_BYTES = 256 * 1024 * 1024
#: Captures in a block of the index.
BLOCK = 512
#: Gap in bytes that two range reads of one file are joined across, and the most bytes of a joined read.
GAP, MOST = 64 * 1024, 8 * 1024 * 1024
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURES = "surt string, page_id long, file string, offset long, length long, record_type string"
PAGES = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
         "refers_to long, payload binary")


def surt_key(url: str | None) -> str:
    """Reversed-host key of a URL: host labels from the last, then path and
    query.  Scheme, user, default port and fragment go; case of the host goes.
    Null is the empty key; what cannot be split is its own key."""
    if url is None:
        return ""
    try:
        u = urlsplit(url.strip())
        host, port = u.hostname or "", u.port
    except ValueError:
        return quote(url.strip(), safe="!$&'()*+,/:;=?@[]%~")
    key = ",".join(reversed(host.split("."))) if host else ""
    if port and port != {"http": 80, "https": 443}.get(u.scheme.lower()):
        key += f":{port}"
    key += ")" + (u.path or "/") + (f"?{u.query}" if u.query else "")
    return quote(key, safe="!$&'()*+,/:;=?@[]%~")


def _record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
             f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="!#$&'()*+,/:;=?@[]%~"))
        if quote(url, safe="!#$&'()*+,/:;=?@[]%~") != url:
            lines.append("X-Original-URI: " + json.dumps(url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _id(value: str) -> int | None:
    number = value.removeprefix("<urn:page:").rstrip(">")
    return int(number) if number else None


def parse_record(member: bytes) -> dict:
    """A gzip member as page_id, url, payload_bytes, payload_digest,
    record_type, refers_to and payload (None for revisits).  Size and digest
    of a response come from its payload, those of a revisit, whose payload is
    not stored, from its headers."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("WARC record of another length than it states")
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    url = json.loads(fields["X-Original-URI"]) if "X-Original-URI" in fields else fields.get("WARC-Target-URI")
    out = {"page_id": _id(fields["WARC-Record-ID"]), "url": url, "record_type": fields["WARC-Type"]}
    if fields["WARC-Type"] == "revisit":
        size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
        return out | {"payload_bytes": size, "payload_digest": stated, "refers_to": _id(fields["WARC-Refers-To"]), "payload": None}
    digest = hashlib.sha256(payload).hexdigest()
    if digest != stated:
        raise ValueError("payload and digest of a WARC record differ")
    return out | {"payload_bytes": len(payload), "payload_digest": digest, "refers_to": None, "payload": payload}


def _rows(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


_CAPTURES = pa.schema([("surt", pa.string()), ("page_id", pa.int64()), ("file", pa.string()),
                       ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string())])
_PAGES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string()), ("record_type", pa.string()),
                    ("refers_to", pa.int64()), ("payload", pa.binary())])


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Writes a record per row and returns the captures, one row per record:
    surt, page_id, file, offset, length, record_type.

    Of rows with equal payloads of ``LEAST_REVISIT`` bytes or more, those with
    the smallest id are responses, the others revisits of it.  A null payload
    is empty.  A null id sorts after all others: such a row is a revisit if
    its group has an id, else a response.  Null URLs have the empty key.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(html_col, F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long_enough = F.octet_length("payload") >= LEAST_REVISIT
    ids = rows.where(long_enough).select("page_id", "digest")
    groups = stored(ids.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
                    .where("n > 1 AND first_id IS NOT NULL").select(F.col("digest").alias("of"), "first_id"), "equal")
    # ids and digests alone are joined by digest, which may be hot (groups are a table of their own, so that adaptive
    # execution can split the join); the payloads are joined by id
    revisits = (ids.join(groups, F.col("digest") == F.col("of")).where("NOT page_id <=> first_id")
                .select(F.col("page_id").alias("rid"), F.col("of"), "first_id").distinct())
    decided = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("rid")) & (F.col("digest") == F.col("of"))
                        & long_enough, "left").select("page_id", "url", "payload", "digest", "first_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, name = None, 0, ""
        for batch in batches:
            found = []
            for page_id, url, payload, digest, first_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or at > FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = own_name(folder, "pages", ".warc.gz"), 0
                    out = open_write(name)
                member = _member(_record(page_id, url, payload, digest, first_id))
                out.write(member)
                found.append({"surt": surt_key(url), "page_id": page_id, "file": name, "offset": at, "length": len(member),
                              "record_type": "response" if first_id is None else "revisit"})
                at += len(member)
            yield _rows(found, _CAPTURES)
        if out is not None:
            out.close()

    return stored(decided.mapInArrow(write, CAPTURES), "captures")


def _key(surt: str, page_id: int | None) -> tuple:
    return surt, page_id is None, page_id or 0


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Index files over captures; one row per file: part, surt, page_id (its
    first key), path, directory_offset, directory_length."""
    order = [F.col("surt"), F.col("page_id").asc_nulls_last()]
    ranged = captures.repartitionByRange(*order).sortWithinPartitions(*order, "file", "offset")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, at, first = None, "", 0, None
        directory, block = [], []

        def flush():
            nonlocal at, block
            data = zlib.compress("\n".join(map(json.dumps, block)).encode(), 6)
            directory.append([block[0][0], block[0][1], at, len(data)])
            out.write(data)
            at, block = at + len(data), []

        for batch in batches:
            for line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    path, first = own_name(folder, "index", ".cdx"), line
                    out = open_write(path)
                block.append(line)
                if len(block) == BLOCK:
                    flush()
        if out is not None:
            if block:
                flush()
            data = zlib.compress(json.dumps(directory).encode(), 6)
            out.write(data + struct.pack("<QQ", at, len(data)))
            out.close()
            yield pa.RecordBatch.from_pylist(
                [{"surt": first[0], "page_id": first[1], "path": path, "directory_offset": at, "directory_length": len(data)}],
                schema=pa.schema([("surt", pa.string()), ("page_id", pa.int64()), ("path", pa.string()),
                                  ("directory_offset", pa.int64()), ("directory_length", pa.int64())]))

    files = ranged.mapInArrow(build, "surt string, page_id long, path string, directory_offset long, directory_length long")
    return stored(files, "index")


class _Reader:
    """Binary search in one index file; holds its directory and one block."""

    def __init__(self, path: str, offset: int, length: int):
        self.source = open_read(path)
        self.directory = json.loads(zlib.decompress(read_range(self.source, offset, length)))
        self.firsts = [_key(d[0], d[1]) for d in self.directory]
        self.at, self.lines, self.keys = -1, [], []

    def block(self, i: int) -> None:
        if i != self.at:
            _, _, offset, length = self.directory[i]
            self.lines = [json.loads(x) for x in zlib.decompress(read_range(self.source, offset, length)).split(b"\n")]
            self.keys, self.at = [_key(x[0], x[1]) for x in self.lines], i

    def find(self, key: tuple) -> Iterator[list]:
        i = max(bisect_left(self.firsts, key) - 1, 0)
        while i < len(self.directory) and (self.firsts[i] <= key):
            self.block(i)
            for j in range(bisect_left(self.keys, key), bisect_right(self.keys, key)):
                yield self.lines[j]
            i += 1


def look_up(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Captures of the wanted (surt, page_id) keys, found through the index.

    The files' first keys, one row per index file, are all that goes to every
    task; wanted keys are dealt by file, which are even ranges of the keys.
    """
    parts = sorted(((r["surt"], r["page_id"], r["path"], r["directory_offset"], r["directory_length"])
                    for r in index.collect()), key=lambda r: _key(r[0], r[1]))
    firsts = [_key(r[0], r[1]) for r in parts]
    order = [F.col("surt"), F.col("page_id").asc_nulls_last()]
    ranged = wanted.select("surt", "page_id").distinct().repartitionByRange(*order).sortWithinPartitions(*order)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers: dict[int, _Reader] = {}
        for batch in batches:
            found = []
            for surt, page_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = _key(surt, page_id)
                # equal keys may reach over the end of a range
                for p in range(max(bisect_left(firsts, key) - 1, 0), bisect_right(firsts, key)):
                    if p not in readers:
                        for old in [x for x in readers if x < p - 1]:
                            readers.pop(old).source.close()
                        readers[p] = _Reader(*parts[p][2:])
                    found += [dict(zip(_CAPTURES.names, line, strict=True)) for line in readers[p].find(key)]
            yield _rows(found, _CAPTURES)

    return ranged.mapInArrow(search, CAPTURES)


def read_records(captures: DataFrame, keep_payload: bool = True) -> DataFrame:
    """The records at the captures' places, parsed (see ``parse_record``).

    Places are dealt by range of (file, offset) and read in that order;
    neighbouring ranges become one read."""
    ranged = (captures.select("file", "offset", "length").repartitionByRange("file", "offset")
              .sortWithinPartitions("file", "offset"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            places = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            i = 0
            while i < len(places):
                file, begin, length = places[i]
                j, end = i + 1, begin + length
                while j < len(places) and places[j][0] == file and places[j][1] <= end + GAP and places[j][1] - begin < MOST:
                    end = max(end, places[j][1] + places[j][2])
                    j += 1
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, open_read(file)
                data = memoryview(read_range(source, begin, end - begin))
                rows = [parse_record(data[o - begin:o - begin + n]) for _, o, n in places[i:j]]
                if not keep_payload:
                    rows = [r | {"payload": None} for r in rows]
                yield _rows(rows, _PAGES)
                i = j
        if source is not None:
            source.close()

    return ranged.mapInArrow(read, PAGES)


def page_keys(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(surt, page_id) of each row."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(surt_key, batch.column(0).to_pylist()), pa.string()), batch.column(1)], names=["surt", "page_id"])

    return pages.select(F.col(url_col).alias("url"), F.col(id_col).cast("long").alias("page_id")).mapInArrow(
        keys, "surt string, page_id long")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes, indexes, looks up every page's capture and reads its record.
    Rows that repeat a page give a record, and so a result row, each."""
    folder = fresh_folder(pages.sparkSession, "warc")
    index = write_index(write_archives(pages, folder), folder)
    found = look_up(index, page_keys(pages))
    return read_records(found, keep_payload=False).drop("payload", "url")


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (
  SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha256(h) AS payload_digest FROM p),
g AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM g
"""

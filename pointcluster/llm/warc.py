"""WARC archives: a writer and a reader that splits gzip archives by byte range.

Writer: one record per page, each a gzip member of its own, one archive per
task. A task writes under a name no other attempt uses and reports it with its
size; only reported archives count, so lost or repeated tasks leave nothing
half-written in the result. Of pages with equal payloads of at least
``min_payload`` bytes, those with the smallest page_id are responses, the
others revisits of it without payload (digests decide equality: SHA-1).

Reader: archives are cut into byte ranges, one row each. A task looks for the
gzip magic in its range, accepts a candidate only if what it decodes to begins
with a WARC version line, and owns the records that start inside its range; it
reads on past the end to finish the last one. From an accepted record on, the
next one starts where the member ends, so magic bytes inside a member are never
looked at. Memory: one range and one record.

Null html: empty payload. Null page_id: a response unless an equal payload has
an id. Repeated rows with the smallest page_id are all responses. Null url: an
empty target. Extra columns are not written. An empty table gives no archive
and no record. Paths are read with pyarrow's file systems, found by their URI.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import balanced_join
from .common import Tables, table

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"  # records carry no clock, so a repeated task writes the same bytes
READ = 64 << 10
MAX_TASKS = 100_000
RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, url string, payload binary"
)


def _open(path: str):
    if "://" in path or path.startswith("file:"):
        path = "file://" + path[5:] if path.startswith("file:/") and path[5:7] != "//" else path
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _from_urn(urn: str):
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _clean(url: str | None) -> str:
    """``url`` without characters that would end its header line."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")


def record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One gzip member: WARC header, HTTP header and, for a response, the payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    head = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_clean(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    raw = VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def parse(raw: bytes, keep_payload: bool = True) -> tuple:
    """A decoded member -> the fields of ``RECORDS``; the payload's digest is checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(http.rpartition(b"Content-Length: ")[2])
    kind = fields["WARC-Type"]
    if kind == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest or size != len(payload):
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    refers = _from_urn(fields["WARC-Refers-To"]) if kind == "revisit" else None
    return (
        _from_urn(fields["WARC-Record-ID"]), size, digest, kind, refers,
        fields["WARC-Target-URI"], payload if keep_payload and kind == "response" else None,
    )


def mark_revisits(pages: DataFrame, tables: Tables, min_payload: int = 0) -> DataFrame:
    """``page_id, url, html, sha1, first_id``: what a revisit refers to, null for responses."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        html.alias("html"), F.unhex(F.sha1(html.cast("binary"))).alias("sha1"),
    )
    groups = (
        rows.where(f"octet_length(html) >= {int(min_payload)}")
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 AND first_id IS NOT NULL")
        .select("sha1", "first_id")
    )
    groups = tables.store(groups, "copies")
    joined = balanced_join(rows, groups, ["sha1"], groups.count(), "left")
    return joined.select(
        "page_id", "url", "html", "sha1",
        F.expr("IF(page_id <=> first_id, NULL, first_id)").alias("first_id"),
    )


def write_archives(marked: DataFrame, root: str) -> DataFrame:
    """Write ``marked`` below ``root``; a lazy ``(path, records, bytes)``, one row per archive."""

    def run(batches):
        store = out = None
        path, count, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                for row in batch.slice(lo, 200).to_pylist():
                    if out is None:
                        store, at = _open(path)
                        store.create_dir(at.rpartition("/")[0], recursive=True)
                        out = store.open_output_stream(at, compression=None)
                    digest = base64.b32encode(row["sha1"]).decode()
                    member = record(
                        row["page_id"], row["url"], row["html"].encode(), digest,
                        row["first_id"], row["first_id"] is not None,
                    )
                    out.write(member)
                    count, size = count + 1, size + len(member)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [count], "bytes": [size]})

    return marked.mapInArrow(run, "path string, records long, bytes long")


def members(path: str, start: int, end: int):
    """Decoded records of the archive that start in ``[start, end)``."""
    store, at = _open(path)
    with store.open_input_file(at) as file:
        size = file.size()
        file.seek(start)
        buf, base = file.read(min(end, size) - start + READ), start
        pos, known = start, False  # known: pos is the start of a member
        while pos < end:
            if not known:
                found = buf.find(MAGIC, pos - base)
                if found < 0 or base + found >= end:
                    return
                pos = base + found
            packer, parts, valid, next_at = zlib.decompressobj(31), [], None, pos
            try:
                while True:
                    # what the range's buffer holds, then the file, a slice at a time
                    chunk = buf[next_at - base : next_at - base + READ]
                    if not chunk:
                        file.seek(next_at)
                        chunk = file.read(READ)
                    if not chunk:
                        break
                    next_at += len(chunk)
                    parts.append(packer.decompress(chunk))
                    if valid is None and sum(map(len, parts)) >= len(VERSION):
                        valid = b"".join(parts).startswith(b"WARC/")
                        if not valid:
                            break
                    if packer.eof:
                        break
            except zlib.error:
                valid = False
            if valid and packer.eof:
                yield b"".join(parts)
                pos, known = next_at - len(packer.unused_data), True
                if pos >= size:
                    return
            elif known:
                raise ValueError(f"damaged archive {path} at {pos}")
            else:
                pos += 1  # magic by chance


def read_archives(archives: DataFrame, split_bytes: int = 4 << 20, payloads: bool = True):
    """``archives (path, bytes)`` -> ``RECORDS``, one task row per byte range."""
    ranges = archives.where("bytes > 0").selectExpr(
        "path", "bytes", f"explode(sequence(0L, bytes - 1, {int(split_bytes)}L)) AS start"
    ).selectExpr("path", "start", f"least(start + {int(split_bytes)}, bytes) AS end")

    def run(batches):
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url",
                 "payload"]
        schema = pa.schema(list(zip(names, (
            pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(),
        ))))
        for batch in batches:
            for row in batch.to_pylist():
                rows = []
                for raw in members(row["path"], row["start"], row["end"]):
                    rows.append(parse(raw, payloads))
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    # numbered, so that adaptive execution does not merge the short rows of ranges into one task
    parts = max(1, min(ranges.count(), MAX_TASKS))
    return ranges.repartition(parts, "path", "start").mapInArrow(run, RECORDS)


def archive_pages(
    pages: DataFrame, tables: Tables, min_payload: int = 0, root: str | None = None
) -> DataFrame:
    """Write ``pages (page_id, url, html)`` and return the archives' manifest."""
    marked = mark_revisits(pages, tables, min_payload)
    return tables.store(write_archives(marked, root or tables.path("archives")), "manifest")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = archive_pages(table(spark, sf_dir, "pages"), Tables(spark))
    return read_archives(archives, payloads=False).drop("url", "payload")


_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP10_SQL = f"""
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS h, strlen(coalesce(html, '')) AS n
    FROM pages),
b AS (SELECT h, string_agg(substr('{_B32}', CAST(v AS INT) + 1, 1), '' ORDER BY k) AS d FROM (
    SELECT h, k, list_sum(list_transform(range(5), lambda j:
        ((strpos('0123456789abcdef', substr(h, CAST((k * 5 + j) // 4 + 1 AS INT), 1)) - 1)
         >> CAST(3 - (k * 5 + j) % 4 AS INT) & 1) << CAST(4 - j AS INT))) AS v
    FROM (SELECT DISTINCT h FROM p), range(32) r(k)) GROUP BY h),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN b USING (h) JOIN f USING (h)
"""

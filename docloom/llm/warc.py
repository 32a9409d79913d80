"""WARC archives: a writer with revisit records and a sequential reader.

Writing: every row becomes one record in a gzip member of its own. Among rows whose payloads are equal (by
SHA-1) and at least ``MIN_REVISIT`` bytes long, those with the largest ``page_id`` are responses and the others
revisits, which name the response's record and keep the HTTP header with the full length but no payload.
Archives roll over at ``ARCHIVE_BYTES``. A task names its files by its attempt and lists them in a manifest
that Spark commits, so what a lost or repeated attempt left is never read.

Reading: each archive is streamed through an incremental zlib decompressor, record after record, framed by
Content-Length; block and payload digests are verified, and a record that fails raises an error. No archive or
record is held whole unless its payload is asked for.

Rows: a null payload is empty; a null url is written as an empty target; a null ``page_id`` is a
response's id of last resort (it orders before all others); rows that repeat the largest ``page_id`` of a
payload are all responses; an empty table makes no archive; other columns are left behind.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm._common import qualified, shared_dir, spread_join, written

MIN_REVISIT = 1000
ARCHIVE_BYTES = 256 << 20
CHUNK = 1 << 16
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed by the format


def filesystem(uri: str):
    """(pyarrow file system, path) of a folder named with its scheme; the scheme is the one that Spark's own tables have there."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        raise ValueError(f"{uri} names no file system")
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(record: str) -> int | None:
    found = re.search(r"urn:x-page:(-?\d+)", record or "")
    return int(found[1]) if found else None


def record(page_id, url: str | None, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC record, not yet compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or '', safe=_URL_SAFE)}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URL_SAFE = "!#$%&'()*+,/:;=?@[]~-._"


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def with_originals(pages: DataFrame, at: str, least: int = MIN_REVISIT) -> DataFrame:
    """(page_id, url, html, refers_to, revisit).

    Which payloads repeat is found on digests alone; pages are then joined by id and digest, so neither a page served very often nor the many
    empty ones meet in one task."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    narrow = rows.where(F.octet_length("html") >= least).groupBy("page_id", "digest").agg(F.count("*").alias("n"))
    narrow = written(narrow, f"{at}/digests")
    groups = narrow.groupBy("digest").agg(F.max("page_id").alias("original"), F.sum("n").alias("n")).where("n > 1")
    found = spread_join(narrow.select("page_id", "digest"), written(groups, f"{at}/repeated"), ["digest"], "n", ["page_id"])
    revisits = found.where("original is not null and (page_id is null or page_id <> original)").select("page_id", "digest", "original")
    mark = F.xxhash64("url").bitwiseOR(F.lit(1)).cast("long")  # rows that have no revisit are dealt by more than their id
    small = F.octet_length("html") < least
    side = revisits.select(F.col("page_id").alias("__page"), F.col("digest").alias("__digest"), "original", F.lit(0).cast("long").alias("__large"))
    rows = rows.withColumn("__lone", F.when(small, mark).otherwise(F.lit(0)).cast("long"))
    joined = rows.join(side, rows.page_id.eqNullSafe(side["__page"]) & (rows.digest == side["__digest"]) & (rows["__lone"] == side["__large"]), "left")
    return joined.select("page_id", "url", "html", F.col("original").alias("refers_to"), F.col("original").isNotNull().alias("revisit"))


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the archives below ``folder``; gives the manifest (archive, records, bytes)."""
    folder = qualified(pages.sparkSession, folder)
    fs, path = filesystem(folder)
    fs.create_dir(f"{path}/archives")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fs, path = filesystem(folder)
        task = TaskContext.get()
        out, size, n, made = None, 0, 0, []

        def close():
            nonlocal out, size, n
            if out is not None:
                out.close()
                made.append((f"{folder}/{name}", n, size))
            out, size, n = None, 0, 0

        for part in parts:
            ids, refs, revisit = (part.column(c).to_pylist() for c in (0, 3, 4))
            for k, (i, url, html) in enumerate(zip(ids, part.column(1), part.column(2))):
                if out is None:
                    name = f"archives/part-{task.partitionId():06d}-{task.taskAttemptId()}-{len(made):04d}.warc.gz"
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                member = gzip_member(record(i, url.as_py(), html.as_buffer().to_pybytes(), refs[k], revisit[k]))
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= archive_bytes:
                    close()
        close()
        yield pa.RecordBatch.from_pydict({"archive": pa.array([m[0] for m in made], pa.string()), "records": pa.array([m[1] for m in made], pa.int64()), "bytes": pa.array([m[2] for m in made], pa.int64())})

    rows = with_originals(pages, folder)
    return written(rows.mapInArrow(run, "archive string, records long, bytes long"), f"{folder}/manifest")


class BadRecord(ValueError):
    pass


def members(stream, chunk: int = CHUNK) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each an iterator over its decompressed pieces."""
    rest = stream.read(chunk)
    while rest:
        z = zlib.decompressobj(31)

        def pieces():
            nonlocal rest
            while not z.eof:
                if not rest:
                    raise BadRecord("the archive ends within a member")
                piece = z.decompress(rest, 1 << 20)
                rest = z.unconsumed_tail or z.unused_data or (b"" if z.eof else stream.read(chunk))
                if piece:
                    yield piece
            if not rest:
                rest = stream.read(chunk)

        body = pieces()
        yield body
        for _ in body:  # what the caller left
            pass


def headers(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "replace").split("\r\n")
    return {"": lines[0]} | {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def read_record(pieces: Iterator[bytes], with_payload: bool) -> dict:
    """One record from its member's pieces; raises BadRecord unless framing and digests hold."""
    buffer = bytearray()

    def until_blank_line() -> bytes:
        at = 0
        while True:
            found = buffer.find(b"\r\n\r\n", max(0, at - 3))
            if found >= 0:
                got = bytes(buffer[:found])
                del buffer[: found + 4]
                return got
            at = len(buffer)
            if at > 1 << 20:
                raise BadRecord("endless header")
            piece = next(pieces, None)
            if piece is None:
                raise BadRecord("no end of header")
            buffer.extend(piece)

    head = headers(until_blank_line())
    if not head[""].startswith("WARC/"):
        raise BadRecord("not a WARC record")
    left = int(head["content-length"])
    block_sha, payload_sha = hashlib.sha1(), hashlib.sha1()
    kept = [] if with_payload else None
    is_http = head.get("content-type", "").replace(" ", "").startswith("application/http")
    before = bytearray() if is_http else None
    http: dict[str, str] = {}
    n_payload = 0
    while left:
        if not buffer:
            piece = next(pieces, None)
            if piece is None:
                raise BadRecord("the block is shorter than its Content-Length")
            buffer.extend(piece)
        data = bytes(buffer[:left])
        del buffer[: len(data)]
        left -= len(data)
        block_sha.update(data)
        if before is not None:  # still in the HTTP header
            before.extend(data)
            end = before.find(b"\r\n\r\n")
            if end < 0:
                continue
            http, data, before = headers(bytes(before[:end])), bytes(before[end + 4 :]), None
        payload_sha.update(data)
        n_payload += len(data)
        if kept is not None:
            kept.append(data)
    tail = bytes(buffer) + b"".join(pieces)
    if tail != b"\r\n\r\n":
        raise BadRecord("the block is longer than its Content-Length")
    stated = lambda name: head.get(name, "").removeprefix("sha1:")
    if stated("warc-block-digest") and stated("warc-block-digest") != base64.b32encode(block_sha.digest()).decode():
        raise BadRecord("block digest differs")
    revisit = head.get("warc-type") == "revisit"
    if not revisit and stated("warc-payload-digest") and stated("warc-payload-digest") != base64.b32encode(payload_sha.digest()).decode():
        raise BadRecord("payload digest differs")
    return {
        "page_id": page_of(head.get("warc-record-id", "")),
        "url": head.get("warc-target-uri", ""),
        "record_type": head.get("warc-type"),
        "payload_bytes": int(http.get("content-length", n_payload)) if revisit else n_payload,
        "payload_digest": base64.b32decode(stated("warc-payload-digest")).hex() if stated("warc-payload-digest") else payload_sha.hexdigest(),
        "refers_to": page_of(head.get("warc-refers-to", "")),
        "payload": b"".join(kept) if kept is not None and not revisit else None,
    }


_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the archives named in the column ``archive``, one archive after another in each task."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for name in part.column(0).to_pylist():
                fs, path = filesystem(name)
                rows, size = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for pieces in members(stream):
                        rows.append(read_record(pieces, with_payload))
                        size += len(rows[-1]["payload"] or b"") + 200
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    n = max(1, archives.count())
    dealt = archives.select("archive").repartition(n, "archive") if n > 1 else archives.select("archive")
    return dealt.mapInArrow(run, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes all pages as archives in the shared folder, reads them back: one row per page."""
    manifest = write_archives(pages, shared_dir(pages.sparkSession))
    kind = pages.schema["page_id"].dataType.simpleString()
    back = read_archives(manifest, with_payload=False)
    return back.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "url")

"""WARC archives with a two-level capture index.

Each row of pages becomes one record, a gzip member of its own, so any record can be read by
(file, offset, length). Of records with equal payloads one holds the payload, the others are
revisits. Every task writes files of its own under names no other attempt uses and returns the
index rows; only rows of finished tasks are stored, so what a lost task wrote is never referred to.

The index has two levels. Its lines, sorted by the key of the reversed host, are packed into
compressed blocks; beside each index file lies a sparse directory with the first key of each of
its blocks. A lookup finds the index file by the files' first keys, a list as long as the index has
partitions, finds the block by binary search in the file's directory, reads that range, and then the
record's range. A report of all records reads the whole index back and then the records in the order
in which they lie in the archives.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbstar.sources.scratch import scratch_path, stored

#: An archive file is closed at so many bytes; lines of an index block.
FILE_BYTES = 256_000_000
BLOCK_LINES = 1000
#: Up to this many repeated payloads, their list is sent to all executors; beyond, it is joined.
BROADCAST_DIGESTS = 400_000
#: Bytes of an archive that are read at a time.
READ_BYTES = 1 << 20
DATE = "1970-01-01T00:00:00Z"

CAPTURES = "key string, url string, page_id long, digest string, record_type string, path string, offset long, length long"
INDEXED = "key string, page_id long, record_type string, digest string, path string, offset long, length long"
BLOCKS = "first_key string, last_key string, path string, offset long, length long, lines long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def url_key(url: str | None) -> str:
    """Reversed host, then path and query: ``http://www.a.org/x?y`` is ``org,a)/x?y``.

    What is no URL goes by its whole text. White space is escaped, so a key is one field of a line and
    sorts as it is stored.
    """
    return re.sub(r"\s", lambda m: quote(m[0]), _reversed(url))


def _reversed(url: str | None) -> str:
    try:
        parts = urlsplit(url if url and "://" in url else f"//{url or ''}")
    except ValueError:
        return f"){url}"
    host = (parts.netloc.rpartition("@")[2].partition(":")[0]).lower()
    host = re.sub(r"^www\d*\.", "", host)
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}){parts.path or '/'}{query}"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC record. A revisit carries the header of the response alone."""
    digest = _digest(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = head if revisit else head + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id, digest)), ("WARC-Date", DATE)]
    fields += [("WARC-Target-URI", target)] if target else []
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    fields += [("X-Page-ID", str(page_id))] if page_id is not None else []
    if revisit:
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.append(("WARC-Refers-To", _record_id(refers_to, digest)))
        fields += [("X-Refers-To-Page-ID", str(refers_to))] if refers_to is not None else []
    fields.append(("Content-Length", str(len(body))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + body + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """The fields of one record; the digest of a response is computed from its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    body = rest[: int(fields["Content-Length"])]
    if version != "WARC/1.1" or rest[len(body) :] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\nContent-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or _digest(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not fit its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page-ID"), "payload": None if revisit else payload,
    }


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _write(folder: str, file_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        out, path, at = None, "", 0
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, path, at = fs.open_output_stream(f"{base}/{name}", compression=None), f"{folder}/{name}", 0
                payload = (row["html"] or "").encode("utf-8", "surrogatepass")
                member = _gzip(record(row["page_id"], row["url"], payload, row["keeper"], row["revisit"]))
                out.write(member)
                kind = "revisit" if row["revisit"] else "response"
                rows.append((url_key(row["url"]), row["url"], row["page_id"], _digest(payload), kind, path, at, len(member)))
                at += len(member)
            yield _batch(rows, CAPTURES)
        if out is not None:
            out.close()

    return write


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [tuple(f.split()) for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def written_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", page: str = "html", least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row under ``folder``; the stored captures, one row per record.

    Of rows with equal payloads of ``least_bytes`` bytes or more, those with the largest page_id are
    responses and the others revisits of it; shorter payloads are all responses. A null page is an
    empty payload. A null page_id is smaller than any other, and rows that share the largest page_id
    are all responses. Other columns are ignored.
    """
    spark = pages.sparkSession
    fs, base = _open(folder)
    fs.create_dir(base, recursive=True)
    html = F.coalesce(F.col(page), F.lit(""))
    own = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("sha"))
    sizes = own.select("page_id", "sha", F.octet_length("html").alias("size")).filter(F.col("size") >= least_bytes)
    kept = sizes.groupBy("sha").agg(F.max("page_id").alias("keeper"), F.count("*").alias("copies")).filter("copies > 1")
    kept = stored(kept.select("sha", "keeper"), "warc-copies")
    side = F.broadcast(kept) if kept.count() <= BROADCAST_DIGESTS else kept
    judged = own.join(side, "sha", "left").select(
        "page_id", "url", "html", "keeper", (F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))).alias("revisit")
    )
    return stored(judged.mapInArrow(_write(folder, file_bytes), CAPTURES), "warc-captures")


def _members(spots: Iterable[tuple[str, int, int]]) -> Iterator[bytes]:
    """What each path, offset and length holds, a gzip member; neighbours in a file are read together."""
    for path, own_spots in groupby(spots, lambda spot: spot[0]):
        fs, own = _open(path)
        with fs.open_input_file(own) as source:
            start, held = 0, b""
            for _, offset, length in own_spots:
                if not start <= offset <= offset + length <= start + len(held):
                    source.seek(offset)
                    start, held = offset, source.read(max(length, READ_BYTES))
                unpack = zlib.decompressobj(31)
                raw = unpack.decompress(held[offset - start : offset - start + length])
                if not unpack.eof or unpack.unused_data:
                    raise ValueError(f"{path} has no whole member at {offset}")
                yield raw


def _read(with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORDS.split(", ")]
        for batch in batches:
            rows, size = [], 0
            for raw in _members(zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length")), strict=True)):
                fields = parsed(raw)
                size += len(raw)
                if not with_payload:
                    fields["payload"] = None
                rows.append(tuple(fields[n] for n in names))
                if size > 16_000_000:
                    yield _batch(rows, RECORDS)
                    rows, size = [], 0
            yield _batch(rows, RECORDS)

    return read


def read_archives(captures: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records that ``captures`` names, read from the files, as many tasks as there are files."""
    files = captures.select("path").distinct().count()
    spots = captures.select("path", "offset", "length").repartitionByRange(max(1, files), "path", "offset")
    return spots.sortWithinPartitions("path", "offset").mapInArrow(_read(with_payload), RECORDS)


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the index under ``folder``; the stored blocks. A key with very many captures may lie in
    several blocks and files."""
    return _stored_blocks(captures, folder, block_lines)


def indexed_captures(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the index under ``folder`` and read it back by its directories; the stored captures that
    its lines name, as many as were given."""
    files = _stored_blocks(captures, folder, block_lines).select("path").distinct()
    found = stored(files.repartition(max(1, files.count()), "path").mapInArrow(_read_blocks, INDEXED), "warc-indexed")
    if (lines := found.count()) != (given := captures.count()):
        raise ValueError(f"the index under {folder} has {lines} of {given} captures")
    return found


def _read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            for block in _members((path, offset, length) for _, offset, length in _directory(path)):
                lines = [line.partition(" ") for line in block.decode().splitlines()]
                yield _batch([(key, *json.loads(rest)) for key, _, rest in lines], INDEXED)


def _stored_blocks(captures: DataFrame, folder: str, block_lines: int) -> DataFrame:
    fs, base = _open(folder)
    fs.create_dir(base, recursive=True)
    ranged = captures.repartitionByRange(F.coalesce("key", F.lit("")), "path", "offset").sortWithinPartitions("key", "path", "offset")
    return stored(ranged.mapInArrow(_write_blocks(folder, block_lines), BLOCKS), "warc-blocks")


def _write_blocks(folder: str, block_lines: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        name = f"{uuid.uuid4().hex}.cdx.gz"
        done, lines, at = [], [], 0
        out = None

        def flush() -> None:
            nonlocal lines, at, out
            if out is None:
                out = fs.open_output_stream(f"{base}/{name}", compression=None)
            block = _gzip("".join(f"{k} {json.dumps(v)}\n" for k, v in lines).encode())
            out.write(block)
            done.append((lines[0][0], lines[-1][0], f"{folder}/{name}", at, len(block), len(lines)))
            at += len(block)
            lines = []

        for batch in batches:
            for row in batch.to_pylist():
                lines.append((row["key"], [row[n] for n in ("page_id", "record_type", "digest", "path", "offset", "length")]))
                if len(lines) >= block_lines:
                    flush()
        if lines:
            flush()
        if out is not None:
            out.close()
            with fs.open_output_stream(f"{base}/{name}.dir", compression=None) as sparse:
                sparse.write(json.dumps([[d[0], d[3], d[4]] for d in done]).encode())
        yield _batch(done, BLOCKS)

    return write


def lookup(spark: SparkSession, blocks: DataFrame, urls: DataFrame, url: str = "url") -> DataFrame:
    """Captures of each url in ``urls``, with the record's fields and payload, by ranges alone."""
    heads = blocks.groupBy("path").agg(F.min("first_key").alias("first"), F.max("last_key").alias("last")).orderBy("first", "last").collect()
    files = spark.sparkContext.broadcast([(r["first"], r["last"], r["path"]) for r in heads])
    return urls.select(F.col(url).alias("url")).mapInArrow(_find(files), "asked string, " + RECORDS)


@lru_cache(maxsize=64)
def _directory(path: str) -> list[list]:
    fs, own = _open(path + ".dir")
    with fs.open_input_stream(own, compression=None) as source:
        return json.loads(source.read())


def _range(path: str, offset: int, length: int) -> bytes:
    fs, own = _open(path)
    with fs.open_input_file(own) as source:
        source.seek(offset)
        return zlib.decompress(source.read(length), 31)


def _find(files_sent):
    def captures(key: str) -> Iterator[list]:
        files = files_sent.value
        at = bisect.bisect_right([f[0] for f in files], key)
        for _, last, path in files[:at]:
            if last < key:
                continue
            sparse = _directory(path)
            firsts = [d[0] for d in sparse]
            for _, offset, length in sparse[max(0, bisect.bisect_left(firsts, key) - 1) : bisect.bisect_right(firsts, key)]:
                for line in _range(path, offset, length).decode().splitlines():
                    own, _, rest = line.partition(" ")
                    if own == key:
                        yield json.loads(rest)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORDS.split(", ")]
        for batch in batches:
            for asked in batch.column("url").to_pylist():
                key = url_key(asked)
                rows = [(asked, *(fields[n] for n in names)) for c in captures(key) for fields in (parsed(_range(c[3], c[4], c[5])),)]
                yield _batch(rows, "asked string, " + RECORDS)

    return find


def archive_report(pages: DataFrame) -> DataFrame:
    """One row per input row, from the archives as read back: page_id, payload_bytes, payload_digest,
    record_type, refers_to. An empty table writes no file and gives an empty result.

    The archives are indexed, and the records are those that the index leads to."""
    root = scratch_path(pages.sparkSession, "warc-archives")
    captures = indexed_captures(written_archives(pages, f"{root}/archives"), f"{root}/index")
    return read_archives(captures).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

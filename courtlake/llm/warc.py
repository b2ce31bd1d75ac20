"""WARC archives with a two-level capture index.

Captures are written as one gzip member a record. The index has a line for each capture, sorted by
its URL key (host reversed), in compressed blocks of ``BLOCK_LINES`` lines. Each index shard has a
directory file beside it, with the first and last key and the place of every block. A look-up finds
the shard and then the block by binary search, reads the block's range, and reads the ranges of
the records it names. A task holds one shard's directory and one block at a time; the list of
shards (one line for ``SHARD_CAPTURES`` captures) goes to all tasks.

Files are written by the tasks under names of their own; only those that a finished task has
reported are named by the index, so that repeated tasks do no harm.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.llm.common import OUT_ROWS, saved

BLOCK_LINES = 3000
SHARD_CAPTURES = 1_000_000
#: An archive file is closed beyond this size.
FILE_BYTES = 1 << 30
GZIP_LEVEL = 4
DATE = "2000-01-01T00:00:00Z"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Archive:
    """A finished archive: its folder, and first key, last key and name of each index shard."""

    path: str
    shards: tuple[tuple[str, str, str], ...]


def url_key(url: str | None) -> str:
    """Reversed host, then path and query: ``com,example,www)/page?q=1``. A null URL has no key ("")."""
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", (url or "").strip())
    try:
        parts = urlsplit(url)
        host, port = parts.hostname, parts.port
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    if port and port != {"http": 80, "https": 443}.get(parts.scheme):
        host += f":{port}"
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}){parts.path or '/'}{query}"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, name: str) -> bytes:
    """One record, uncompressed; a revisit has no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is None:
        http += b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    else:
        http += b"\r\n"
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{name if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or ""),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(http)),
    }
    if refers_to is not None:
        head |= {"WARC-Profile": IDENTICAL, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + http + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[:int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if re.fullmatch(r"-?\d+", number) else None


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _with_originals(spark: SparkSession, pages: DataFrame, min_bytes: int) -> DataFrame:
    """``page_id, url, payload, refers_to``: the smallest page_id of an equal payload, if another's."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.unhex(F.sha1("payload")))
    equal = saved(
        spark,
        rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(
            F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select(
            F.col("digest").alias("same"), "first"),
        "warc-equal",
    )
    other = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return rows.join(equal, rows.digest == equal.same, "left").select(
        "page_id", "url", "payload", "digest", other.alias("refers_to"))


def write_archive(spark: SparkSession, pages: DataFrame, path: str, min_bytes: int = 0,
                  block_lines: int = BLOCK_LINES, shard_captures: int = SHARD_CAPTURES) -> Archive:
    """Write ``pages(page_id, url, html)`` and their index below ``path``, a shared folder.

    Rows whose payload of at least ``min_bytes`` also belongs to a smaller page_id become revisits
    of the smallest. Null html is an empty payload. Rows that repeat the smallest page_id of a
    payload are responses each; rows without page_id revisit any row that has one. Extra columns
    are left behind; an empty table makes an archive without shards.
    """
    schema = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()),
                        ("offset", pa.int64()), ("size", pa.int64())])

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(path)
        out, name, offset = None, "", 0
        rows: list[tuple] = []
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, digest, refers_to = (c[i].as_py() for c in batch.columns)
                if out is None or offset >= FILE_BYTES:
                    if out:
                        out.close()
                    name, offset = f"warc/{uuid.uuid4().hex}.warc.gz", 0
                    store.create_dir(f"{root}/warc", recursive=True)
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                packed = _gzip(record(page_id, url, payload, base64.b32encode(digest).decode(),
                                      refers_to, f"none-{uuid.uuid4().hex}"))
                out.write(packed)
                rows.append((url_key(url), page_id, name, offset, len(packed)))
                offset += len(packed)
            if len(rows) >= OUT_ROWS:
                yield _batch(schema, rows)
                rows = []
        if out:
            out.close()
        if rows:
            yield _batch(schema, rows)

    captures = saved(
        spark,
        _with_originals(spark, pages, min_bytes).mapInArrow(
            write, "key string, page_id long, file string, offset long, size long"),
        "warc-captures",
    )
    return _write_index(captures, path, block_lines, shard_captures)


def _write_index(captures: DataFrame, path: str, block_lines: int, shard_captures: int) -> Archive:
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(path)
        name = f"index/{uuid.uuid4().hex}"
        out, directory, offset, lines = None, [], 0, []

        def block() -> None:
            nonlocal out, offset
            if out is None:
                store.create_dir(f"{root}/index", recursive=True)
                out = store.open_output_stream(f"{root}/{name}.gz", compression=None)
            packed = _gzip("\n".join("\t".join(map(str, x)) for x in lines).encode())
            out.write(packed)
            directory.append((lines[0][0], lines[-1][0], offset, len(packed)))
            offset += len(packed)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                lines.append(row)
                if len(lines) == block_lines:
                    block()
                    lines = []
        if lines:
            block()
        if out:
            out.close()
            with store.open_output_stream(f"{root}/{name}.dir", compression=None) as beside:
                beside.write("\n".join("\t".join(map(str, x)) for x in directory).encode())
            yield pa.RecordBatch.from_pydict({
                "first": [directory[0][0]], "last": [directory[-1][1]], "name": [name]})

    n = captures.count()
    parts = captures.repartitionByRange(-(-n // shard_captures) or 1, "key", "page_id", "file", "offset")
    rows = parts.sortWithinPartitions("key", "page_id", "file", "offset").select(
        "key", "file", "offset", "size").mapInArrow(write, "first string, last string, name string")
    return Archive(path, tuple(sorted((r.first, r.last, r.name) for r in rows.collect())))


@lru_cache(maxsize=2)
def _directory(path: str, name: str) -> tuple[list[str], list[str], list[tuple[int, int]]]:
    store, root = _store(path)
    with store.open_input_stream(f"{root}/{name}.dir", compression=None) as f:
        rows = [line.split("\t") for line in f.read().decode().split("\n")]
    return [r[0] for r in rows], [r[1] for r in rows], [(int(r[2]), int(r[3])) for r in rows]


def _between(first: list[str], last: list[str], key: str) -> range:
    """Which sorted ranges may hold the key."""
    return range(bisect_left(last, key), bisect_right(first, key))


def look_up(spark: SparkSession, archive: Archive, urls: DataFrame) -> DataFrame:
    """All captures of the URLs in ``urls(url)``, read from the archive.

    Columns: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload`` (null
    for a revisit). URLs are compared by ``url_key``; repeated ones count once, unknown ones give
    no row, and null finds the captures without URL. The digest of every payload is checked.
    """
    path, shards = archive.path, archive.shards
    firsts, lasts = [s[0] for s in shards], [s[1] for s in shards]

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"key": pa.array(
                [url_key(u) for u in batch.column("url").to_pylist()], pa.string())})

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key in batch.column("key").to_pylist():
                for s in _between(firsts, lasts, key):
                    first, last, places = _directory(path, shards[s][2])
                    rows += [(shards[s][2], *places[b], key) for b in _between(first, last, key)]
            for i in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_pydict(
                    dict(zip(("name", "offset", "size", "key"), map(list, zip(*rows[i:i + 10_000])))))

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload", pa.binary())])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(path)
        files: dict[str, object] = {}

        def at(name: str, offset: int, size: int) -> bytes:
            if name not in files:
                if len(files) >= 16:
                    files.pop(next(iter(files))).close()
                files[name] = store.open_input_file(f"{root}/{name}")
            files[name].seek(offset)
            return zlib.decompress(files[name].read(size), 31)

        def captures(place: tuple, wanted: set[str]) -> Iterator[tuple]:
            name, offset, size = place
            for line in at(f"{name}.gz", offset, size).decode().split("\n"):
                key, file, start, length = line.split("\t")
                if key in wanted:
                    yield _row(at(file, int(start), int(length)))

        def found() -> Iterator[tuple]:
            place, wanted = None, set()
            for batch in batches:
                for *here, key in zip(*(batch.column(c).to_pylist() for c in ("name", "offset", "size", "key"))):
                    if here != place:
                        if place:
                            yield from captures(place, wanted)
                        place, wanted = here, set()
                    wanted.add(key)
            if place:
                yield from captures(place, wanted)

        rows, size = [], 0
        for row in found():
            rows.append(row)
            size += len(row[-1] or b"")
            if len(rows) >= OUT_ROWS or size >= 4 << 20:
                yield _batch(schema, rows)
                rows, size = [], 0
        if rows:
            yield _batch(schema, rows)
        for f in files.values():
            f.close()

    wanted = saved(spark, urls.select(F.col("url").cast("string").alias("url")).mapInArrow(
        keys, "key string").distinct(), "warc-wanted")
    blocks = wanted.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(
        search, "name string, offset long, size long, key string")
    return blocks.repartition("name", "offset").sortWithinPartitions("name", "offset").mapInArrow(
        read, "page_id long, url string, payload_bytes long, payload_digest string, "
              "record_type string, refers_to long, payload binary")


def _row(data: bytes) -> tuple:
    fields, payload = parsed(data)
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and base32_sha1(payload) != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return (_page(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], int(fields["Payload-Length"]),
            digest, fields["WARC-Type"], _page(fields.get("WARC-Refers-To", "")),
            payload if response else None)

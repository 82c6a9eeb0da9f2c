"""WARC archives with a two-level capture index.

Pages are written as WARC 1.1 records, each its own gzip member, and every
record gets an index entry under its reversed-host URL key. Entries are
range-partitioned and sorted by key; each partition writes one index shard
made of compressed blocks of entries. A sparse directory holds one row per
block. A lookup finds the shards of a key in a small table, binary-searches
the shard's directory, reads the block by byte range, binary-searches its
entries, and then reads the records by byte range.

Tasks write through ``pyarrow.fs`` (local, HDFS, S3, GCS) into a folder all
executors share. A file is written under a fresh name by each attempt of a
task and counts only through the rows that attempt returns, so a retried task
or a lost executor leaves at most an unused file.
"""
from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huddlekit.llm.common import blobs, cut, new_folder

BLOCK_ENTRIES = 256          # index entries per compressed block
ROLL_BYTES = 1 << 30         # a task starts a new archive file beyond this
READ_SPAN = 64 << 20         # records of one stretch of an archive are read by one task
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    raise ValueError(f"a path must name its file system: {path}")


def url_key(url: str | None) -> str:
    """Reversed-host key: ``http://a.b.com:80/x?y#z`` -> ``com,b,a:80)/x?y``."""
    text = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(:\d+)?([^#]*)", text)
    if not m:
        return f"){text}"
    host = ",".join(reversed(m[1].lower().split(".")))
    return f"{host}{m[2] or ''}){m[3] or '/'}"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None,
                 date: str) -> bytes:
    """A response record, or with ``first`` a revisit of that page's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "urn:x-no-url"
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}",
            f"WARC-Record-ID: <urn:x-page:{'null' if page_id is None else page_id}>", f"WARC-Date: {date}",
            f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if first is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-page:{first}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    page = re.fullmatch(r"<urn:x-page:(-?\d+|null)>", fields["WARC-Record-ID"])[1]
    refers = fields.get("WARC-Refers-To")
    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest or len(payload) != length:
            raise ValueError(f"damaged record of page {page}")
    return {"page_id": None if page == "null" else int(page), "url": fields["WARC-Target-URI"], "payload_bytes": length,
            "payload_digest": digest, "record_type": kind, "payload": payload if kind == "response" else None,
            "refers_to": int(re.search(r"-?\d+", refers)[0]) if refers else None}


def write_archives(pages: DataFrame, folder: str, *, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
                   level: int = 4) -> DataFrame:
    """``key, page_id, file, offset, length`` of every record written.

    ``pages`` has ``page_id, url, html``. A null html is an empty payload. Of
    rows with equal payloads of at least ``least_bytes``, those with the
    smallest page id are responses and the others revisits of it; a class
    whose ids are all null is all responses. A page id that is repeated with
    the smallest id's payload is a response each time. Only classes with more
    than one row are joined to the rows, so a corpus without copies moves no
    html between executors."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("html"))
    keyed = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    copies = (keyed.filter(F.octet_length("html") >= least_bytes).groupBy("sha")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 and first is not null"))
    # written first: Spark broadcasts it below the session's size threshold, else splits skewed partitions
    classes = cut(copies.select("sha", "first"), "copies")
    typed = keyed.join(classes, "sha", "left").select(
        "page_id", "url", "html", "sha", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at = None, "", 0
        files, base = opened(folder)
        for b in batches:
            entries = []
            for page_id, url, html, sha, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                                      blobs(b.column(2)), b.column(3).to_pylist(),
                                                      b.column(4).to_pylist()):
                if out is None or at >= ROLL_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    files.create_dir(base, recursive=True)
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                z = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = z.compress(record_bytes(page_id, url, html, digest, first, date)) + z.flush()
                out.write(member)
                entries.append((url_key(url), page_id, name, at, len(member)))
                at += len(member)
            cols = list(zip(*entries)) if entries else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                names=["key", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()

    return cut(typed.mapInArrow(run, "key string, page_id long, file string, offset long, length long"), "captures")


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """The block directory ``shard, first_key, last_key, offset, length,
    entries``: one row per compressed block of sorted entries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = opened(folder)
        name, out, at = f"{uuid.uuid4().hex}.idx", None, 0
        lines: list[tuple[str, str]] = []

        def flush(n: int):
            nonlocal out, at, lines
            if out is None:
                files.create_dir(base, recursive=True)
                out = files.open_output_stream(f"{base}/{name}", compression=None)
            part, lines = lines[:n], lines[n:]
            raw = zlib.compress("\n".join(line for _, line in part).encode(), 6)
            out.write(raw)
            row = (name, part[0][0], part[-1][0], at, len(raw), len(part))
            at += len(raw)
            return row

        def directory(rows) -> pa.RecordBatch:
            types = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                              names=["shard", "first_key", "last_key", "offset", "length", "entries"])
        for b in batches:
            for key, page, file, offset, length in zip(*(c.to_pylist() for c in b.columns)):
                lines.append((key, f"{key}\t{'' if page is None else page}\t{file}\t{offset}\t{length}"))
            rows = []
            while len(lines) >= BLOCK_ENTRIES:
                rows.append(flush(BLOCK_ENTRIES))
            if rows:
                yield directory(rows)
        if lines:
            yield directory([flush(len(lines))])
        if out is not None:
            out.close()

    ordered = captures.select("key", "page_id", "file", "offset", "length")
    ordered = ordered.repartitionByRange("key", "page_id", "file", "offset") \
                     .sortWithinPartitions("key", "page_id", "file", "offset")
    return cut(ordered.mapInArrow(run, "shard string, first_key string, last_key string, offset long, length long, "
                                       "entries long"), "directory")


def look_up(keys: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """``key, page_id, file, offset, length`` of all captures of the given
    distinct keys."""
    tops = directory.groupBy("shard").agg(F.min("first_key").alias("lo"), F.max("last_key").alias("hi")).collect()
    tops = sorted((r["lo"], r["hi"], r["shard"]) for r in tops)      # one row per index shard file
    lows, highs = [t[0] for t in tops], [t[1] for t in tops]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shards, found = [], []
            for key in b.column(0).to_pylist():
                # shards are in key order; a key may run over several of them
                for k in range(bisect.bisect_left(highs, key), bisect.bisect_right(lows, key)):
                    shards.append(tops[k][2])
                    found.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.string()), pa.array(found, pa.string())],
                                             names=["shard", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = opened(folder)
        shard, blocks, file = None, [], None
        held, entries, entry_keys = None, [], []
        for b in batches:
            out = []
            for s, key, last, offset, length in zip(*(c.to_pylist() for c in b.columns)):
                if s != shard:
                    shard, blocks, held = s, [], None
                    file = files.open_input_file(f"{base}/{s}")
                if last is not None:        # a directory row; they come before the keys
                    blocks.append((last, key, offset, length))
                    continue
                k = bisect.bisect_left(blocks, (key,))      # first block whose last key is not before
                while k < len(blocks) and blocks[k][1] <= key:
                    if held != k:
                        raw = zlib.decompress(file.read_at(blocks[k][3], blocks[k][2])).decode()
                        held, entries = k, [line.split("\t") for line in raw.split("\n")]
                        entry_keys = [e[0] for e in entries]
                    for e in entries[bisect.bisect_left(entry_keys, key):bisect.bisect_right(entry_keys, key)]:
                        out.append((key, int(e[1]) if e[1] else None, e[2], int(e[3]), int(e[4])))
                    k += 1
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                names=["key", "page_id", "file", "offset", "length"])

    routed = keys.select("key").mapInArrow(route, "shard string, key string")
    none = F.lit(None)
    rows = directory.select("shard", F.col("first_key").alias("key"), F.col("last_key").alias("last"), "offset", "length") \
        .unionByName(routed.select("shard", "key", none.cast("string").alias("last"), none.cast("long").alias("offset"),
                                   none.cast("long").alias("length")))
    dealt = rows.repartition("shard").sortWithinPartitions("shard", F.col("last").isNull(), "last", "offset", "key")
    return dealt.mapInArrow(run, "key string, page_id long, file string, offset long, length long")


def read_records(captures: DataFrame, folder: str, *, payloads: bool = False) -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest, record_type,
    refers_to`` (and ``payload``) of the captures, read by byte range;
    response payloads are checked against their digests."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * payloads]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), *[pa.binary()] * payloads]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = opened(folder)
        name, file = None, None
        for b in batches:
            rows = []
            for f, offset, length in zip(*(c.to_pylist() for c in b.columns)):
                if f != name:
                    name, file = f, files.open_input_file(f"{base}/{f}")
                r = parse_record(gzip.decompress(file.read_at(length, offset)))
                rows.append([r[n] for n in names])
            cols = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    spans = captures.select("file", "offset", "length", F.floor(F.col("offset") / READ_SPAN).alias("span"))
    dealt = spans.repartition("file", "span").sortWithinPartitions("file", "offset").drop("span")
    return dealt.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, "
                                 "record_type string, refers_to long" + ", payload binary" * payloads)


def key_table(pages: DataFrame) -> DataFrame:
    """The distinct keys of the pages' URLs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in b.column(0).to_pylist()], pa.string())],
                                             names=["key"])
    return pages.select(F.col("url").cast("string")).distinct().mapInArrow(run, "key string").distinct()


def archive_round_trip(pages: DataFrame, *, least_bytes: int = 0, payloads: bool = False) -> DataFrame:
    """Write all pages, index them, look up every page's key and read the
    records back: one row per page row, see ``read_records``. An empty table
    gives an empty result; columns other than page_id, url and html are not
    read; a null or odd URL is indexed under a key of its own text."""
    folder = new_folder(pages.sparkSession, "archive")
    captures = write_archives(pages, folder, least_bytes=least_bytes)
    directory = write_index(captures, folder)
    return read_records(look_up(key_table(pages), directory, folder), folder, payloads=payloads)

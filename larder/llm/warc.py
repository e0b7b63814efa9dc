"""WARC archives with a two-level capture index.

Writing: every task appends gzip members, one a record, to archives of its own in a shared folder
and reports where each record lies; the report is written as a table, so only files of committed
attempts are ever referred to. Payloads of at least ``REVISIT_BYTES`` that occur again are stored
once, as the response of the largest page id; the others become revisit records.

Indexing: captures are sorted by reversed-host URL key and page id, cut into blocks of
``BLOCK_LINES`` lines, and compressed block by block; one row for each block (its first and last
key, file, offset, length) makes the sparse directory.

Reading: wanted keys are sorted; a task reads the part of the directory that spans its keys,
finds each key's block by binary search, reads that block by its byte range, finds the key's lines
by binary search, and reads records by their byte ranges. Nothing is read whole by one process.

Files are opened through ``pyarrow.fs``, so the shared folder can be any store it knows.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import math
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from larder.llm.batches import bound_batches
from larder.sources.staging import new_path, stage

REVISIT_BYTES = 1000
BLOCK_LINES = 2000
ARCHIVE_BYTES = 1 << 30
#: Captures carry no time of their own.
DATE = "2020-01-01T00:00:00Z"
_GAP = 1 << 16
_READ_ROWS = 2000
#: Keys whose records one task reads back.
LOOK_UP_KEYS = 5000

LOCATED = "url string, page_id string, key string, file string, offset long, length long"


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def url_key(url: str | None) -> str:
    """Reversed host, then port, path and query: ``com,example)/a?b``. Null and odd URLs keep their text.

    Control characters and spaces are escaped, so a key fits into a line of the index.
    """
    url = (url or "").strip()
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").rstrip(".")
        port = parts.port
    except ValueError:
        host, port, parts = "", None, None
    if not host:
        key = ")" + url
    else:
        usual = {"http": 80, "https": 443}.get(parts.scheme)
        key = ",".join(reversed(host.split("."))) + (f":{port}" if port and port != usual else "") + ")"
        key += (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return _escaped(key)


def _escaped(text: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def sort_key(url: str | None, page_id: str | None) -> str:
    """What the index is sorted by: URL key, then page id."""
    return f"{url_key(url)} {_escaped(page_id) if page_id is not None else '-'}"


def _line(value: str) -> str:
    """A header value on one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def _record(url: str | None, page_id: str | None, payload: bytes, refers_to: str | None, revisit: bool) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {url}")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {_line(url)}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"X-Page-Id: {page_id}"] if page_id is not None else []),
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"X-Refers-To-Page-Id: {refers_to}",
            f"X-Payload-Length: {len(payload)}",
        ]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one uncompressed record; a revisit's payload is empty."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if not lines[0].startswith("WARC/") or len(rest) != len(block) + 4:
        raise ValueError("not a WARC record")
    return headers, block.partition(b"\r\n\r\n")[2]


def _member(data: bytes) -> bytes:
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def _with_revisits(pages: DataFrame) -> DataFrame:
    """url, page_id (as text), html, refers_to, revisit. Only digests that occur again are joined."""
    html = F.coalesce("html", F.lit("")).cast("string")
    narrow = pages.select("page_id", F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).alias("n"))
    # Written, so that Catalyst knows how few digests there are before texts move.
    again = stage(
        narrow.where(F.col("n") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("copies"), F.max("page_id").alias("first"))
        .where("copies > 1")
        .select("digest", F.col("first").cast("string").alias("first")),
        "repeated-payloads",
    )
    marked = pages.select(
        F.col("url").cast("string").alias("url"),
        F.col("page_id").cast("string").alias("page_id"),
        html.alias("html"),
        F.when(F.octet_length(html) >= REVISIT_BYTES, F.sha1(html.cast("binary"))).alias("digest"),
    )
    # Rows repeated under the largest id are all responses; with null ids only, all are.
    return marked.join(again, "digest", "left").select(
        "url",
        "page_id",
        "html",
        F.col("first").alias("refers_to"),
        (F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit"),
    )


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every row of ``pages`` (page_id, url, html) as a record below ``folder``.

    Returns where each lies: url, page_id, key, file, offset, length. A null html has an empty
    payload; a null url or id is left out of the record's headers.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _filesystem(folder)
        store.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        task = TaskContext.get()
        try:
            for batch in batches:
                rows = []
                for url, page_id, html, refers_to, revisit in zip(*(batch[c].tolist() for c in batch.columns)):
                    if out is None or at >= archive_bytes:
                        if out is not None:
                            out.close()
                        name = f"{task.partitionId():05d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.gz"
                        out, at = store.open_output_stream(f"{root}/{name}", compression=None), 0
                    payload = html.encode("utf-8", "surrogatepass")
                    data = _member(_record(url, page_id, payload, refers_to, revisit))
                    out.write(data)
                    rows.append((url, page_id, sort_key(url, page_id), name, at, len(data)))
                    at += len(data)
                yield pd.DataFrame(rows, columns=["url", "page_id", "key", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    bound_batches(pages.sparkSession)
    return stage(_with_revisits(pages).mapInPandas(write, LOCATED), "captures")


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Compressed blocks of sorted index lines below ``folder``; returns the sparse directory.

    The directory is a table sorted by first key: first, last, file, offset, length, lines. A line
    is the key and a JSON object with url, file, offset and length. Captures of one key may span
    blocks and files.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _filesystem(folder)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        name = f"{task.partitionId():05d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.cdx.gz"
        out, at, lines, directory = None, 0, [], []

        def end_block() -> None:
            nonlocal out, at, lines
            out = out or store.open_output_stream(f"{root}/{name}", compression=None)
            data = _member("".join(f"{k} {j}\n" for k, j in lines).encode())
            out.write(data)
            directory.append((lines[0][0], lines[-1][0], name, at, len(data), len(lines)))
            at, lines = at + len(data), []

        for batch in batches:
            for url, key, file, offset, length in zip(
                *(batch[c].tolist() for c in ("url", "key", "file", "offset", "length"))
            ):
                lines.append((key, json.dumps({"url": url, "file": file, "offset": offset, "length": length})))
                if len(lines) == block_lines:
                    end_block()
        if lines:
            end_block()
        if out is not None:
            out.close()
        yield pd.DataFrame(directory, columns=["first", "last", "file", "offset", "length", "lines"])

    sort = captures.select("url", "key", "file", "offset", "length")
    blocks = sort.repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    return stage(
        blocks.mapInPandas(write, "first string, last string, file string, offset long, length long, lines long"),
        "block-directory",
    )


class Ranges:
    """Byte ranges of files below a folder; ranges close to each other are read together."""

    def __init__(self, folder: str):
        self.store, self.root = _filesystem(folder)

    def read(self, wanted: list[tuple[str, int, int]]) -> list[bytes]:
        out: list[bytes] = [b""] * len(wanted)
        order = sorted(range(len(wanted)), key=lambda i: wanted[i])
        i = 0
        while i < len(order):
            file, start, length = wanted[order[i]]
            end, j = start + length, i + 1
            while j < len(order) and wanted[order[j]][0] == file and wanted[order[j]][1] <= end + _GAP and end - start < 1 << 24:
                end = max(end, wanted[order[j]][1] + wanted[order[j]][2])
                j += 1
            with self.store.open_input_file(f"{self.root}/{file}") as source:
                data = source.read_at(end - start, start)
            for k in order[i:j]:
                _, at, n = wanted[k]
                out[k] = data[at - start : at - start + n]
            i = j
        return out


class Directory:
    """The sparse directory, held as a sorted table of which only spanned parts are read."""

    def __init__(self, path: str):
        import pyarrow.dataset as ds

        store, root = _filesystem(path)
        self.table = ds.dataset(root, filesystem=store, format="parquet")

    def spanning(self, low: str, high: str) -> list[tuple[str, str, str, int, int]]:
        """Blocks that may hold keys from ``low`` to ``high``, in order of their first key."""
        import pyarrow.compute as pc

        part = self.table.to_table(filter=(pc.field("first") <= high) & (pc.field("last") >= low))
        return sorted(zip(*(part[c].to_pylist() for c in ("first", "last", "file", "offset", "length"))))


def find_lines(keys: list[str], directory: Directory, ranges: Ranges) -> Iterator[tuple[str, dict]]:
    """(key, entry) for every capture of the sorted distinct ``keys``."""
    if not keys:
        return
    blocks = directory.spanning(keys[0], keys[-1])
    firsts = [b[0] for b in blocks]
    held, held_at = [], -1
    for key in keys:
        # The last block that begins before the key may already hold it.
        at = max(0, bisect.bisect_left(firsts, key) - 1)
        while at < len(blocks) and blocks[at][0] <= key:
            if blocks[at][1] >= key:
                if at != held_at:
                    _, _, file, offset, length = blocks[at]
                    text = gzip.decompress(ranges.read([(file, offset, length)])[0]).decode()
                    lines = [x.split(" ", 2) for x in text.split("\n")[:-1]]
                    held, held_at = [(f"{k} {n}", j) for k, n, j in lines], at
                i = bisect.bisect_left(held, (key,))
                while i < len(held) and held[i][0] == key:
                    yield key, json.loads(held[i][1])
                    i += 1
            at += 1


def look_up(keys: DataFrame, directory: DataFrame, index_folder: str, archive_folder: str) -> DataFrame:
    """Records of the captures of ``keys`` (column key; repeated keys count once), read back.

    key, url, page_id, record_type, payload (null for a revisit), digest (hex SHA-1 of the full
    payload), payload_bytes (of the full payload), refers_to.
    """
    path = directory.inputFiles()
    where = path[0].rsplit("/", 1)[0] if path else None

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if where is None:
            return
        blocks, index, archives = Directory(where), Ranges(index_folder), Ranges(archive_folder)
        names = ["key", "url", "page_id", "record_type", "payload", "digest", "payload_bytes", "refers_to"]
        for batch in batches:
            found = list(find_lines(batch["key"].tolist(), blocks, index))
            for low in range(0, len(found), _READ_ROWS):
                part = found[low : low + _READ_ROWS]
                rows = []
                for (key, entry), data in zip(part, archives.read([(e["file"], e["offset"], e["length"]) for _, e in part])):
                    headers, payload = parse_record(gzip.decompress(data))
                    kind = headers["WARC-Type"]
                    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:"))
                    if kind == "response" and hashlib.sha1(payload).digest() != digest:
                        raise ValueError(f"damaged record {entry}")
                    rows.append(
                        (
                            key,
                            entry["url"],
                            headers.get("X-Page-Id"),
                            kind,
                            payload if kind == "response" else None,
                            digest.hex(),
                            len(payload) if kind == "response" else int(headers["X-Payload-Length"]),
                            headers.get("X-Refers-To-Page-Id"),
                        )
                    )
                yield pd.DataFrame(rows, columns=names)

    # Keys are small but their records are not: adaptive execution would merge the ranges by the keys'
    # size, and leaves a number of ranges that is given.
    distinct = keys.select("key").distinct()
    ranges = max(1, math.ceil(distinct.count() / LOOK_UP_KEYS))
    return (
        distinct.repartitionByRange(ranges, "key")
        .sortWithinPartitions("key")
        .mapInPandas(
            read,
            "key string, url string, page_id string, record_type string, payload binary, digest string, payload_bytes long, refers_to string",
        )
    )


def archive(pages: DataFrame) -> tuple[DataFrame, DataFrame, str, str]:
    """Archives and index of ``pages`` in the shared folder: captures, directory, and both folders."""
    spark = pages.sparkSession
    archives, index = new_path(spark, "warc"), new_path(spark, "cdx")
    captures = write_archives(pages, archives)
    return captures, write_index(captures, index), archives, index


def op2_query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    captures, directory, archives, index = archive(pages)
    return look_up(captures, directory, index, archives).select(
        F.col("page_id").cast("long").alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
        "url",
    )


OP2_SQL = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, url, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to,
       url
FROM g
"""

"""WARC archives with a two-level capture index.

Archives hold one gzip member per record. Captures are sorted by their reversed-host URL key; every few thousand index
lines are one compressed block, and per index file a sparse directory holds the first key and the place of each block. A
lookup binary-searches the files' first keys, then one directory, then the block, and reads records by byte ranges.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import scratch, stored
from textloom.llm.store import RangeReader, create, keep_only, make_folder

# Payloads below this size are always stored as responses.
LEAST_REVISIT = 100
LINES = 3000
NO_URL = "-"
NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:textloom:warc")
# The revisit profile of the WARC 1.1 standard, and the default ports.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DEFAULT_PORTS = {"http": "80", "https": "443", "ftp": "21"}
URL = re.compile(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?//(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)(?::(\d*))?([^#]*)")


def url_key(url: str | None) -> str:
    """The sort key of a URL: host labels in reverse order, then path and query; scheme, user, default port and fragment go.

    ``http://www.a.example/b?c#d`` becomes ``example,a,www)/b?c``. NULL becomes ``-``; other texts without a host stand
    as they are. Blanks and control characters are percent-encoded, so that a key is one word of an index line.
    """
    if url is None:
        return NO_URL
    found = URL.match(url)
    key = url
    if found:
        scheme, host, port, rest = found.groups()
        labels = host.lower().strip(".").split(".")
        numeric = host.startswith("[") or all(x.isdigit() for x in labels)
        name = host.lower() if numeric else ",".join(reversed(labels))
        port = f":{port}" if port and port != DEFAULT_PORTS.get((scheme or "").lower()) else ""
        key = f"{name}{port}){rest if rest.startswith('/') else '/' + rest}"
    return re.sub(r"[\x00-\x20\x7f-\xa0\u1680\u2000-\u200f\u2028-\u202f\u205f\u3000]", lambda m: quote(m[0]), key) or "%"


def _record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, ':'.join(map(str, parts)))}>"


def _text(value: str) -> str:
    """A header value without line ends."""
    return re.sub(r"[\r\n]", lambda m: quote(m[0]), value)


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, name: str, date: str) -> bytes:
    """A WARC record; a revisit holds the HTTP header with the full payload's length, but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    own = _record_id(name) if revisit or page_id is None else _record_id("response", page_id, digest)
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", own),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", _text(url)))
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if revisit:
        headers.append(("WARC-Profile", REVISIT_PROFILE))
        if refers_to is not None:
            headers += [("WARC-Refers-To", _record_id("response", refers_to, digest)), ("X-Refers-To-Page-ID", str(refers_to))]
    headers.append(("Content-Length", str(len(block))))
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n").encode() + block + b"\r\n\r\n"


def parse_record(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one compressed record; header names in lower case."""
    data = zlib.decompress(member, 31)

    def headers(part: bytes) -> dict[str, str]:
        lines = part.decode().split("\r\n")[1:]
        return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if line)}

    end = data.index(b"\r\n\r\n")
    warc = headers(data[:end])
    block = data[end + 4 : end + 4 + int(warc["content-length"])]
    end = block.index(b"\r\n\r\n")
    return warc, headers(block[:end]), block[end + 4 :]


def with_decisions(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(``page_id``, ``url``, ``payload``, ``digest``, ``first``): ``first`` is the smallest id among equal payloads of at least
    ``LEAST_REVISIT`` bytes where there is more than one.

    Digests are counted before the join, so a payload shared by many pages is one row of the small side.
    """
    payload = F.coalesce(F.col(html_column).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long_ones = rows.filter(F.octet_length("payload") >= LEAST_REVISIT)
    groups = long_ones.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return rows.join(stored(groups.select("digest", "first"), "digests"), "digest", "left")


CAPTURES = "key string, page_id long, file string, offset long, length long"


def write_archives(decided: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", level: int = 4) -> DataFrame:
    """Write one archive per task; returns the captures (``CAPTURES``), stored, so that no record is written twice."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        out, offset, n = None, 0, 0
        for batch in batches:
            rows = []
            for page_id, url, payload, digest, first in zip(*batch.columns, strict=True):
                page_id, url, first, body = page_id.as_py(), url.as_py(), first.as_py(), payload.as_py()
                revisit = first is not None and page_id != first
                record = make_record(page_id, url, body, digest.as_py(), first, revisit, f"{name}:{n}", date)
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = packer.compress(record) + packer.flush()
                out = out or create(folder, name)
                out.write(member)
                rows.append((url_key(url), page_id, name, offset, len(member)))
                offset += len(member)
                n += 1
            yield _captures(rows)
        if out:
            out.close()

    make_folder(folder)
    columns = ["page_id", "url", "payload", "digest", "first"]
    captures = stored(decided.select(*columns).mapInArrow(write, CAPTURES), "captures")
    # One name per task.
    keep_only(folder, {r["file"] for r in captures.select("file").distinct().collect()})
    return captures


def _captures(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 5
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = ["key", "page_id", "file", "offset", "length"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


PARTS = "part long, file string, first string, last string"


def write_index(captures: DataFrame, folder: str, lines: int = LINES) -> list[tuple[str, str, str]]:
    """Sort captures by key into index files of compressed blocks with a directory each.

    Returns (file, first key, last key) per index file in key order: one entry per task. Ranges are cut by key, file and
    offset, so that a URL captured very often is shared out; its captures may go on over blocks and files.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"index-{task.partitionId():06d}-{task.taskAttemptId()}"
        held: list[tuple[str, str]] = []
        out, at, directory, first, last = None, 0, [], None, None

        def flush() -> None:
            nonlocal out, at
            member = zlib.compress("".join(line for _, line in held).encode(), 6)
            out = out or create(folder, name)
            out.write(member)
            directory.append(f"{held[0][0]}\t{held[-1][0]}\t{at}\t{len(member)}\n")
            at += len(member)
            held.clear()

        for batch in batches:
            for row in batch.to_pylist():
                first = row["key"] if first is None else first
                last = row["key"]
                held.append((row["key"], f"{row['key']}\t{row['file']}\t{row['offset']}\t{row['length']}\n"))
                if len(held) == lines:
                    flush()
        if held:
            flush()
        if out:
            out.close()
            with create(folder, f"{name}.dir") as f:
                f.write("".join(directory).encode())
            yield pa.RecordBatch.from_pylist([{"part": task.partitionId(), "file": name, "first": first, "last": last}])

    make_folder(folder)
    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "file", "offset"]
    dealt = captures.select("key", "file", "offset", "length").repartitionByRange(n, *order).sortWithinPartitions(*order)
    parts = sorted(dealt.mapInArrow(write, PARTS).collect())
    keep_only(folder, {p["file"] for p in parts} | {f"{p['file']}.dir" for p in parts})
    return [(p["file"], p["first"], p["last"]) for p in parts]


class Directory:
    """The sparse directory of an index file: first key, last key, offset and length of each block."""

    def __init__(self, folder: str, name: str):
        reader = RangeReader(folder, f"{name}.dir")
        data = bytes(reader.data) if reader.data is not None else reader.file.read()
        rows = [line.split("\t") for line in data.decode().split("\n") if line]
        self.firsts, self.lasts = [r[0] for r in rows], [r[1] for r in rows]
        self.places = [(int(r[2]), int(r[3])) for r in rows]

    def blocks(self, key: str) -> range:
        """The blocks that may hold ``key``, by binary search."""
        return range(bisect_left(self.lasts, key), bisect_right(self.firsts, key))


def locate(urls: DataFrame, folder: str, parts: list[tuple[str, str, str]]) -> DataFrame:
    """(``key``, ``file``, ``block``, ``offset``, ``length``) of every index block that may hold a distinct URL of ``urls``."""
    firsts, lasts = [p[1] for p in parts], [p[2] for p in parts]

    def to_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [url_key(u) for u in batch.column(0).to_pylist()]
            found = [(k, i) for k in keys for i in range(bisect_left(lasts, k), bisect_right(firsts, k))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in found], pa.string()), pa.array([i for _, i in found], pa.int32())], ["key", "part"]
            )

    def to_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Directory] = {}
        done = None
        for batch in batches:
            rows = []
            for key, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if (key, part) == done:
                    continue  # another spelling of the same URL
                done = (key, part)
                if part not in known:
                    known = {part: Directory(folder, parts[part][0])}  # rows come sorted by part
                directory = known[part]
                rows += [(key, parts[part][0], b, *directory.places[b]) for b in directory.blocks(key)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            names = ["key", "file", "block", "offset", "length"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    keyed = urls.distinct().mapInArrow(to_part, "key string, part int")
    blocks = "key string, file string, block int, offset long, length long"
    # Each directory is read by one task; parts hold about as many captures each.
    return keyed.repartition("part").sortWithinPartitions("part", "key").mapInArrow(to_block, blocks)


RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def fetch(located: DataFrame, index: str, archives: str, with_payload: bool = True) -> DataFrame:
    """Read the captures of located keys: index blocks and records by byte range.

    ``payload`` is NULL for revisits, and left out (NULL) without ``with_payload``. A response's size and digest are those of the bytes
    read; a revisit's are those that its record states.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes: dict[str, RangeReader] = {}
        files: dict[str, RangeReader] = {}
        at, lines = None, []

        def reader(cache: dict[str, RangeReader], folder: str, name: str) -> RangeReader:
            if name not in cache:
                if len(cache) >= 64:
                    cache.clear()
                cache[name] = RangeReader(folder, name)
            return cache[name]

        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for row in batch.to_pylist():
                if (row["file"], row["block"]) != at:
                    at = (row["file"], row["block"])
                    data = zlib.decompress(reader(indexes, index, row["file"]).read(row["offset"], row["length"]))
                    lines = [line.split("\t") for line in data.decode().split("\n") if line]
                    keys = [x[0] for x in lines]
                for i in range(bisect_left(keys, row["key"]), bisect_right(keys, row["key"])):
                    _, name, offset, length = lines[i]
                    warc, http, payload = parse_record(reader(files, archives, name).read(int(offset), int(length)))
                    rows.append(_row(warc, http, payload, with_payload))
                    size += len(payload)
                    if len(rows) >= 4096 or size >= 1 << 24:
                        yield _records(rows)
                        rows, size = [], 0
            yield _records(rows)

    # A fixed number of partitions: a located key is short, but stands for whole records.
    n = int(located.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = located.repartition(n, "file", "block").sortWithinPartitions("file", "block", "key")
    return dealt.mapInArrow(read, RECORDS)


def _row(warc: dict[str, str], http: dict[str, str], payload: bytes, with_payload: bool) -> tuple:
    page_id, refers = warc.get("x-page-id"), warc.get("x-refers-to-page-id")
    stated = warc["warc-payload-digest"].removeprefix("sha256:")
    revisit = warc["warc-type"] == "revisit"
    digest = stated if revisit else hashlib.sha256(payload).hexdigest()
    if digest != stated:
        raise ValueError(f"record {warc['warc-record-id']} does not hold the payload that it states")
    size = int(http["content-length"]) if revisit else len(payload)
    kept = payload if with_payload and not revisit else None
    return (
        int(page_id) if page_id else None, warc.get("warc-target-uri"), size, digest, warc["warc-type"],
        int(refers) if refers else None, kept,
    )


def _records(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 7
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


class Archive:
    """Archives and their index in one shared folder."""

    def __init__(self, spark: SparkSession, folder: str, parts: list[tuple[str, str, str]]):
        self.spark, self.folder, self.parts = spark, folder, parts

    def lookup(self, urls: DataFrame, url_column: str | Column = "url", with_payload: bool = True) -> DataFrame:
        """All captures of the distinct URLs of ``urls`` (rows of ``RECORDS``): URLs are the same if their keys are."""
        column = F.col(url_column) if isinstance(url_column, str) else url_column
        located = locate(urls.select(column.cast("string").alias("url")), f"{self.folder}/index", self.parts)
        return fetch(located, f"{self.folder}/index", f"{self.folder}/archive", with_payload)


def archive_pages(pages: DataFrame, folder: str | None = None, **columns: str) -> Archive:
    """Write ``pages`` as WARC records, with revisits for repeated payloads, and index them by URL.

    A NULL html is an empty payload, a NULL URL is indexed under ``-``, a NULL id is left out of its record and never what others refer to unless
    all ids of its payload are NULL (then all are responses). Rows that share the smallest id of a payload are all responses.
    """
    folder = folder or scratch(pages.sparkSession, "warc")
    captures = write_archives(with_decisions(pages, **columns), f"{folder}/archive")
    return Archive(pages.sparkSession, folder, write_index(captures, f"{folder}/index"))

"""WARC archives with a two-level capture index (operator 9).

``write_archives`` stores every page as a gzip member of a WARC file, one file per task. Of pages with
equal payloads the one with the least id is a response, the others are revisits that refer to it and
hold no payload. ``write_index`` sorts the captures by URL key (host reversed, so that a domain is
one range), writes them as compressed blocks of ``BLOCK`` lines and ends each index file with a sparse
directory: first key and place of each block. ``lookup`` sends a key to the index files whose range
holds it, binary-searches their directories, reads the blocks' byte ranges, and ``read_captures`` reads
just the byte ranges of the records.

Files go below a folder that all executors share. Their names are unique to a task attempt, and
only the rows a finished attempt returns refer to them, so a repeated task leaves no wrong entry. Only
the first key of each index file (one per partition) reaches the driver.

Edge cases: null html is an empty payload; a null or empty url has the key "-". Rows without page_id
are written and read back, and are last in the order of ids. Rows equal in page_id, url and html are
the same capture and share a record type. An empty table gives no rows. Other columns are unused.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import math
import re
import struct
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import HOT_ROWS, lookup_join
from .store import stored

BLOCK = 256
_URL = re.compile(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)(?::([0-9]*))?([^#]*)")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """Sort key of a URL: ``com,example,www:8080)/path?query``; scheme, user, fragment go."""
    if not url:
        return "-"
    found = _URL.match(url)
    if not found:
        return re.sub(r"\s", "%20", url)
    host, port, rest = found[1].lower(), found[2], found[3] or "/"
    labels = [host] if host.startswith("[") else host.split(".")[::-1]
    port = f":{port}" if port and port not in ("80", "443") else ""
    return re.sub(r"\s", "%20", f"{','.join(labels)}{port}){rest}")


def _open_fs(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if re.match("file:/[^/]", path) else path)
    return fs.LocalFileSystem(), path


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id, url: str | None, payload: bytes, date: str, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP header (with the payload's length) only."""
    digest = payload_digest(payload)
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}\n{url}\n{digest}")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:uuid:{name}>",
        "WARC-Date": date,
        "WARC-Target-URI": _clean(url or ""),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if page_id is not None:
        head["X-Page-ID"] = str(page_id)
    if revisit:
        head["WARC-Profile"] = _PROFILE
        if refers_to is not None:
            head["X-Refers-To-Page-ID"] = str(refers_to)
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    pairs = (line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {p[0].lower(): p[1] for p in pairs if len(p) == 2}, rest


@dataclass(frozen=True)
class Capture:
    page_id: int | None
    payload_bytes: int
    payload_digest: str
    record_type: str
    refers_to: int | None


def parse(data: bytes) -> tuple[Capture, bytes]:
    """A record's facts and its payload; the digest and length of a response are checked."""
    warc, rest = _headers(data)
    block = rest[: int(warc["content-length"])]
    http, payload = _headers(block)
    kind, digest = warc["warc-type"], warc["warc-payload-digest"].removeprefix("sha1:")
    size = int(http["content-length"])
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"damaged record {warc['warc-record-id']}")
    number = lambda k: int(warc[k]) if k in warc else None
    return Capture(number("x-page-id"), size, digest, kind, number("x-refers-to-page-id")), payload


_CAPTURE = "key string, page_id bigint, file string, start bigint, length bigint"


def write_archives(pages: DataFrame, root: str, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write all pages (page_id, url, html) below ``root``; stored captures (key, page_id, file, start, length)."""
    own = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    own = own.withColumn("sha", F.sha1("html"))
    place = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")
    groups = own.select("sha", "page_id", "url").groupBy("sha").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("n"))
    groups = stored(groups.where("first <> last"), "repeated")
    # Pages of the most frequent payloads find their group in a broadcast of those few and go anywhere.
    hot = groups.orderBy(F.desc("n"), "sha").limit(HOT_ROWS).select("sha", "first")
    rows = lookup_join(own, groups.select("sha", "first"), ["sha"], hot=hot, salt=["page_id", "url"]).select(
        "page_id",
        "url",
        "html",
        (F.col("first").isNotNull() & (place != F.col("first")) & (F.octet_length("html") >= least_bytes)).alias("revisit"),
        F.col("first.page_id").alias("refers_to"),
    )

    def task(batches):
        system, base = _open_fs(root)
        system.create_dir(base, recursive=True)
        name = f"{base}/pages-{uuid.uuid4().hex}.warc.gz"
        at, out = 0, None
        try:
            for batch in batches:
                keys, starts, sizes = [], [], []
                for i in range(batch.num_rows):
                    page_id, url, html, revisit, refers_to = (batch.column(j)[i].as_py() for j in range(5))
                    data = gzip.compress(record(page_id, url, html.encode("utf-8", "replace"), date, refers_to, bool(revisit)), 5, mtime=0)
                    out = out or system.open_output_stream(name, compression=None)
                    out.write(data)
                    keys.append(url_key(url))
                    starts.append(at)
                    sizes.append(len(data))
                    at += len(data)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), batch.column(0), pa.array([name] * len(keys), pa.string()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())],
                    ["key", "page_id", "file", "start", "length"],
                )
        finally:
            if out:
                out.close()

    return stored(rows.mapInArrow(task, _CAPTURE), "captures")


@dataclass(frozen=True)
class Index:
    """Index files in key order: (first key, path) of each."""

    root: str
    files: tuple[tuple[str, str], ...]


def write_index(captures: DataFrame, root: str) -> Index:
    """Sort captures into index files of compressed blocks, each with its directory at the end."""

    def task(batches):
        system, base = _open_fs(root)
        system.create_dir(base, recursive=True)
        name = f"{base}/index-{uuid.uuid4().hex}.cdx.gz"
        out, at, lines, directory, first = None, 0, [], [], None

        def flush():
            nonlocal at
            data = gzip.compress("\n".join(line for _, line in lines).encode(), 5, mtime=0)
            directory.append((lines[0][0], at, len(data)))
            out.write(data)
            at += len(data)
            lines.clear()

        try:
            for batch in batches:
                for row in zip(*(batch.column(j).to_pylist() for j in range(5))):
                    out = out or system.open_output_stream(name, compression=None)
                    first = row[0] if first is None else first
                    lines.append((row[0], json.dumps(row)))
                    if len(lines) == BLOCK:
                        flush()
            if out:
                if lines:
                    flush()
                data = gzip.compress(json.dumps(directory).encode(), 5, mtime=0)
                out.write(data + struct.pack("<Q", len(data)))
        finally:
            if out:
                out.close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([name])], ["key", "file"])

    dealt = captures.repartitionByRange("key", "page_id", "file", "start").sortWithinPartitions("key", "page_id", "file", "start")
    files = stored(dealt.select("key", "page_id", "file", "start", "length").mapInArrow(task, "key string, file string"), "index-files")
    return Index(root, tuple(sorted((r["key"], r["file"]) for r in files.collect())))  # one row per partition


def _directory(handle) -> list:
    size = handle.size()
    (length,) = struct.unpack("<Q", handle.read_at(8, size - 8))
    return json.loads(gzip.decompress(handle.read_at(length, size - 8 - length)))


def lookup(keys: DataFrame, index: Index) -> DataFrame:
    """Captures of the distinct URL keys in column ``key``."""
    firsts = [k for k, _ in index.files]

    def route(batches):
        for batch in batches:
            rows, files = [], []
            for key in batch.column(0).to_pylist():
                # A key may run on over several files; the one before the first equal key may end with it.
                low = max(0, bisect.bisect_left(firsts, key) - 1)
                for i in range(low, bisect.bisect_right(firsts, key)):
                    rows.append(key)
                    files.append(index.files[i][1])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string()), pa.array(files, pa.string())], ["key", "index"])

    def search(batches):
        name, handle, heads, block = None, None, [], (None, None)
        for batch in batches:
            found = []
            for key, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if file != name:
                    system, _ = _open_fs(index.root)
                    name, handle, block = file, system.open_input_file(file), (None, None)
                    directory = _directory(handle)
                    heads = [d[0] for d in directory]
                low = max(0, bisect.bisect_left(heads, key) - 1)
                for i in range(low, bisect.bisect_right(heads, key)):
                    if block[0] != i:
                        _, start, length = directory[i]
                        text = gzip.decompress(handle.read_at(length, start)).decode()
                        rows = [json.loads(line) for line in text.split("\n")]
                        block = (i, rows, [r[0] for r in rows])
                    a, b = bisect.bisect_left(block[2], key), bisect.bisect_right(block[2], key)
                    found += block[1][a:b]
                if len(found) > 5000:
                    yield _captures(found)
                    found = []
            yield _captures(found)

    routed = keys.select("key").mapInArrow(route, "key string, index string")
    # Salting by key keeps the keys of one large index file on several tasks.
    dealt = routed.repartition("index", F.pmod(F.xxhash64("key"), F.lit(4))).sortWithinPartitions("index", "key")
    return dealt.mapInArrow(search, _CAPTURE)


def _captures(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["key", "page_id", "file", "start", "length"])


def read_captures(captures: DataFrame, root: str, payloads: bool = False) -> DataFrame:
    """Read the records of ``captures`` by their byte ranges; ``payload`` only on request (null for revisits)."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "key"] + ["payload"] * payloads
    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, key string" + ", payload binary" * payloads
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()] + [pa.binary()] * payloads

    def task(batches):
        system, _ = _open_fs(root)
        name, handle = None, None
        for batch in batches:
            out = []
            for key, file, start, length in zip(*(batch.column(j).to_pylist() for j in range(4))):
                if file != name:
                    name, handle = file, system.open_input_file(file)
                capture, payload = parse(gzip.decompress(handle.read_at(length, start)))
                row = (capture.page_id, capture.payload_bytes, capture.payload_digest, capture.record_type, capture.refers_to, key)
                out.append(row + ((payload if capture.record_type == "response" else None),) * payloads)
                if payloads and len(out) >= 256:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    # Ranges of one file are read in order; slices of 16 MB let a large file be shared. The rows are small, the
    # work is in the files: the number of tasks comes from their bytes.
    captures = stored(captures, "wanted")
    size = captures.agg(F.sum("length")).first()[0] or 0
    parts = max(int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / (1 << 26)))
    dealt = captures.repartition(parts, "file", F.shiftright("start", 24)).sortWithinPartitions("file", "start")
    return dealt.select("key", "file", "start", "length").mapInArrow(task, schema)


def page_keys(pages: DataFrame) -> DataFrame:
    """Distinct URL keys of ``pages``."""

    def task(batches):
        for batch in batches:
            keys = pa.array([url_key(u) for u in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([keys], ["key"])

    return pages.select(F.col("url").cast("string")).mapInArrow(task, "key string").distinct()

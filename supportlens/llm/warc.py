"""WARC archives with a two-level capture index.

Pages are written as gzip-compressed WARC records, one member each, so that a record can be read by its range.
The captures are sorted by reversed-host URL key and written as compressed blocks. Beside each index file lies a
sparse directory with the first key, offset and length of each block; the key ranges of the index files are the
level above it. A lookup searches the file ranges, then the directory, by halving, and reads single blocks; the
records are then read from the archives by ranges, neighbouring ones at once.

Files go to the folder in ``spark.checkpoint.dir`` through ``pyarrow.fs``, under a name of the task attempt that
wrote them: if a task runs again, its new rows name its new file, and nothing reads the old one.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supportlens.session import new_dir, written

#: Payloads below this size are stored again rather than referred to.
REVISIT_BYTES = 100
#: Captures in a block of the index, bytes after which an archive is closed, bytes read at once, gap read over.
BLOCK_LINES, ARCHIVE_BYTES, READ_BYTES, GAP_BYTES, TASK_BYTES = 512, 1 << 30, 8 << 20, 1 << 16, 128 << 20
DATE = "2024-01-01T00:00:00Z"
NO_URL = "urn:x-no-url"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "skey string, page_id long, file string, offset long, length long"


def url_key(url: str | None) -> str:
    """Reversed-host key: ``com,example,m)/en/25?page=2``. Scheme, user, ``www.``, default port and fragment go; a
    text that isn't such an address is its own key after ``-)``, a null url has the key ``-)``."""
    if url is None:
        return "-)"
    found = re.match(r"(?s)(https?)://(?:[^/?#@]*@)?([^/?#:]+)(?::(\d*))?([^?#]*)(\?[^#]*)?(#.*)?\Z", url.strip(), re.I)
    if not found:
        return "-)" + url
    scheme, host, port, path, search, _ = found.groups()
    host = re.sub(r"^www\d*\.", "", host.lower().rstrip("."))
    usual = {"http": "80", "https": "443"}[scheme.lower()]
    return ",".join(reversed(host.split("."))) + (f":{port}" if port and port != usual else "") + ")" + (path or "/") + (search or "")


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A response record with its payload, or a revisit record without one, compressed as one gzip member."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", NO_URL if url is None else url)
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"X-Page-Id: {'' if page_id is None else page_id}", f"X-Payload-Length: {len(payload)}",
    ]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if revisit:
        head += [f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"]
    else:
        block += payload
    head.append(f"Content-Length: {len(block)}")
    return gzip.compress("\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n", mtime=0)


def parsed(member: bytes) -> dict:
    """What a record says: page, payload (None for a revisit), length and digest of the payload, type, reference."""
    text = zlib.decompress(member, 31)
    head, _, rest = text.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:] if ": " in line)
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    length, payload = int(fields["X-Payload-Length"]), None
    if kind == "response":
        payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]
        if len(payload) != length or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"the archived payload of page {fields.get('X-Page-Id')} doesn't match its digest")
    number = fields.get("X-Page-Id", "")
    return {
        "page_id": int(number) if number else None, "payload": payload, "payload_bytes": length, "payload_digest": digest,
        "record_type": kind, "refers_to": int(fields["X-Refers-To-Page-Id"]) if kind == "revisit" else None,
    }


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _stem() -> str:
    task = TaskContext.get()
    return f"part-{task.partitionId():05d}-{task.taskAttemptId()}"


def write_archives(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write a record per row and return the captures: URL key, page, file, offset and length.

    Of rows with the same payload of at least ``REVISIT_BYTES`` bytes, those with the smallest key are responses
    and the others revisits of it; rows with a null key revisit too if another has a key, else they are responses.
    Null payloads are empty. Repeated rows each get a record.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("body"), F.sha2(body, 256).alias("digest"))
    same = rows.filter(F.octet_length("body") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    first = written(same.filter("n > 1 AND first IS NOT NULL").select("digest", "first"), "warc-first")
    folder = new_dir(spark, "warc")
    plan = rows.join(first, "digest", "left").select("page_id", "url", "body", "digest", "first")
    schema = pa.schema([("skey", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _opened(folder)
        store.create_dir(root)
        stem, number, out, at, name = _stem(), 0, None, 0, ""
        for batch in batches:
            found = []
            for page_id, address, text, digest, least in zip(*batch.columns, strict=True):
                if out is None:
                    name, at, number = f"{stem}-{number}.warc.gz", 0, number + 1
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                page, least = page_id.as_py(), least.as_py()
                revisit = least is not None and page != least
                where, data = address.as_py(), record(page, address.as_py(), text.as_py().encode("utf-8", "surrogatepass"), digest.as_py(), least, revisit)
                out.write(data)
                found.append((url_key(where), page, name, at, len(data)))
                at += len(data)
                if at >= ARCHIVE_BYTES:
                    out.close()
                    out = None
            yield _batch(found, schema)
        if out is not None:
            out.close()

    captures = plan.mapInArrow(run, CAPTURE)
    return written(captures.withColumn("folder", F.lit(folder)), "warc-captures")


@dataclass(frozen=True)
class CaptureIndex:
    """Folder of the index files, and their key ranges: (first key, last key, file), as many as index partitions."""

    folder: str
    archives: str
    parts: list[tuple[str, str, str]]


def build_index(captures: DataFrame) -> CaptureIndex:
    """Sort the captures into compressed blocks with a sparse directory for each index file.

    A key with very many captures spreads over blocks and files, because files are cut by key and place.
    """
    spark = captures.sparkSession
    folder = new_dir(spark, "warc-index")
    some = captures.select("folder").first()
    rows = captures.repartitionByRange("skey", "file", "offset").sortWithinPartitions("skey", "file", "offset").select("skey", "page_id", "file", "offset", "length")
    schema = pa.schema([("first", pa.string()), ("last", pa.string()), ("file", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _opened(folder)
        stem, out, at, directory, held, last = _stem(), None, 0, [], [], None

        def flush():
            nonlocal out, at, held
            if out is None:
                store.create_dir(root)
                out = store.open_output_stream(f"{root}/{stem}.cdx", compression=None)
            data = zlib.compress("\n".join(json.dumps(x) for x in held).encode())
            out.write(data)
            directory.append((held[0][0], at, len(data)))
            at += len(data)
            held = []

        for batch in batches:
            for row in batch.to_pylist():
                last = row["skey"]
                held.append([last, row["page_id"], row["file"], row["offset"], row["length"]])
                if len(held) == BLOCK_LINES:
                    flush()
        if held:
            flush()
        if out is not None:
            out.close()
            with store.open_output_stream(f"{root}/{stem}.dir", compression=None) as beside:
                beside.write(json.dumps(directory).encode())
            yield _batch([(directory[0][0], last, stem)], schema)

    parts = written(rows.mapInArrow(run, "first string, last string, file string"), "warc-parts")
    # One row per index partition: their number is a setting, not the size of the data.
    return CaptureIndex(folder, some["folder"] if some else "", sorted(tuple(r) for r in parts.collect()))


def lookup(index: CaptureIndex, keys: DataFrame) -> DataFrame:
    """Captures of the URL keys in ``keys`` (a string column ``skey``); keys without a capture give no row."""
    firsts, lasts = [p[0] for p in index.parts], [p[1] for p in index.parts]
    names, folder = [p[2] for p in index.parts], index.folder
    wanted = pa.schema([("part", pa.string()), ("skey", pa.string())])
    schema = pa.schema([("skey", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for key in batch.column(0).to_pylist():
                # Files are in key order: from the first whose last key reaches the key to the last that begins with it at most.
                for at in range(bisect_left(lasts, key), bisect_right(firsts, key)):
                    found.append((names[at], key))
            yield _batch(found, wanted)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _opened(folder)
        part, directory, heads, block, lines, file = None, [], [], None, [], None
        try:
            for batch in batches:
                found = []
                for name, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if name != part:
                        if file is not None:
                            file.close()
                        with store.open_input_stream(f"{root}/{name}.dir", compression=None) as beside:
                            directory = json.loads(beside.read())
                        part, heads, block = name, [d[0] for d in directory], None
                        file = store.open_input_file(f"{root}/{name}.cdx")
                    at = max(0, bisect_left(heads, key) - 1)
                    while at < len(directory) and heads[at] <= key:
                        if block != at:
                            _, offset, length = directory[at]
                            file.seek(offset)
                            lines = [json.loads(x) for x in zlib.decompress(file.read(length)).split(b"\n")]
                            block = at
                        for line in lines[bisect_left(lines, key, key=itemgetter(0)) :]:
                            if line[0] > key:
                                break
                            found.append(tuple(line))
                        at += 1
                yield _batch(found, schema)
        finally:
            if file is not None:
                file.close()

    known = keys.select("skey").filter("skey IS NOT NULL").distinct()
    routed = written(known.mapInArrow(route, "part string, skey string"), "warc-wanted")
    dealt = routed.repartitionByRange("part", "skey").sortWithinPartitions("part", "skey")
    return written(dealt.mapInArrow(search, CAPTURE), "warc-found")


def fetch(index: CaptureIndex, captures: DataFrame, payloads: bool = False) -> DataFrame:
    """Read the captures' records by range: page, size and digest of its payload, type and reference.

    Every payload is compared with its digest; a difference raises. ``payloads`` returns the bytes as well.
    """
    root_of = index.archives
    fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    if payloads:
        fields.append(("payload", pa.binary()))
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _opened(root_of)
        open_name, file = None, None
        try:
            for batch in batches:
                wanted = list(zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True))
                at = 0
                while at < len(wanted):
                    name, start, length = wanted[at]
                    end, till = start + length, at + 1
                    while till < len(wanted) and wanted[till][0] == name and wanted[till][1] <= end + GAP_BYTES and wanted[till][1] + wanted[till][2] - start <= READ_BYTES:
                        end, till = max(end, wanted[till][1] + wanted[till][2]), till + 1
                    if name != open_name:
                        if file is not None:
                            file.close()
                        open_name, file = name, store.open_input_file(f"{root}/{name}")
                    file.seek(start)
                    data = file.read(end - start)
                    records = [parsed(data[o - start : o - start + n]) for _, o, n in wanted[at:till]]
                    yield _batch([tuple(r[f.name] for f in schema) for r in records], schema)
                    at = till
        finally:
            if file is not None:
                file.close()

    kinds = {"page_id": "long", "payload_bytes": "long", "payload_digest": "string", "record_type": "string", "refers_to": "long", "payload": "binary"}
    ranges = captures.select("file", "offset", "length")
    # The rows are small and say nothing about the work, which is that of the bytes they stand for.
    total = ranges.agg(F.sum("length")).first()[0] or 0
    tasks = max(captures.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    dealt = ranges.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(run, ", ".join(f"{f.name} {kinds[f.name]}" for f in schema))


def keys_of(pages: DataFrame, url: str = "url") -> DataFrame:
    """The URL keys of the pages, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column(0).to_pylist()], pa.string())], ["skey"])

    return pages.select(url).mapInArrow(run, "skey string").distinct()


def archived(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write the pages to archives, index them, look all their URLs up and read the records back.

    One row per row of ``pages``; an empty table gives an empty result. Null urls share one key, null keys come back
    as null, pages with the same url come back each. Other columns are ignored.
    """
    index = build_index(write_archives(pages, key, url, payload))
    return fetch(index, lookup(index, keys_of(pages, url)))

"""WARC archives of captured pages, and a two-level capture index to read them back.

Writing is one task per archive: each record is a gzip member of its own, so it can be read by its
offset and length. A payload that another capture has too is written once; the others are revisits.

The index: capture keys (reversed host, path) with file, offset and length, sorted and written in
compressed blocks of lines, a file per range of keys. A file ends with its directory, the first key of
each block; a list of the files' first keys, one per file, is all that the driver ever sees. A lookup
searches that list, a directory and a block, each in halves, and then reads one range of an archive.

Files have names of their own for each attempt of a task, and only those that a finished task named are
read; a task that runs again after a lost executor leaves nothing half-written behind.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.llm.common import cut, local_path, partitions, shared_folder, text_or_empty, _files
from acervo.llm.url_rules import host

LEAST_SHARED = 1000  # bytes of a payload from which copies become revisits
BLOCK_LINES = 512
DATE = "1970-01-01T00:00:00Z"  # the tables have no capture dates
NO_KEY = -(2**63)
OPEN_FILES = 32
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def capture_key(url: Column) -> Column:
    """``org,example)/path?query``: labels of the host from the right, then all up to ``#``. Null: ``)``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1), F.lit(""))
    return F.concat(F.array_join(F.reverse(F.split(host(url), r"\.")), ","), F.lit(")"), rest)


def new_folder(spark: SparkSession, name: str) -> str:
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    files, path = _files(spark, folder)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def _file_name(kind: str) -> str:
    task = TaskContext.get()
    return f"{kind}-{task.partitionId():05d}-{task.attemptNumber()}-{uuid.uuid4().hex[:8]}.gz"


def record(kind: str, page: int | None, url: str, payload: bytes, digest: bytes, refers_to: int | None) -> bytes:
    """A WARC/1.1 record. A revisit holds the HTTP header alone, which tells the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    clean = "".join(c if c.isprintable() else "%" + c.encode().hex("%").upper() for c in url)
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Target-URI: {clean}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict, bytes, int]:
    """(headers, payload, length of the full payload) of a record."""
    head, rest = data.split(b"\r\n\r\n", 1)
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    length = next(int(line.split(b": ")[1]) for line in http.split(b"\r\n") if line.startswith(b"Content-Length: "))
    return headers, payload, length


def _page(urn: str | None) -> int | None:
    digits = urn.removeprefix("<urn:page:").removesuffix(">") if urn else ""
    return int(digits) if digits else None


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """One archive per task in ``folder``; returns capture, page, file, offset, length, a row per record.

    Of equal payloads of at least ``LEAST_SHARED`` bytes that with the largest key is the response.
    """
    payload = text_or_empty(body)
    rows = pages.select(
        F.col(f"`{key}`").cast("long").alias("page"),
        text_or_empty(url).alias("url"),
        capture_key(F.col(f"`{url}`")).alias("capture"),
        payload.alias("payload"),
        F.unhex(F.sha1(payload)).alias("digest"),
    )
    # Payloads met more than once: narrow rows, counted before the shuffle.
    shared = rows.where(F.octet_length("payload") >= LEAST_SHARED).groupBy("digest")
    shared = cut(shared.agg(F.max("page").alias("original"), F.count("*").alias("n")).where("n > 1").drop("n"))
    shared = shared.withColumnRenamed("digest", "of")
    wide = rows.join(shared, (F.col("digest") == F.col("of")) & (F.octet_length("payload") >= LEAST_SHARED), "left")
    refers = F.when(~F.col("page").eqNullSafe(F.col("original")), F.col("original"))
    wide = wide.select("page", "url", "capture", "payload", "digest", refers.alias("refers_to"))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = local_path(folder)
        out, name, at = None, _file_name("archive"), 0
        for batch in batches:
            columns = [[], [], [], [], []]
            for page, link, capture, text, digest, to in zip(*(batch.column(i) for i in range(6))):
                if out is None:
                    out = files.open_output_stream(f"{path}/{name}", compression=None)
                page, to = page.as_py(), to.as_py()
                kind = "response" if to is None else "revisit"
                made = record(kind, page, link.as_py(), text.as_py().encode(), digest.as_py(), to)
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = packer.compress(made) + packer.flush()
                out.write(member)
                for column, value in zip(columns, (capture.as_py(), page, name, at, len(member))):
                    column.append(value)
                at += len(member)
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["capture", "page", "file", "offset", "length"])
        if out is not None:
            out.close()

    # Stored, so that no later step writes the archives again.
    return cut(wide.mapInArrow(written, "capture string, page long, file string, offset long, length long"))


def write_index(records: DataFrame, folder: str) -> list[tuple]:
    """Sort the captures into index files; returns (first capture, first page, file, offset, length of the directory)."""
    page = F.coalesce("page", F.lit(NO_KEY)).alias("page")
    lines = records.select("capture", page, "file", "offset", "length")
    lines = lines.repartitionByRange(partitions(records.sparkSession), "capture", "page", "file", "offset")
    lines = lines.sortWithinPartitions("capture", "page", "file", "offset")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = local_path(folder)
        out, name, at, held, directory = None, _file_name("index"), 0, [], []

        def block(lines: list) -> bytes:
            return zlib.compress(json.dumps(lines, separators=(",", ":")).encode())

        def add(lines: list) -> None:
            nonlocal at
            data = block(lines)
            directory.append((*lines[0][:2], at, len(data)))
            out.write(data)
            at += len(data)

        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns))
            if out is None and held:
                out = files.open_output_stream(f"{path}/{name}", compression=None)
            while len(held) >= BLOCK_LINES:
                add(held[:BLOCK_LINES])
                del held[:BLOCK_LINES]
        if out is not None:
            if held:
                add(held)
            data = block(directory)
            out.write(data)
            out.close()
            row = (*directory[0][:2], name, at, len(data))
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], ["capture", "page", "file", "offset", "length"])

    found = lines.mapInArrow(written, "capture string, page long, file string, offset long, length long")
    return sorted(tuple(r) for r in found.collect())  # one row per index file


class Reader:
    """Lookups in index and archives by range reads; keeps the last files, directory and blocks."""

    def __init__(self, folder: str, top: list[tuple]):
        self.files, self.path = local_path(folder)
        self.top, self.firsts = top, [t[:2] for t in top]
        self.opened, self.parsed = OrderedDict(), OrderedDict()

    def _range(self, name: str, offset: int, length: int) -> bytes:
        if name not in self.opened:
            self.opened[name] = self.files.open_input_file(f"{self.path}/{name}")
            if len(self.opened) > OPEN_FILES:
                self.opened.popitem(last=False)[1].close()
        self.opened.move_to_end(name)
        return self.opened[name].read_at(length, offset)

    def _lines(self, name: str, offset: int, length: int) -> list[tuple]:
        place = (name, offset)
        if place not in self.parsed:
            self.parsed[place] = [tuple(x) for x in json.loads(zlib.decompress(self._range(name, offset, length)))]
            if len(self.parsed) > 8:
                self.parsed.popitem(last=False)
        self.parsed.move_to_end(place)
        return self.parsed[place]

    def find(self, capture: str, page: int) -> Iterator[tuple]:
        """(file, offset, length) of all records of a key."""
        key = (capture, page)
        for at in range(max(bisect.bisect_left(self.firsts, key) - 1, 0), len(self.top)):
            if self.firsts[at] > key:
                return
            _, _, name, offset, length = self.top[at]
            directory = self._lines(name, offset, length)
            heads = [d[:2] for d in directory]
            for number in range(max(bisect.bisect_left(heads, key) - 1, 0), len(directory)):
                if heads[number] > key:
                    return
                lines = self._lines(name, *directory[number][2:])
                start = bisect.bisect_left(lines, key)
                for line in lines[start:]:
                    if line[:2] != key:
                        break
                    yield line[2:]

    def read(self, file: str, offset: int, length: int) -> tuple[dict, bytes, int]:
        return parse(zlib.decompress(self._range(file, offset, length), 31))


def read_records(wanted: DataFrame, folder: str, top: list[tuple]) -> DataFrame:
    """Look up each of ``wanted`` (capture, page) and read its records back.

    Returns page, record_type, target_uri, payload (empty for revisits), payload_bytes, payload_digest in
    hexadecimal, refers_to. A response whose payload does not have its digest fails the job.
    """
    page = F.coalesce("page", F.lit(NO_KEY)).alias("page")
    asked = wanted.select("capture", page).distinct()
    asked = asked.repartitionByRange(partitions(wanted.sparkSession), "capture", "page").sortWithinPartitions("capture", "page")
    names = ["page", "record_type", "target_uri", "payload", "payload_bytes", "payload_digest", "refers_to"]
    kinds = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64())

    def rows(reader: Reader, batch: pa.RecordBatch) -> Iterator[tuple]:
        for capture, number in zip(*(c.to_pylist() for c in batch.columns)):
            for place in reader.find(capture, number):
                headers, payload, length = reader.read(*place)
                digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:"))
                kind = headers["WARC-Type"]
                if kind == "response" and (len(payload) != length or hashlib.sha1(payload).digest() != digest):
                    raise ValueError(f"damaged record at {place}")
                yield (
                    _page(headers["WARC-Record-ID"]), kind, headers["WARC-Target-URI"], payload, length, digest.hex(),
                    _page(headers.get("WARC-Refers-To")),
                )

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(folder, top)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                columns = list(zip(*rows(reader, batch.slice(at, 256)))) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return asked.mapInArrow(
        looked_up,
        "page long, record_type string, target_uri string, payload binary, payload_bytes long, payload_digest string, refers_to long",
    )


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Write all pages as archives with an index, then read every capture back through the index.

    * Null body: an empty payload. Null url: the empty address. Null key: a record without a number,
      never the response that others revisit unless no other is there.
    * Repeated rows are records of their own. Other columns are not read. No rows: no rows.
    """
    folder = new_folder(pages.sparkSession, "warc")
    records = write_archives(pages, folder, key, url, body)
    top = write_index(records, folder)
    return read_records(records, folder, top).withColumnRenamed("page", key)

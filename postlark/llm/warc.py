"""WARC records in seekable Zstandard bundles."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlark.session import scratch_path, stage

BUNDLE_BYTES = 64_000_000
FRAME_BYTES = 256_000
READ_BYTES = 16_000_000  # of records to a task that reads them back
SPAN_FRAMES = 16  # frames that one task reads in a row
LEVEL = 3
DATE = "2020-01-01T00:00:00Z"
# Fixed values of the seekable format: a skippable frame that ends in a footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<II")

INDEX = ("page_id bigint, record_id string, bundle string, frame int, frame_start bigint, frame_bytes int, "
         "record_start int, record_bytes int")
RECORD = ("page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, "
          "refers_to bigint, payload binary")


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit that tells the payload's size and digest and where it stands."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to)}"]
    head += [f"WARC-Payload-Digest: sha1:{_digest(payload)}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _headers(lines: bytes) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines.decode().split("\r\n")[1:])}


def _number(urn: str) -> int | None:
    digits = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if digits == "none" else int(digits)


def parse_record(record: bytes) -> tuple:
    """The fields of RECORD; a response's payload is checked against its digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _headers(head)
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    size, digest = int(_headers(http)["content-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
    revisit = fields["warc-type"] == "revisit"
    if not revisit and (len(payload) != size or _digest(payload) != digest):
        raise ValueError(f"record {fields['warc-record-id']} does not hold the payload it names")
    return (_number(fields["warc-record-id"]), fields.get("warc-target-uri"), fields["warc-type"], size, digest,
            _number(fields["warc-refers-to"]) if revisit else None, None if revisit else payload)


class _Bundle:
    """Frames of records on their way into one file, with the index rows that come of them."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        store, place = pafs.FileSystem.from_uri(self.path)
        store.create_dir(place.rpartition("/")[0], recursive=True)
        self.out, self.size = store.open_output_stream(place, compression=None), 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.waiting: list[tuple[int | None, bytes]] = []
        self.waiting_bytes = 0

    def add(self, page_id: int | None, record: bytes) -> list[tuple]:
        self.waiting.append((page_id, record))
        self.waiting_bytes += len(record)
        return self.end_frame() if self.waiting_bytes >= FRAME_BYTES else []

    def end_frame(self) -> list[tuple]:
        if not self.waiting:
            return []
        packed, rows, at = self.packer.compress(b"".join(r for _, r in self.waiting)), [], 0
        for page_id, record in self.waiting:
            rows.append((page_id, record_id(page_id), self.path, len(self.frames), self.size, len(packed), at, len(record)))
            at += len(record)
        self.out.write(packed)
        self.frames.append((len(packed), at))
        self.size += len(packed)
        self.waiting, self.waiting_bytes = [], 0
        return rows

    def close(self) -> list[tuple]:
        rows = self.end_frame()
        table = b"".join(ENTRY.pack(*f) for f in self.frames) + FOOTER.pack(len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()
        return rows


def _arrow(rows: list[tuple], like: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in like]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, like, strict=True)], schema=like)


_INDEX = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("bundle", pa.string()), ("frame", pa.int32()),
                    ("frame_start", pa.int64()), ("frame_bytes", pa.int32()), ("record_start", pa.int32()), ("record_bytes", pa.int32())])
_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _written(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    bundle = None
    for batch in batches:
        rows = []
        for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            bundle = bundle or _Bundle(folder)
            rows += bundle.add(page_id, make_record(page_id, url, payload, refers_to))
            if bundle.size >= BUNDLE_BYTES:
                rows += bundle.close()
                bundle = None
        yield _arrow(rows, _INDEX)
    if bundle:
        yield _arrow(bundle.close(), _INDEX)


def first_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """For each payload (SHA-1) that several pages share and that has at least ``least_bytes``, the smallest page id."""
    slim = pages.select("page_id", F.sha1("payload").alias("_sha"), F.length("payload").alias("_n")).filter(F.col("_n") >= least_bytes)
    return slim.groupBy("_sha").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_pages")).filter(
        "_pages > 1 and _first is not null").select("_sha", "_first")


def write_bundles(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes a record per page (``page_id``, ``url``, ``html``) into bundles under ``folder`` and returns the index.

    The index maps a record's id to its bundle, its frame there and its place within the frame's content. Every task
    attempt writes bundles of its own and only the index rows of the attempt that counts are kept, so a task that runs
    again leaves at worst a bundle that no row names. ``folder`` must be one that all executors reach, named by a path or URI
    that Arrow's file systems know.

    Null html is the empty payload; a null url leaves out the target. Of pages with the same payload those with the
    smallest id are responses, rows that repeat it among them, and the others revisit it; a page without id is a response
    unless another with its payload has one. No rows give no bundles.
    """
    given = pages.select("page_id", "url", F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    marked = given.withColumn("_sha", F.sha1("payload")).join(first_pages(given, least_bytes), "_sha", "left")
    refers = F.when(~F.col("_first").eqNullSafe(F.col("page_id")), F.col("_first"))
    ready = marked.select(F.col("page_id").cast("long"), "url", "payload", refers.cast("long").alias("refers_to"))
    return stage(ready.mapInArrow(lambda batches: _written(batches, folder), INDEX), "warc_index")


class _Reader:
    """Random access to the frames of one bundle through its seek table."""

    def __init__(self, path: str):
        store, place = pafs.FileSystem.from_uri(path)
        self.file = store.open_input_file(place)
        size = self.file.size()
        count, flags, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != SEEKABLE or flags:
            raise ValueError(f"{path} has no seek table")
        table = self.file.read_at(ENTRY.size * count, size - FOOTER.size - ENTRY.size * count)
        self.frames, at = [], 0
        for packed, content in ENTRY.iter_unpack(table):
            self.frames.append((at, packed, content))
            at += packed
        self.unpacker = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        at, packed, content = self.frames[number]
        return self.unpacker.decompress(self.file.read_at(packed, at), max_output_size=content)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path, reader, number, frame = None, None, None, b""
    for batch in batches:
        rows, held = [], 0
        for bundle, at, start, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bundle != path:
                path, reader, number = bundle, _Reader(bundle), None
            if at != number:
                number, frame = at, reader.frame(at)
            rows.append(parse_record(frame[start : start + size]))
            held += size
            if held >= BUNDLE_BYTES:
                yield _arrow(rows, _RECORD)
                rows, held = [], 0
        yield _arrow(rows, _RECORD)


def read_records(index: DataFrame) -> DataFrame:
    """The records that the index rows name, each frame read once per run of rows in it; see RECORD for the columns.

    Revisits have no payload of their own. Give some rows of an index to fetch single records. The index is small beside what
    it names, so the tasks are counted by the bytes of the records and not by its own.
    """
    named_bytes = index.agg(F.sum(F.col("record_bytes").cast("long"))).head()[0] or 0
    tasks = max(1, -(-named_bytes // READ_BYTES))
    spans = index.withColumn("_span", F.expr(f"frame div {SPAN_FRAMES}")).repartition(tasks, "bundle", "_span")
    ordered = spans.sortWithinPartitions("bundle", "frame", "record_start")
    return ordered.select("bundle", "frame", "record_start", "record_bytes").mapInArrow(_read, RECORD)


def bundle_folder(spark) -> str:
    """A new folder for bundles under the shared folder."""
    return scratch_path(spark, "bundles")

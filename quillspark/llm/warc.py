"""WARC records in seekable Zstandard bundles.

A bundle is a file of independent zstandard frames, each with some whole records. Two
skippable frames follow, which any zstandard reader passes over: the record index
(record id, frame, offset in the frame's plain bytes, length) and, last, a seek table as in the
public seekable format (compressed and plain size of each frame, their number,
the magic number). A record is read by its id with one look at the index and one frame.

Equal payloads are stored once: of the records that share one of at least ``least_bytes``
bytes, that with the largest id is a response and the others are revisits that refer to it. Payload
digests are aggregated before they are shuffled, and the html is joined by id, so a payload that very many
pages share loads no task more than another.

Edge cases: a null html is the empty payload; a null url gives no target URI. Control characters and blanks in
urls are percent-encoded in the header. Records without an id are never what others refer to; if all records of a payload have
none, all are responses. Rows that repeat id and payload are all written, and have equal record ids.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import file_system, publish, scratch, table

#: Plain bytes after which a frame is closed, and bytes after which a bundle is.
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 32 << 20
LEVEL = 3
#: WARC-Date of all records; the pages have no date of their own.
DATE = "1970-01-01T00:00:00Z"

# Magic numbers of the seekable format and of the index's skippable frame, names of the format.
SKIPPABLE_INDEX = 0x184D2A5D
SKIPPABLE_SEEK = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_RECORD = pa.schema([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"urn:page:{'' if page_id is None else page_id}:{digest}"


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> tuple[str, bytes]:
    """A record's id and bytes: a response, or a revisit where ``refers_to`` is the response's page."""
    digest = payload_digest(payload)
    own = record_id(page_id, digest)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{own}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_id(refers_to, digest)}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return own, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers (lower-case names), payload (None for revisits) and the payload's size and digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
    block = rest[: int(headers["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    if headers["warc-type"] == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"{headers['warc-record-id']}: the payload is not the one its headers name")
    return {"headers": headers, "payload": payload if headers["warc-type"] == "response" else None, "bytes": size, "digest": digest}


class BundleWriter:
    def __init__(self):
        self.press = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.done: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.index: list[tuple[str, int, int, int]] = []
        self.open: list[bytes] = []
        self.plain = self.total = 0

    def add(self, own: str, data: bytes) -> None:
        self.index.append((own, len(self.sizes), self.plain, len(data)))
        self.open.append(data)
        self.plain += len(data)
        if self.plain >= FRAME_BYTES:
            self._close_frame()

    def _close_frame(self) -> None:
        if self.open:
            frame = self.press.compress(b"".join(self.open))
            self.done.append(frame)
            self.sizes.append((len(frame), self.plain))
            self.total += len(frame)
            self.open, self.plain = [], 0

    def close(self, uri: str) -> int:
        """Publish the bundle; returns its number of records."""
        self._close_frame()
        sink = pa.BufferOutputStream()
        batch = pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*self.index), _RECORD)], schema=_RECORD)
        with pa.ipc.new_stream(sink, _RECORD) as w:
            w.write_batch(batch)
        index = self.press.compress(sink.getvalue().to_pybytes())
        seek = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.done += [struct.pack("<II", SKIPPABLE_INDEX, len(index)), index, struct.pack("<II", SKIPPABLE_SEEK, len(seek)), seek]
        publish(uri, b"".join(self.done))
        return len(self.index)


class Bundle:
    """Reads a bundle from its end: seek table, record index, then frames as they are asked for."""

    def __init__(self, uri: str):
        fs, path = file_system(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        n, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{uri} has no seek table")
        at = size - 9 - 8 * n
        table_ = self.file.read_at(8 * n, at)
        self.places, start = [], 0
        for k in range(n):
            length, plain = struct.unpack_from("<II", table_, 8 * k)
            self.places.append((start, length, plain))
            start += length
        _, length = struct.unpack("<II", self.file.read_at(8, start))
        with pa.ipc.open_stream(zstandard.decompress(self.file.read_at(length, start + 8))) as r:
            self.index = r.read_all()
        self.frame_no, self.frame = -1, b""
        self.rows: dict[str, int] | None = None

    def _frame(self, k: int) -> bytes:
        if k != self.frame_no:
            start, length, plain = self.places[k]
            self.frame_no, self.frame = k, zstandard.ZstdDecompressor().decompress(self.file.read_at(length, start), max_output_size=plain)
        return self.frame

    def records(self) -> Iterator[bytes]:
        for frame, offset, length in zip(*(self.index[c].to_pylist() for c in ("frame", "offset", "length"))):
            yield self._frame(frame)[offset : offset + length]

    def read(self, own: str) -> bytes | None:
        """One record by its id, of several the first: its frame alone is read and decompressed. Ids are looked up in a table that is made at the first call."""
        if self.rows is None:
            ids = self.index["record_id"].to_pylist()
            self.rows = {x: k for k, x in zip(range(len(ids) - 1, -1, -1), reversed(ids))}
        at = self.rows.get(own)
        if at is None:
            return None
        row = self.index.slice(at, 1).to_pylist()[0]
        return self._frame(row["frame"])[row["offset"] : row["offset"] + row["length"]]


def refers(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(page_id, sha, refers_to) of the pages that are revisits; pages: (page_id, payload)."""
    keys = pages.filter(F.octet_length("payload") >= least_bytes).select("page_id", F.sha1("payload").alias("sha"))
    shared = keys.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 and refers_to is not null")
    return keys.join(shared, "sha").filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "sha", "refers_to").distinct()


def write_bundles(pages: DataFrame, store: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record for each row to bundles in the folder ``store``. Returns, and keeps in the
    store as Parquet, the bundles (bundle, n_records)."""
    spark = pages.sparkSession
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.encode(html_col, "UTF-8"), F.lit(b"")).alias("payload"))
    revisits = refers(own.select("page_id", "payload"), least_bytes).select(F.col("page_id").alias("id"), F.col("sha").alias("s"), "refers_to")
    joined = own.withColumn("sha", F.sha1("payload")).join(revisits, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("sha") == F.col("s")), "left")
    fs, path = file_system(store)
    fs.create_dir(path, recursive=True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        made, bundle = [], None

        def close() -> None:
            uri = f"{store}/bundle-{task:06d}-{len(made):04d}.warc.zst"
            made.append((uri, bundle.close(uri)))

        for b in batches:
            for page_id, url, payload, to in zip(*(c.to_pylist() for c in b.columns)):
                bundle = bundle or BundleWriter()
                bundle.add(*build_record(page_id, url, payload, to))
                if bundle.total >= BUNDLE_BYTES:
                    close()
                    bundle = None
        if bundle:
            close()
        yield pa.record_batch([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())], names=["bundle", "n_records"])

    # in order, so that a second attempt of a task parts its rows and names its bundles alike
    ordered = joined.sortWithinPartitions("page_id", "sha", "url")
    ordered.select("page_id", "url", "payload", "refers_to").mapInArrow(work, "bundle string, n_records long").write.parquet(f"{store}/bundles")
    return spark.read.parquet(f"{store}/bundles")


def read_bundles(spark: SparkSession, store: str) -> DataFrame:
    """Read all records back: (page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload)."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def number(urn: str | None) -> int | None:
        found = urn.strip("<>").split(":")[2] if urn else ""
        return int(found) if found else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column(0).to_pylist():
                rows, size = [], 0
                for data in Bundle(uri).records():
                    r = parse_record(data)
                    h = r["headers"]
                    rows.append((number(h["warc-record-id"]), r["bytes"], r["digest"], h["warc-type"], number(h.get("warc-refers-to")), h.get("warc-target-uri"), r["payload"]))
                    size += len(data)
                    if size >= 4 << 20:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    bundles = spark.read.parquet(f"{store}/bundles").select("bundle")
    parts = max(1, min(bundles.count(), 4 * spark.sparkContext.defaultParallelism))
    return bundles.repartition(parts).mapInArrow(work, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = scratch(spark, "warc")
    write_bundles(table(spark, sf_dir, "pages"), store, least_bytes=0)
    return read_bundles(spark, store).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

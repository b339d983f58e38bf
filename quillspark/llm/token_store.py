"""Token ids in a binary store of zstandard frames with one shared dictionary.

A store is a folder: ``dict-<sha256>.zdict`` and shards. A shard is a header (magic, bytes an
id takes, hash of the dictionary), one zstandard frame for each document, an index of
(doc_id, offset, n_tokens) and a footer that says where the index is. A document is its own frame, so a
short one is read by the index, one seek and one small frame; the dictionary, trained on
serialized id arrays, makes small frames small. Shards are in ascending doc_id order;
``manifest`` gives each the number of ids before it.

Rows are dealt by ranges of doc_id and sorted; each task encodes and writes its own
range and publishes whole files, so a second attempt of a task replaces them with the same bytes.

Edge cases: a null text is empty; every document ends in ``end_id``, so none is without ids. Null
ids come first. Rows that repeat a doc_id are all kept, in the order of their texts. With
too few rows to train on the dictionary is empty.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import file_system, publish, scratch, slices, table
from .words import encoder

MAGIC = b"QTOK1\x00"
HEADER = struct.Struct("<6sB32s")
FOOTER = struct.Struct("<QQQ6s")
#: The dictionary: its size, and the most documents and characters in each that it is trained on.
DICT_BYTES = 64 << 10
TRAIN_DOCS = 2000
TRAIN_CHARS = 8192
SHARD_BYTES = 32 << 20
#: Zstandard's level; ids of short texts gain little beyond it.
LEVEL = 3


def serialize(packed: bytes, width: int) -> bytes:
    """Packed 32-bit ids as the store's ids of ``width`` bytes."""
    return packed if width == 4 else np.frombuffer(packed, "<u4").astype("<u2").tobytes()


def restore(data: bytes, width: int) -> bytes:
    return data if width == 4 else np.frombuffer(data, "<u2").astype("<u4").tobytes()


def train_dictionary(docs: DataFrame, path: str, width: int, id_col: str, text_col: str) -> bytes:
    """A dictionary from a bounded sample: the TRAIN_DOCS documents of at most TRAIN_CHARS characters
    whose ids hash lowest. Only the compression depends on it, never a result."""
    short = F.length(text_col) <= TRAIN_CHARS
    chosen = docs.filter(short).select(F.col(id_col).alias("id")).orderBy(F.xxhash64("id"), "id").limit(TRAIN_DOCS).distinct()
    rows = docs.filter(short).join(F.broadcast(chosen), F.col(id_col) == F.col("id"), "left_semi").select(text_col).limit(2 * TRAIN_DOCS).collect()
    samples = [serialize(x, width) for x in encoder(path).encode_packed(sorted(r[0] for r in rows)) if x]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few or too short samples
        return b""


class ShardWriter:
    """One shard in memory, published whole."""

    def __init__(self, width: int, dictionary: bytes):
        self.width = width
        own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.press = zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_checksum=True)
        self.out = io.BytesIO()
        self.out.write(HEADER.pack(MAGIC, width, hashlib.sha256(dictionary).digest()))
        self.index: list[tuple[int | None, int, int]] = []

    def add(self, doc_id: int | None, packed: bytes) -> None:
        self.index.append((doc_id, self.out.tell(), len(packed) // 4))
        self.out.write(self.press.compress(serialize(packed, self.width)))

    def close(self, uri: str) -> tuple[int, int]:
        """Publish the shard; returns its numbers of documents and ids."""
        ids, offsets, counts = zip(*self.index)
        sink = io.BytesIO()
        batch = pa.record_batch([pa.array(ids, pa.int64()), pa.array(offsets, pa.int64()), pa.array(counts, pa.int64())], names=["doc_id", "offset", "n_tokens"])
        with pa.ipc.new_stream(sink, batch.schema) as w:
            w.write_batch(batch)
        at, data = self.out.tell(), zstandard.compress(sink.getvalue())
        self.out.write(data)
        self.out.write(FOOTER.pack(at, len(data), len(ids), MAGIC))
        publish(uri, self.out.getvalue())
        return len(ids), sum(counts)


class Shard:
    """Reads a shard: its index, then single documents by their place in it."""

    def __init__(self, uri: str, store: str):
        fs, path = file_system(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        magic, self.width, digest = HEADER.unpack(self.file.read_at(HEADER.size, 0))
        at, length, self.n, end = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC or end != MAGIC:
            raise ValueError(f"{uri} is no token shard")
        dictionary = _dictionary(store, digest.hex())
        self.press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        with pa.ipc.open_stream(zstandard.decompress(self.file.read_at(length, at))) as r:
            self.index = r.read_all()
        self.offsets = [*self.index["offset"].to_pylist(), at]

    def packed(self, k: int) -> bytes:
        """Packed 32-bit ids of the k-th document."""
        frame = self.file.read_at(self.offsets[k + 1] - self.offsets[k], self.offsets[k])
        return restore(self.press.decompress(frame), self.width)

    def find(self, doc_id: int) -> list[int] | None:
        """Ids of a document by its id, or None: one binary search, one seek, one frame."""
        ids = self.index["doc_id"]
        ids = ids.slice(ids.null_count).to_numpy()  # nulls come first
        k = int(np.searchsorted(ids, doc_id))
        return np.frombuffer(self.packed(self.n - len(ids) + k), "<u4").tolist() if k < len(ids) and ids[k] == doc_id else None


@lru_cache(maxsize=2)
def _dictionary(store: str, digest: str) -> bytes:
    fs, path = file_system(f"{store}/dict-{digest}.zdict")
    with fs.open_input_file(path) as f:
        data = f.read()
    if hashlib.sha256(data).hexdigest() != digest:
        raise ValueError("the store's dictionary is not the one its shards name")
    return data


def write_store(docs: DataFrame, store: str, path: str, end_id: int | None, vocab_size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode whole texts and write them to the folder ``store``.

    Returns the manifest (shard, start, n_docs, n_tokens), also kept as Parquet in the store;
    ``start`` counts the ids of all documents before the shard.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    width = 2 if vocab_size <= 1 << 16 else 4
    dictionary = train_dictionary(docs, path, width, "doc_id", "text")
    digest = hashlib.sha256(dictionary).hexdigest()
    fs, place = file_system(store)
    fs.create_dir(place, recursive=True)
    publish(f"{store}/dict-{digest}.zdict", dictionary)
    tail = b"" if end_id is None else struct.pack("<I", end_id)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        shared, words = _dictionary(store, digest), encoder(path)
        made, shard = [], None
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j in slices(texts):
                for doc_id, packed in zip(ids[i:j], words.encode_packed(texts[i:j])):
                    shard = shard or ShardWriter(width, shared)
                    shard.add(doc_id, packed + tail)
                    if shard.out.tell() >= SHARD_BYTES:
                        uri = f"{store}/shard-{task:06d}-{len(made):04d}.tok"
                        made.append((uri, task, len(made), *shard.close(uri)))
                        shard = None
        if shard:
            uri = f"{store}/shard-{task:06d}-{len(made):04d}.tok"
            made.append((uri, task, len(made), *shard.close(uri)))
        columns = list(zip(*made)) or [[]] * 5
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))], names=["shard", "task", "part", "n_docs", "n_tokens"])

    # by the text's hash, too: rows that repeat one id need not be one task's
    order = ("doc_id", "th", "text")
    dealt = docs.withColumn("th", F.xxhash64("text")).repartitionByRange("doc_id", "th").sortWithinPartitions(*order).select("doc_id", "text")
    dealt.mapInArrow(work, "shard string, task long, part long, n_docs long, n_tokens long").write.parquet(f"{store}/written")
    before = Window.orderBy("task", "part").rowsBetween(Window.unboundedPreceding, -1)  # a row a shard, not a document
    manifest = spark.read.parquet(f"{store}/written").select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"), "n_docs", "n_tokens")
    manifest.write.parquet(f"{store}/manifest")
    return spark.read.parquet(f"{store}/manifest")


def read_store(spark: SparkSession, store: str) -> DataFrame:
    """Read a store back: (doc_id, start, n_tokens, ids), ids packed little-endian 32-bit."""
    return _read(spark, store, "doc_id long, start long, n_tokens long, ids binary", lambda packed: packed, pa.binary())


def read_digests(spark: SparkSession, store: str) -> DataFrame:
    """As ``read_store``, with the ids' CRC-32 in place of the ids."""
    return _read(spark, store, "doc_id long, start long, n_tokens long, ids_crc32 long", zlib.crc32, pa.int64())


def _read(spark: SparkSession, store: str, schema: str, of, kind: pa.DataType) -> DataFrame:
    names = [x.split()[0] for x in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                shard = Shard(uri, store)
                counts = shard.index["n_tokens"].to_numpy()
                starts = start + np.cumsum(counts) - counts
                ids = shard.index["doc_id"].combine_chunks()
                for i in range(0, shard.n, 1024):
                    j = min(shard.n, i + 1024)
                    got = [of(shard.packed(k)) for k in range(i, j)]
                    yield pa.record_batch([ids.slice(i, j - i), pa.array(starts[i:j]), pa.array(counts[i:j]), pa.array(got, kind)], names=names)

    manifest = spark.read.parquet(f"{store}/manifest").select("shard", "start")
    shards = manifest.count()
    return manifest.repartition(max(1, min(shards, 4 * spark.sparkContext.defaultParallelism))).mapInArrow(work, schema)


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = scratch(spark, "tokens")
    write_store(table(spark, sf_dir, "documents"), store, public_tokenizers.path("word_bpe_49k.json"), end_id=1, vocab_size=49408)
    return read_digests(spark, store)

"""Files as files: listings, digests that read a chunk at a time, and archives checked again."""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a file that a task holds at a time.
CHUNK = 4 << 20


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a URI and the path in it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), os.path.abspath(uri))


def listing(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names and sizes of a folder's files. Spark's readers pass over empty files, so they are listed by the file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return {f.getPath().getName(): f.getLen() for f in found if f.isFile()}


def digests(paths: DataFrame, path: str = "path") -> DataFrame:
    """``paths`` with the columns ``bytes`` and ``sha256`` of the file that each row's ``path`` names, null where there is none. A file is read by one task in chunks,
    whatever its size; a digest needs its bytes in order. Rows are dealt out evenly."""
    if {"bytes", "sha256"} & set(paths.columns):
        raise ValueError("columns bytes and sha256 are taken")
    rows = paths.select(*paths.columns, F.col(path).alias("__path")).repartition(max(1, paths.sparkSession.sparkContext.defaultParallelism))

    def one(uri: str | None) -> tuple[int | None, str | None]:
        if uri is None:
            return None, None
        fs, at = file_system(uri)
        if fs.get_file_info(at).type != pafs.FileType.File:
            return None, None
        digest, size = hashlib.sha256(), 0
        with fs.open_input_stream(at) as source:
            while chunk := source.read(CHUNK):
                digest.update(chunk)
                size += len(chunk)
        return size, digest.hexdigest()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [one(uri) for uri in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([s for s, _ in found], pa.int64()), pa.array([d for _, d in found], pa.string())], names=[*b.schema.names[:-1], "bytes", "sha256"])

    return rows.mapInArrow(work, T.StructType([*paths.schema.fields, T.StructField("bytes", T.LongType()), T.StructField("sha256", T.StringType())]))


def folder_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(name, bytes, sha256) of each file of a folder."""
    named = [(name, f"{folder}/{name}") for name in listing(spark, folder)]
    return digests(spark.createDataFrame(named, "name string, path string")).select("name", "bytes", "sha256")


def verify_archives(runs: DataFrame, prefix: str = "") -> DataFrame:
    """Archives of completed runs read again. runs: (id, status, archive_path, archive_hash, archive_bytes); ``prefix`` stands before the digest in archive_hash. Returns (id,
    verified, archive_hash, current_hash, archive_bytes, current_bytes, outcome); outcome: verified, missing, resized (another size), tampered (the size, not the bytes), or
    unavailable for a run that is not completed or has no archive on record, which is not read."""
    there = (F.col("status") == "completed") & F.col("archive_path").isNotNull() & F.col("archive_hash").isNotNull()
    own = runs.select("id", F.when(there, F.col("archive_path")).alias("path"), "archive_hash", "archive_bytes")
    found = digests(own).withColumn("current_hash", F.concat(F.lit(prefix), "sha256"))
    verified = F.coalesce(F.col("current_hash") == F.col("archive_hash"), F.lit(False))
    outcome = (
        F.when(F.col("path").isNull(), "unavailable").when(F.col("sha256").isNull(), "missing").when(verified, "verified")
        .when(F.col("archive_bytes") != F.col("bytes"), "resized").otherwise("tampered")
    )
    return found.select("id", verified.alias("verified"), "archive_hash", "current_hash", "archive_bytes", F.col("bytes").alias("current_bytes"), outcome.alias("outcome"))


class Hashed:
    """A file for writing that counts and hashes what it passes on."""

    def __init__(self, out):
        self.out, self.digest, self.size = out, hashlib.sha256(), 0

    def write(self, data) -> int:
        data = bytes(data)
        self.digest.update(data)
        self.size += len(data)
        self.out.write(data)
        return len(data)

    def flush(self) -> None:
        self.out.flush()


class Files:
    """Small files of a folder by Hadoop's file calls."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.fs, self.conf = spark, spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
        self.root = self.fs.Path(folder)
        self.disk = self.root.getFileSystem(self.conf)

    def at(self, name: str):
        return self.fs.Path(self.root, name)

    def names(self, name: str) -> dict[str, int]:
        """What is in a folder, and when each was written (milliseconds)."""
        path = self.at(name)
        return {s.getPath().getName(): s.getModificationTime() for s in self.disk.listStatus(path)} if self.disk.exists(path) else {}

    def read(self, name: str) -> str:
        source = self.disk.open(self.at(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def replace(self, name: str, text: str) -> None:
        """Write a file whole, in place of one of that name."""
        self._put(name, text, self.fs.Options.Rename.OVERWRITE)

    def create(self, name: str, text: str) -> bool:
        """Write a file whole under a name that must be free; False if it is taken."""
        return self._put(name, text, self.fs.Options.Rename.NONE)

    def _put(self, name: str, text: str, option) -> bool:
        part, target = self.at(f".{uuid.uuid4().hex}"), self.at(name)
        self.disk.mkdirs(target.getParent())
        out = self.disk.create(part, True)
        out.write(bytearray(text.encode()))
        out.close()
        context = self.fs.FileContext.getFileContext(self.root.toUri(), self.conf)
        options = self.spark.sparkContext._gateway.new_array(self.fs.Options.Rename, 1)
        options[0] = option
        try:
            context.rename(self.disk.makeQualified(part), self.disk.makeQualified(target), options)
        except Exception as e:
            self.disk.delete(part, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self.disk.delete(self.at(name), True)

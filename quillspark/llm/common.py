"""Shared helpers of the operators: the shared folder, lineage cuts, row keys."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Text bytes that a Python task takes at a time from an Arrow batch.
SLICE_BYTES = 4 << 20
#: Rows from which on a key's row is broadcast instead of being joined by a shuffle.
HEAVY_ROWS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which the driver and all executors share."""
    return checkpoint_dir(spark)


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back, so that a
    lost executor costs a read and not the work before it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a URI and the path in it; tasks write side files with it."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), os.path.abspath(uri)
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def publish(uri: str, data: bytes) -> None:
    """Write a file whole or not at all: a second attempt of a task replaces the same bytes."""
    fs, path = file_system(uri)
    part = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as out:
        out.write(data)
    fs.move(part, path)


def slices(texts: list, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of a list of texts with about ``limit`` characters each; one long text is whole."""
    start = size = 0
    for k, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, k
            start, size = k, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def unused(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as no column of ``df`` has."""
    while name in df.columns:
        name = "_" + name
    return name


def join_counted(rows: DataFrame, keyed: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """``rows`` with the columns of ``keyed``: (keys, n, ...), one row a key, n being how many of ``rows`` have it. A key that very many rows
    have is not gathered in one task: keys of HEAVY_ROWS rows or more, of which there are at most the rows divided by it, are broadcast.
    ``rows`` must be cheap to read twice. No key is null."""
    heavy = keyed.filter(F.col("n") >= HEAVY_ROWS).drop("n")
    if heavy.isEmpty():
        return rows.join(keyed.drop("n"), keys, how)
    heavy = F.broadcast(heavy)
    return rows.join(heavy, keys).unionByName(rows.join(heavy, keys, "left_anti").join(keyed.filter(F.col("n") < HEAVY_ROWS).drop("n"), keys, how))

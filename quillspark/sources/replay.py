"""Saved pages replayed as a data source, in batch or as a stream.

``register(spark)`` adds the format ``replay``: ``spark.read.format("replay").load(folder)`` gives every page ``<id>.html`` of a folder, and ``spark.readStream`` gives each once, in
order of arrival: by the time the file was last written, then by name. A stream's offset is the last page that a batch holds, so a query that starts
again goes on where its checkpoint stands. A page belongs to a stream once it is ``settle`` seconds old (1): pages that are written within one
tick of the file system's clock are then all there. Pages must appear whole (written elsewhere and renamed) and do not change.

Options: ``path``; ``pages``: how many one task reads (200); ``settle``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from .files import file_system

SCHEMA = "work_id string, html string, bytes long, fetched_at timestamp"
PAGES = 200
SETTLE_SECONDS = 1.0
_END = ".html"


class Pages(InputPartition):
    def __init__(self, paths: list[tuple[str, int]]):
        self.paths = paths


class _Folder:
    """The pages of a folder in order of arrival."""

    def __init__(self, options: dict):
        if not options.get("path"):
            raise ValueError("a replay needs the path of its folder")
        self.path, self.pages = options["path"], int(options.get("pages", PAGES))
        self.settle = float(options.get("settle", SETTLE_SECONDS))

    def listed(self, before_ns: int | None = None) -> list[tuple[int, str]]:
        fs, path = file_system(self.path)
        found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
        own = ((f.mtime_ns, f.base_name) for f in found if f.is_file and f.base_name.endswith(_END))
        return sorted(x for x in own if before_ns is None or x[0] <= before_ns)

    def parts(self, files: list[tuple[int, str]]) -> list[Pages]:
        return [Pages([(name, at) for at, name in files[k : k + self.pages]]) for k in range(0, len(files), self.pages)]

    def rows(self, part: Pages | None) -> Iterator[tuple]:
        """None stands for no pages at all."""
        fs, path = file_system(self.path)
        for name, at in part.paths if part else ():
            with fs.open_input_stream(f"{path}/{name}") as source:
                body = source.read()
            yield name.removesuffix(_END), body.decode("utf-8", "replace"), len(body), datetime.fromtimestamp(at / 1e9, timezone.utc)


class _Reader(DataSourceReader):
    def __init__(self, folder: _Folder):
        self.folder = folder

    def partitions(self) -> Sequence[Pages]:
        return self.folder.parts(self.folder.listed())

    def read(self, partition: Pages) -> Iterator[tuple]:
        return self.folder.rows(partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets are {"at": nanoseconds, "name": name} of the last page."""

    def __init__(self, folder: _Folder):
        self.folder, self.last = folder, None

    def initialOffset(self) -> dict:
        return {"at": 0, "name": ""}

    def latestOffset(self) -> dict:
        found = self.folder.listed(time.time_ns() - int(self.folder.settle * 1e9))
        if found:
            self.last = {"at": found[-1][0], "name": found[-1][1]}
        return self.last or self.initialOffset()

    def partitions(self, start: dict, end: dict) -> Sequence[Pages]:
        after, until = (start["at"], start["name"]), (end["at"], end["name"])
        return self.folder.parts([x for x in self.folder.listed() if after < x <= until])

    def read(self, partition: Pages) -> Iterator[tuple]:
        return self.folder.rows(partition)

    def commit(self, end: dict) -> None:
        pass


class ReplaySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "replay"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(_Folder(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(_Folder(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ReplaySource)


def save_pages(pages: DataFrame, folder: str, work: str = "work_id", html: str = "html") -> DataFrame:
    """Write each page as ``<id>.html`` of a folder, whole under its name or not at all; a null page is empty. Returns (work_id, bytes). Ids must be fit for file names."""
    rows = pages.select(F.col(work).cast("string").alias("work_id"), F.coalesce(F.col(html), F.lit("")).alias("html"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(folder)
        fs.create_dir(path, recursive=True)
        for b in batches:
            sizes = []
            for name, page in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                part = f"{path}/.{uuid.uuid4().hex}"
                with fs.open_output_stream(part) as out:
                    out.write(page)
                fs.move(part, f"{path}/{name}{_END}")
                sizes.append(len(page))
            yield pa.record_batch([b.column(0), pa.array(sizes, pa.int64())], names=["work_id", "bytes"])

    return rows.mapInArrow(write, "work_id string, bytes long")

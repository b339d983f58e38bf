"""Stores of tables published in versions, their retention, backup and verified restore.

A folder holds ``versions/<number>.json``, which names the folder of each table, and ``data/``. A version appears by renaming a finished file to a name that
must not be there yet, so of two writers that read the same version one is told so and nothing is lost. Tables that a writer does not hand over stay where they are. Data
is never changed in place; ``prune`` takes away old versions and what no version names.

A backup is a manifest of one version's files by digest and a pool of their bytes: a file that the pool has is not copied again. A restore reads every copy, checks it, and
only then publishes what it has copied as the folder's next version.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import CHUNK, Files, digests, file_system

#: Data that no version names is left alone for so long, as a writer may still be at it.
GRACE_SECONDS = 24 * 3600


class Conflict(RuntimeError):
    """Another writer has published since the version was read."""


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of a folder's versions, ascending."""
    return sorted(int(n.removesuffix(".json")) for n in Files(spark, folder).names("versions") if n.endswith(".json") and not n.startswith("."))


def _version(disk: Files, number: int) -> dict[str, str]:
    return json.loads(disk.read(f"versions/{number:012d}.json"))["tables"]


def read_version(spark: SparkSession, folder: str, number: int | None = None) -> tuple[int, dict[str, DataFrame]]:
    """A version's number and tables (None: the last; 0 and no tables if there is none)."""
    known = versions(spark, folder)
    number = number if number is not None else known[-1] if known else 0
    tables = _version(Files(spark, folder), number) if number else {}
    return number, {name: spark.read.parquet(f"{folder}/data/{at}") for name, at in tables.items()}


def publish_version(spark: SparkSession, folder: str, base: int, tables: dict[str, DataFrame]) -> int:
    """Write tables as the version after ``base``, the one that they were made from; tables that are not handed over are those of ``base``. Returns the new number;
    Conflict if another writer was first, and then nothing is there of this one."""
    disk, own = Files(spark, folder), uuid.uuid4().hex
    if base + 1 in versions(spark, folder):
        raise Conflict(f"version {base + 1} is there already")
    for name, df in tables.items():
        df.write.parquet(f"{folder}/data/{own}/{name}")
    return _named(disk, base, own, (_version(disk, base) if base else {}) | {name: f"{own}/{name}" for name in tables})


def _named(disk: Files, base: int, own: str, named: dict[str, str]) -> int:
    """Give a version that has been written its number."""
    if disk.create(f"versions/{base + 1:012d}.json", json.dumps({"version": base + 1, "tables": named}, sort_keys=True)):
        return base + 1
    disk.delete(f"data/{own}")
    raise Conflict(f"version {base + 1} is there already")


def prune(spark: SparkSession, folder: str, keep: int = 2, grace: float = GRACE_SECONDS) -> list[str]:
    """Delete all versions but the last ``keep``, then the data that no version names any more and that is older than ``grace`` seconds. Returns
    the names of what went. A reader of a version that goes may fail; ``keep`` and ``grace`` are for it."""
    if keep < 1:
        raise ValueError("one version at least is kept")
    disk, gone = Files(spark, folder), []
    for number in versions(spark, folder)[:-keep]:
        disk.delete(f"versions/{number:012d}.json")
        gone.append(f"versions/{number:012d}.json")
    used = {at.split("/")[0] for number in versions(spark, folder) for at in _version(disk, number).values()}
    before = time.time() * 1000 - grace * 1000
    for name, at in disk.names("data").items():
        if name not in used and at <= before:
            disk.delete(f"data/{name}")
            gone.append(f"data/{name}")
    return gone


def _listed(spark: SparkSession, folder: str, tables: dict[str, str]) -> DataFrame:
    """(name, file, path) of all files of a version's tables."""
    disk, rows = Files(spark, folder), []
    for name, at in tables.items():
        found = disk.disk.listFiles(disk.at(f"data/{at}"), True)
        base = disk.disk.makeQualified(disk.at(f"data/{at}")).toString()
        while found.hasNext():
            path = found.next().getPath()
            if not path.getName().startswith(("_", ".")):
                rows.append((name, path.toString()[len(base) + 1 :], path.toString()))
    return spark.createDataFrame(rows, "name string, file string, path string")


def _copied(rows: DataFrame, source: str, target: str) -> DataFrame:
    """Copy the files that ``rows`` name by the columns ``source`` and ``target``, in chunks; a target that is there stays. Returns (target, copied, sha256) for each, sha256 of the
    bytes that were read."""

    def one(a: str, b: str) -> tuple[bool, str]:
        (fs, path), (to, at) = file_system(a), file_system(b)
        there = to.get_file_info(at).type == pafs.FileType.File
        digest = hashlib.sha256()
        with fs.open_input_stream(path) as read:
            if there:
                while chunk := read.read(CHUNK):
                    digest.update(chunk)
                return False, digest.hexdigest()
            to.create_dir(at.rsplit("/", 1)[0], recursive=True)
            part = f"{at}.{uuid.uuid4().hex}"
            with to.open_output_stream(part) as out:
                while chunk := read.read(CHUNK):
                    digest.update(chunk)
                    out.write(chunk)
        to.move(part, at)
        return True, digest.hexdigest()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [one(x, y) for x, y in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.record_batch([b.column(1), pa.array([c for c, _ in made], pa.bool_()), pa.array([d for _, d in made], pa.string())], names=["target", "copied", "sha256"])

    dealt = rows.select(source, target).repartition(max(1, rows.sparkSession.sparkContext.defaultParallelism))
    return dealt.mapInArrow(work, "target string, copied boolean, sha256 string")


def backup(spark: SparkSession, folder: str, pool: str, number: int | None = None) -> tuple[str, int, int]:
    """Back up one version (None: the last) of a folder. Returns the backup's name, how many files it has, and how many of them were copied because the pool
    lacked them. The backup appears when all its files are in the pool."""
    known = versions(spark, folder)
    if not known:
        raise ValueError("there is no version to back up")
    number = number if number is not None else known[-1]
    name = f"{number:012d}-{uuid.uuid4().hex}"
    found = digests(_listed(spark, folder, _version(Files(spark, folder), number)))
    found.write.parquet(f"{pool}/manifests/{name}")
    files = spark.read.parquet(f"{pool}/manifests/{name}")
    once = files.groupBy("sha256").agg(F.min("path").alias("path"))
    copied = _copied(once.withColumn("blob", _blob(pool)), "path", "blob")
    counted = copied.agg(F.count_if("copied").alias("n"), F.count_if(~F.col("target").endswith(F.col("sha256"))).alias("changed")).first()
    if counted["changed"]:
        raise RuntimeError("files changed while they were copied")
    disk = Files(spark, pool)
    disk.create(f"backups/{name}.json", json.dumps({"version": number, "tables": sorted(_version(Files(spark, folder), number))}))
    return name, files.count(), counted["n"]


def _blob(pool: str):
    return F.concat(F.lit(f"{pool}/blobs/"), F.substring("sha256", 1, 2), F.lit("/"), F.col("sha256"))


def backups(spark: SparkSession, pool: str) -> list[str]:
    """Names of whole backups, oldest first."""
    found = Files(spark, pool).names("backups")
    return [n.removesuffix(".json") for n, _ in sorted(found.items(), key=lambda x: (x[1], x[0])) if n.endswith(".json") and not n.startswith(".")]


def backup_problems(spark: SparkSession, pool: str, name: str) -> DataFrame:
    """(name, file, problem) of a backup's files whose copies are missing or have other bytes; all copies are read."""
    files = spark.read.parquet(f"{pool}/manifests/{name}").select("name", "file", F.col("sha256").alias("want"), F.col("bytes").alias("size"))
    once = files.select("want").distinct().withColumn("sha256", F.col("want")).withColumn("path", _blob(pool)).drop("sha256")
    read = digests(once).select("want", F.when(F.col("sha256").isNull(), "missing").when(F.col("sha256") != F.col("want"), "changed").alias("problem")).filter("problem is not null")
    return files.join(read, "want").select("name", "file", "problem")


def restore(spark: SparkSession, pool: str, name: str, folder: str) -> int:
    """Check a backup, copy it into a folder and publish it as the folder's next version. Returns its number. Nothing changes if a copy is missing or has other bytes."""
    if name not in backups(spark, pool):
        raise ValueError(f"there is no backup {name}")
    bad = backup_problems(spark, pool, name).orderBy("name", "file").first()
    if bad:
        raise ValueError(f"{bad['name']}/{bad['file']}: {bad['problem']}")
    base, own = (versions(spark, folder) or [0])[-1], uuid.uuid4().hex
    files = spark.read.parquet(f"{pool}/manifests/{name}")
    target = F.concat(F.lit(f"{folder}/data/{own}/"), F.col("name"), F.lit("/"), F.col("file"))
    wrong = _copied(files.withColumns({"blob": _blob(pool), "target": target}), "blob", "target").filter(~F.col("copied")).count()
    if wrong:
        raise RuntimeError("files were there before they were restored")
    tables = json.loads(Files(spark, pool).read(f"backups/{name}.json"))["tables"]
    return _named(Files(spark, folder), base, own, {t: f"{own}/{t}" for t in tables})

"""Captures, imports and exports applied whole: functions from a store's record sets to new ones, and their publication.

A store is a dict of record sets as in packages, works with the column ``hidden`` besides, and the names of each work's tags. A set of new tables becomes
visible at once: ``publish`` writes them as the next version of a folder.
"""

from __future__ import annotations

import gzip
import hashlib
import os
import tarfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sources import packages as P
from ..sources.files import Hashed, file_system
from . import extract, merge, packages, publication, queue
from .relational import first_by_key

#: Which work column the rows of a set belong to a work by, and the key of each row.
KEYS = {
    "chapters": ["sourceWorkId", "sourceChapterId"], "workAuthors": ["sourceWorkId", "sourceAuthorId"], "workTags": ["sourceWorkId", "sourceTagId"],
    "seriesWorks": ["sourceSeriesId", "sourceWorkId"], "observations": ["sourceWorkId", "observedAt"], "comments": ["sourceWorkId", "sourceCommentId"],
    "kudos": ["sourceWorkId", "sourceKudoId"], "bookmarks": ["sourceWorkId", "sourceBookmarkId"], "authors": ["sourceAuthorId"], "tags": ["sourceTagId"], "series": ["sourceSeriesId"],
}


TAG_NAMES = "sourceWorkId string, type string, names array<string>"


def empty_store(spark: SparkSession) -> dict[str, DataFrame]:
    sets = {name: spark.createDataFrame([], P.record_schema(name)) for name in P.FILES}
    return sets | {"works": sets["works"].withColumn("hidden", F.lit(False)), "tagNames": spark.createDataFrame([], TAG_NAMES)}


def merge_capture(store: dict[str, DataFrame], sets: dict[str, DataFrame], unhide: bool = True) -> dict[str, DataFrame]:
    """All merges of one capture, or of a package's records, together: works, authors, tags, series, comments and bookmarks
    follow the new rows, chapters lose those that are gone, a work's authors and tags are replaced, series places are added or moved, an
    observation of the same instant has its availability and status overwritten, kudos stay as they were first seen. ``unhide``: whether a hidden work that is seen again is
    shown."""
    seen = sets["works"].withColumn("hidden", F.col("operation") == "hide")
    new = dict(store) | {"works": merge.merge(store["works"], seen, ["sourceWorkId"], {} if unhide else {"hidden": "keep"})}
    for name in ("authors", "tags", "series", "comments", "bookmarks"):
        new[name] = merge.merge(store[name], sets[name], KEYS[name])
    new["chapters"] = merge.reconcile(store["chapters"], sets["chapters"], ["sourceWorkId"], KEYS["chapters"])
    for name in ("workAuthors", "workTags"):
        lowest = sets[name].groupBy(*KEYS[name]).agg(F.min("position").alias("position"))
        new[name] = merge.replace_set(store[name], lowest, ["sourceWorkId"])
    new["seriesWorks"] = merge.merge(store["seriesWorks"], first_by_key(sets["seriesWorks"], KEYS["seriesWorks"], "position"), KEYS["seriesWorks"])
    new["observations"] = merge.merge(store["observations"], sets["observations"], KEYS["observations"], {"availability": "new", "httpStatus": "new"}, default="keep")
    new["kudos"] = merge.first_write(store["kudos"], sets["kudos"], KEYS["kudos"])
    return new


def import_outcomes(works: DataFrame, sets: dict[str, DataFrame]) -> DataFrame:
    """(sourceWorkId, outcome) for each work of a package: skipped (the store has this hash), failed (to be hidden and unknown, without
    chapters, or with authors or tags that the package lacks), hidden, created or updated. works: (sourceWorkId, contentHash) of the store."""
    had = works.select("sourceWorkId", F.col("contentHash").alias("old"), F.lit(True).alias("had"))
    whole = sets["chapters"].select("sourceWorkId").distinct().withColumn("whole", F.lit(True))
    lost = [sets[b].join(sets[e].select(k), k, "left_anti").select("sourceWorkId") for b, e, k in (("workTags", "tags", "sourceTagId"), ("workAuthors", "authors", "sourceAuthorId"))]
    lost = lost[0].unionByName(lost[1]).distinct().withColumn("lost", F.lit(True))
    joined = sets["works"].join(had, "sourceWorkId", "left").join(whole, "sourceWorkId", "left").join(lost, "sourceWorkId", "left")
    told = packages.outcome(F.col("had").isNotNull(), F.col("old").eqNullSafe(F.col("contentHash")), F.col("operation") == "hide")
    broken = told.isin("created", "updated") & (F.col("whole").isNull() | F.col("lost").isNotNull())
    return joined.select("sourceWorkId", F.when(broken, "failed").otherwise(told).alias("outcome"))


def series_problems(works: DataFrame, sets: dict[str, DataFrame], dry_run: bool = False) -> DataFrame:
    """(sourceSeriesId, problem) of a package's series that can't be imported: without works in the package, or, unless it is a dry run, with works that are not in
    ``works`` (sourceWorkId) once the package's have been imported."""
    own = sets["series"].select("sourceSeriesId")
    places = sets["seriesWorks"].select("sourceSeriesId", "sourceWorkId")
    found = own.join(places, "sourceSeriesId", "left_anti").select("sourceSeriesId", F.concat(F.lit("Series "), "sourceSeriesId", F.lit(" has no works in the package")).alias("problem"))
    if dry_run:
        return found
    strange = places.join(own, "sourceSeriesId", "left_semi").join(works.select("sourceWorkId"), "sourceWorkId", "left_anti").groupBy("sourceSeriesId").agg(F.min("sourceWorkId").alias("w"))
    return found.unionByName(strange.select("sourceSeriesId", F.concat(F.lit("Series "), "sourceSeriesId", F.lit(" has a work that was not imported: "), "w").alias("problem")))


def apply_import(store: dict[str, DataFrame], sets: dict[str, DataFrame], runs: DataFrame, package_id: str, previous_id: str | None, now: Column, dry_run: bool = False) -> tuple[dict[str, DataFrame], DataFrame]:
    """Import a package into a store. Returns the store and the runs (package_id, status, works_created, works_updated, works_skipped,
    works_failed, completed_at) with this one.

    A package that was imported whole changes nothing; one whose predecessor was not is an error. Works that fail are
    counted and left out, the others follow the package: status partial or completed. A hidden work stays hidden, whatever comes. A series has the works that the package names and
    no others; the first series, by id, that can't be imported ends the import: it and those after it stay as they were, the status is failed, and the
    problem is in ``error_message``, if runs have that column. A dry run only counts: status verified, or failed.
    """
    spark = runs.sparkSession
    asked = spark.createDataFrame([(package_id, previous_id)], "package_id string, previous_package_id string")
    done = runs.filter("status <> 'completed' or works_failed = 0")
    decision = packages.import_plan(asked, done).first()["decision"]
    if decision == "already_imported":
        return store, runs
    if decision == "missing_predecessor" or previous_id and runs.filter((F.col("package_id") == previous_id) & (F.col("status") == "completed")).isEmpty():
        raise ValueError(f"package {previous_id} comes first and has not been imported")
    outcomes = import_outcomes(store["works"], sets)
    o = F.col("outcome")
    counts = outcomes.agg(
        F.count_if(o == "created").alias("works_created"), F.count_if(o.isin("updated", "hidden")).alias("works_updated"),
        F.count_if(o == "skipped").alias("works_skipped"), F.count_if(o == "failed").alias("works_failed"),
    )
    taken = outcomes.filter(o.isin("created", "updated")).select("sourceWorkId")
    after = store["works"].select("sourceWorkId").unionByName(taken)
    problem = series_problems(after, sets, dry_run).orderBy("sourceSeriesId", "problem").first()
    good = F.lit("verified") if dry_run else F.when(F.col("works_failed") == 0, "completed").otherwise("partial")
    run = counts.withColumns({"package_id": F.lit(package_id), "status": good if problem is None else F.lit("failed"), "completed_at": now, "error_message": F.lit(problem and problem["problem"])})
    kinds = dict(runs.dtypes)
    grown = runs.filter(F.col("package_id") != package_id).unionByName(run.select(*[F.col(c).cast(kinds[c]).alias(c) for c in runs.columns]))
    if dry_run:
        return store, grown
    hidden = outcomes.filter("outcome = 'hidden'").select("sourceWorkId")
    part = {name: df.join(taken, "sourceWorkId", "left_semi") if "sourceWorkId" in df.columns else df for name, df in sets.items()}
    fits = F.lit(True) if problem is None else F.col("sourceSeriesId") < problem["sourceSeriesId"]
    part["series"] = sets["series"].filter(fits)
    part["seriesWorks"] = sets["seriesWorks"].join(part["series"].select("sourceSeriesId"), "sourceSeriesId", "left_semi")
    new = merge_capture(store, part, unhide=False)
    new["seriesWorks"] = merge.replace_set(store["seriesWorks"], first_by_key(part["seriesWorks"], KEYS["seriesWorks"], "position"), ["sourceSeriesId"])
    if "tagNames" in store:
        new["tagNames"] = merge.replace_set(store["tagNames"], packages.tag_names(taken, part["workTags"], sets["tags"]), ["sourceWorkId"])
    # a hidden work keeps its content; only its hash is what the package says
    gone = sets["works"].join(hidden, "sourceWorkId", "left_semi").select("sourceWorkId", F.col("contentHash").alias("__hash"))
    marked = new["works"].join(gone, "sourceWorkId", "left")
    hit = F.col("__hash").isNotNull()
    new["works"] = marked.withColumns({"hidden": F.col("hidden") | hit, "contentHash": F.coalesce("__hash", "contentHash")}).select(store["works"].columns)
    return new, grown


def publish(spark: SparkSession, folder: str, tables: dict[str, DataFrame], base: int | None = None) -> int:
    """Write tables as the next version of a folder; readers find all of them or those before. ``base``: the version that they were made from (None: the last one); if
    another has been published since, it is a ``publication.Conflict``. Returns the new version's number."""
    return publication.publish_version(spark, folder, (publication.versions(spark, folder) or [0])[-1] if base is None else base, tables)


def load_store(spark: SparkSession, folder: str, number: int | None = None) -> dict[str, DataFrame]:
    """The tables of a version (None: the last)."""
    return publication.read_version(spark, folder, number)[1]


def archive(spark: SparkSession, folder: str) -> DataFrame:
    """One row (path, sha256, bytes) of ``folder`` as a tar.gz beside it, the same bytes for the same files: names in order, no owners or times.
    A package holds at most some thousand works; one task streams it file by file."""
    target = f"{folder}.tar.gz"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column(0).to_pylist():
                fs, path = file_system(uri)
                files = sorted((f for f in fs.get_file_info(pafs.FileSelector(path)) if f.is_file and not f.base_name.startswith(".")), key=lambda f: f.base_name)
                part = f"{path}.tar.gz.{uuid.uuid4().hex}"
                with fs.open_output_stream(part) as out:
                    hashed = Hashed(out)
                    with gzip.GzipFile(filename="", mode="wb", fileobj=hashed, mtime=0) as packed, tarfile.open(fileobj=packed, mode="w", format=tarfile.PAX_FORMAT) as tar:
                        for f in files:
                            info = tarfile.TarInfo(f"{os.path.basename(path)}/{f.base_name}")
                            info.size, info.mode = f.size, 0o644
                            with fs.open_input_stream(f.path) as source:
                                tar.addfile(info, source)
                fs.move(part, f"{path}.tar.gz")
                yield pa.record_batch([pa.array([target]), pa.array([hashed.digest.hexdigest()]), pa.array([hashed.size], pa.int64())], names=["path", "sha256", "bytes"])

    return spark.createDataFrame([(folder,)], "folder string").coalesce(1).mapInArrow(work, "path string, sha256 string, bytes long")


def export_changes(
    spark: SparkSession, works: DataFrame, store: dict[str, DataFrame], runs: DataFrame, sources: DataFrame, run_id: int, token: str, folder: str, manifest: dict, maximum: int, now: Column,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Export what has changed in a run's source since it was last exported: choose works, write and verify the package, archive it, remember what was exported.
    The run must be held by ``token``; its lease and its source's end with it. works: (id, source_id, sourceWorkId, content_hash and the export columns). Returns works,
    runs and sources; without changes the run is empty and nothing is written. An error is the caller's to note, by ``queue.finish_export`` with ``error``."""
    run = runs.filter((F.col("id") == run_id) & (F.col("lease_token") == token) & F.col("status").isin("leased", "writing")).select("source_id", "package_id").first()
    if run is None:
        raise ValueError(f"export run {run_id} is not held by this token")
    runs = queue.begin_writing(runs, run_id, token)
    changed = packages.changed_works(works.filter(F.col("source_id") == run["source_id"]), maximum).select("id", "sourceWorkId", "content_hash")
    rows = changed.collect()  # at most 5000 ids
    if not rows:
        return works, *queue.finish_export(runs, sources, run_id, token, now)
    picked = spark.createDataFrame(rows, changed.schema)
    sets = {}
    for name, df in store.items():
        own = df.join(F.broadcast(picked.select("sourceWorkId")), "sourceWorkId", "left_semi") if "sourceWorkId" in df.columns else df
        sets[name] = own.drop("hidden")
    for entity, bridge in (("authors", "workAuthors"), ("tags", "workTags"), ("series", "seriesWorks")):
        key = KEYS[entity][0]
        sets[entity] = store[entity].join(sets[bridge].select(key).distinct(), key, "left_semi")
    P.write_package(spark, folder, manifest, sets)
    P.require(P.read_package(spark, folder)[2])
    made = archive(spark, folder).first()
    ended = queue.finish_export(runs, sources, run_id, token, now, len(rows), made["path"], made["sha256"], made["bytes"])
    return packages.mark_exported(works, picked, run["package_id"], now), *ended


def capture_report(parsed: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """(sourceWorkId, status, bytes, chapters, tags, error) of works that were read, as ``extract.parse_works`` gives them with their ``html``; works of ``asked`` (sourceWorkId) that were
    not fetched have failed."""
    good = F.col("error").isNull()
    read = parsed.select(
        F.col("work_id").alias("sourceWorkId"), F.when(good, "parsed").otherwise("failed").alias("status"), F.octet_length("html").cast("bigint").alias("bytes"),
        F.when(good, F.size("chapters")).alias("chapters"), F.when(good, F.size("tags")).alias("tags"), "error",
    )
    if asked is None:
        return read
    lost = asked.select("sourceWorkId").distinct().join(read.select("sourceWorkId"), "sourceWorkId", "left_anti")
    return read.unionByName(lost.select("sourceWorkId", F.lit("failed").alias("status"), F.lit("was not fetched").alias("error")), allowMissingColumns=True)


def capture_to_package(spark: SparkSession, pages: DataFrame, folder: str, manifest: dict, asked: DataFrame | None = None) -> DataFrame:
    """Read the pages of many works (url, html, captured_at) into one package at ``folder``, without one if none can be read, and the report of each work beside it at
    ``<folder>-report``. Of pages of one work the first by time, then address, counts; of entities that several works name, that of the first work by id. Returns the report."""
    checkpoint_dir(spark)
    found = extract.parse_works(pages).join(pages.select("url", "captured_at", "html").dropDuplicates(["url", "captured_at"]), ["url", "captured_at"], "left")
    parsed = first_by_key(found, ["work_id"], "captured_at", "url").checkpoint()
    capture_report(parsed, asked).write.mode("overwrite").json(f"{folder}-report")
    if not parsed.filter("error is null").isEmpty():
        sets = extract.record_sets(parsed)
        seen = F.date_format(F.col("observedAt").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        P.write_package(spark, folder, manifest, sets | {"observations": sets["observations"].withColumn("observedAt", seen)})
    return spark.read.schema("sourceWorkId string, status string, bytes long, chapters int, tags int, error string").json(f"{folder}-report")


SAMPLE_ORIGIN = "https://archive.example"


def sample_package(spark: SparkSession, folder: str, package_id: str, created_at: str, format_name: str) -> dict[str, int]:
    """Write a package of one small work with everything that a work can have but comments, kudos and bookmarks, and verify it. Returns its counts."""
    work, author, at = "1001", "user:Sample", f"{SAMPLE_ORIGIN}/works/1001"
    body = "<p>A chapter to try an import with.</p>"
    digest = lambda text: f"sha256:{hashlib.sha256(text.encode()).hexdigest()}"
    kinds = [("Rating", "General Audiences"), ("Fandom", "Samples"), ("Freeform", "Short")]
    rows = {
        "authors": [(author, "Sample", f"{SAMPLE_ORIGIN}/users/Sample", False, False)], "workAuthors": [(work, author, 1)],
        "works": [("upsert", work, at, "A Sample", "<p>Made to be imported.</p>", "en", "2024-01-02", "2024-01-02", True, False, 1, 7, "", "", digest(body))],
        "chapters": [(work, "2001", 1, "", "", "", body, "", "2024-01-02", 7, digest(body))],
        "tags": [(f"{kind}:{name}", kind, name, None, f"{SAMPLE_ORIGIN}/tags/{k}") for k, (kind, name) in enumerate(kinds)], "workTags": [(work, f"{kind}:{name}", k) for k, (kind, name) in enumerate(kinds)],
        "series": [("3001", "Samples", f"{SAMPLE_ORIGIN}/series/3001", "", False)], "seriesWorks": [("3001", work, 1)],
        "observations": [(work, created_at, "public", 200, "2024-01-02", digest(body))],
    }
    sets = {name: spark.createDataFrame(rows.get(name, []), P.record_schema(name)) for name in P.FILES}
    manifest = {
        "format": format_name, "formatVersion": 1, "packageId": package_id, "packageType": "snapshot", "source": {"key": "sample", "origin": SAMPLE_ORIGIN}, "createdAt": created_at,
        "collectorVersion": "sample", "previousPackageId": None,
    }
    P.write_package(spark, folder, manifest, sets)
    return verify_package(spark, folder)


def verify_package(spark: SparkSession, folder: str) -> dict[str, int]:
    """Counts of a package's record sets; a problem is an error."""
    manifest, sets, violations = P.read_package(spark, folder)
    P.require(violations)
    return {name: df.count() for name, df in sets.items()}


def walk_pages(starts: DataFrame, pages: DataFrame, most: int | None = None) -> DataFrame:
    """Listings followed from page to page. starts: (sourceWorkId, chain, url), chains numbered in order; pages: (url, html), what was fetched.
    Returns (sourceWorkId, chain, n, url, html): a chain ends at a page that was not fetched or that the work's walk has been at, and a work at ``most``
    pages over all its chains in order. Jumps double with each round, so a chain of n pages takes about log n of them."""
    checkpoint_dir(starts.sparkSession)
    linked = extract.next_page(pages).select("url", "next_url").checkpoint()  # each page is read once
    fetched = linked.select("url").distinct()
    jump = linked.filter("next_url is not null").join(fetched.select(F.col("url").alias("next_url")), "next_url", "left_semi").select("url", F.col("next_url").alias("ahead")).dropDuplicates(["url"]).checkpoint()
    found = starts.select("sourceWorkId", "chain", "url", F.lit(1).alias("n")).join(fetched, "url", "left_semi").checkpoint()
    own, step = ["sourceWorkId", "chain", "url"], 1
    while most is None or step < most:
        # all pages of a chain up to the step are found, so a jump by the step finds as many again; those that were met are a circle
        new = found.join(jump, "url").select("sourceWorkId", "chain", F.col("ahead").alias("url"), (F.col("n") + step).alias("n")).join(found.select(*own), own, "left_anti")
        new = new.groupBy(*own).agg(F.min("n").alias("n")).checkpoint()
        if new.isEmpty():
            break
        found = found.select(new.columns).unionByName(new).checkpoint()
        jump = jump.join(jump.select(F.col("url").alias("ahead"), F.col("ahead").alias("further")), "ahead").select("url", F.col("further").alias("ahead")).checkpoint()
        step *= 2
    place = Window.partitionBy("sourceWorkId").orderBy("chain", "n")
    met = found.withColumn("again", F.row_number().over(Window.partitionBy("sourceWorkId", "url").orderBy("chain", "n")) > 1)
    ended = F.max(F.col("again").cast("int")).over(Window.partitionBy("sourceWorkId", "chain").orderBy("n"))  # a page met before ends its chain
    kept = met.withColumn("ended", ended).filter("ended = 0").withColumn("at", F.row_number().over(place))
    kept = kept if most is None else kept.filter(F.col("at") <= most)
    return kept.join(pages, "url").select("sourceWorkId", "chain", "n", "url", "html")


def social_records(records: DataFrame, keys: list[str]) -> DataFrame:
    """Of records of walked pages (with chain, n and ord) that repeat a key the first met stays."""
    return first_by_key(records, keys, "chain", "n", "ord").drop("chain", "n", "ord")


def put_blobs(pages: DataFrame, root: str, html: str = "html") -> DataFrame:
    """Write each distinct body once, gzipped, under the key of its content; a key that is there stays as it is. Returns
    (body_hash, storage_key, byte_length, compressed_bytes)."""
    once = P.blobs(pages.filter(F.col(html).isNotNull()), html).select("body_hash", "storage_key", "byte_length", "body")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(root)
        for b in batches:
            sizes = []
            for key, body in zip(b.column(1).to_pylist(), b.column(3).to_pylist()):
                data, path = gzip.compress(body.encode(), 9, mtime=0), f"{base}/{key}"
                if fs.get_file_info(path).type == pafs.FileType.NotFound:
                    fs.create_dir(os.path.dirname(path), recursive=True)
                    part = f"{path}.{uuid.uuid4().hex}"
                    with fs.open_output_stream(part) as out:
                        out.write(data)
                    fs.move(part, path)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(sizes, pa.int64())], names=["body_hash", "storage_key", "byte_length", "compressed_bytes"])

    kind = dict(once.dtypes)["byte_length"]
    return once.mapInArrow(work, f"body_hash string, storage_key string, byte_length {kind}, compressed_bytes long")

"""Transfer packages: a manifest, twelve files of JSON lines and their checksums.

Reading checks, in this order: checksums, manifest, rows, references, counts. A problem is a row of a
violations table; ``require`` turns the first into an error. The three social files may be absent.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..operators import integrity
from .files import folder_digests, listing
from .lines import scan_lines

# File names of the record sets and their fields (type, whether null is allowed, rule).
FILES = {
    "authors": "authors.jsonl", "workAuthors": "work-authors.jsonl", "works": "works.jsonl", "chapters": "chapters.jsonl", "tags": "tags.jsonl", "workTags": "work-tags.jsonl",
    "series": "series.jsonl", "seriesWorks": "series-works.jsonl", "observations": "observations.jsonl", "comments": "comments.jsonl", "kudos": "kudos.jsonl", "bookmarks": "bookmarks.jsonl",
}
OPTIONAL = {"comments", "kudos", "bookmarks"}
TAG_TYPES = ("Rating", "ArchiveWarning", "Category", "Fandom", "Relationship", "Character", "Freeform")
AVAILABILITY = ("public", "restricted", "not_found", "unavailable", "unknown")
FIELDS: dict[str, dict[str, str]] = {
    "authors": {"sourceAuthorId": "id", "name": "name", "profileUrl": "url?", "anonymous": "bool", "orphaned": "bool"},
    "workAuthors": {"sourceWorkId": "id", "sourceAuthorId": "id", "position": "int>0"},
    "works": {
        "operation": "operation", "sourceWorkId": "id", "sourceUrl": "url", "title": "filled", "summaryHtml": "text", "languageCode": "filled", "publishedAt": "date?", "updatedAt": "date?",
        "complete": "bool", "restricted": "bool", "expectedChapters": "int>0?", "words": "int>=0?", "notesHtml": "text", "endNotesHtml": "text", "contentHash": "hash",
    },
    "chapters": {
        "sourceWorkId": "id", "sourceChapterId": "id", "position": "int>0", "title": "text", "summaryHtml": "text", "notesHtml": "text", "contentHtml": "filled", "endNotesHtml": "text",
        "publishedAt": "date?", "wordCount": "int>=0?", "contentHash": "hash",
    },
    "tags": {"sourceTagId": "id", "type": "tagtype", "name": "filled", "canonical": "bool?", "sourceUrl": "url?"},
    "workTags": {"sourceWorkId": "id", "sourceTagId": "id", "position": "int>=0"},
    "series": {"sourceSeriesId": "id", "name": "filled", "sourceUrl": "url", "summaryHtml": "text", "complete": "bool?"},
    "seriesWorks": {"sourceSeriesId": "id", "sourceWorkId": "id", "position": "int>0"},
    "observations": {"sourceWorkId": "id", "observedAt": "datetime", "availability": "availability", "httpStatus": "status?", "sourceUpdatedAt": "date?", "contentHash": "hash?"},
    "comments": {
        "operation": "operation", "sourceWorkId": "id", "sourceCommentId": "id", "parentSourceCommentId": "id?", "authorName": "name", "authorProfileUrl": "url?", "postedAt": "name",
        "depth": "int>=0", "fromWorkCreator": "bool", "textHtml": "text", "contentHash": "hash",
    },
    "kudos": {"sourceWorkId": "id", "sourceKudoId": "id", "authorName": "name", "authorProfileUrl": "url?", "observedAt": "datetime"},
    "bookmarks": {
        "operation": "operation", "sourceBookmarkId": "id", "sourceWorkId": "id", "bookmarkerName": "name", "bookmarkerProfileUrl": "url?", "notesHtml": "text", "tags": "names",
        "updatedAt": "name", "contentHash": "hash",
    },
}


def _type(rule: str) -> T.DataType:
    r = rule.rstrip("?")
    return T.BooleanType() if r == "bool" else T.LongType() if r.startswith("int") or r == "status" else T.ArrayType(T.StructType([T.StructField("name", T.StringType())])) if r == "names" else T.StringType()


def record_schema(name: str) -> T.StructType:
    return T.StructType([T.StructField(f, _type(rule)) for f, rule in FIELDS[name].items()])


#: What the raw JSON of a field must look like, so that a number is never read as a text.
def _json_kind(rule: str) -> str:
    r = rule.rstrip("?")
    return "BOOLEAN" if r == "bool" else "BIGINT" if r.startswith("int") or r == "status" else "ARRAY" if r == "names" else "STRING"


def _problem(field: str, rule: str, raw: Column, value: Column) -> Column:
    """The field's problem, or null."""
    r, optional = rule.rstrip("?"), rule.endswith("?")
    kind = F.schema_of_variant(raw)
    absent = raw.isNull()
    is_null = F.coalesce(F.is_variant_null(raw), F.lit(False))
    length = F.length(value)
    bad = {
        "id": (length < 1) | (length > 255), "name": (length < 1) | (length > 255), "filled": length < 1, "text": F.lit(False), "bool": F.lit(False), "names": F.lit(False),
        "url": ~X.is_http_url(value) if r == "url" else None, "hash": ~X.is_content_hash(value) if r == "hash" else None, "date": ~X.is_iso_date(value) if r == "date" else None,
        "datetime": ~X.is_iso_datetime(value) if r == "datetime" else None, "operation": ~value.isin("upsert", "hide"), "tagtype": ~value.isin(*TAG_TYPES), "availability": ~value.isin(*AVAILABILITY),
        "int>0": value <= 0 if r == "int>0" else None, "int>=0": value < 0 if r == "int>=0" else None, "status": (value < 100) | (value > 599) if r == "status" else None,
    }[r]
    message = F.when(absent, "Required").when(is_null, None if optional else "Expected a value, received null").when(~kind.startswith(_json_kind(rule)), F.concat(F.lit("Expected "), F.lit(_json_kind(rule).lower()), F.lit(", received "), F.lower(kind))).when(bad, "Invalid value")
    return F.when(message.isNotNull(), F.concat(F.lit(f"{field}: "), message))


def checked(lines: DataFrame, name: str) -> DataFrame:
    """``lines`` with the record that each ``value`` holds (r) and its problems, an empty array if it has none. Batch or stream."""
    problems = F.array_compact(F.array(*[
        _problem(f, rule, F.try_variant_get("v", f"$.{f}", "variant"), F.col(f"r.{f}")) for f, rule in FIELDS[name].items()
    ]))
    broken = F.array(F.lit("not a JSON object"))
    parsed = lines.withColumns({"v": F.try_parse_json("value"), "r": F.from_json("value", record_schema(name))})
    found = F.when(F.col("v").isNull() | ~F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False)), broken).otherwise(problems)
    return parsed.withColumn("problems", found).drop("v")


def scan_records(spark: SparkSession, path: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Records of a JSON lines file, or of all files that ``path`` names, and their problems (file, line, problem). Files are read in splits."""
    found = checked(scan_lines(spark, path), name)
    return found.filter(F.size("problems") == 0).select("r.*"), found.select("file", "line", F.explode("problems").alias("problem"))


def stream_records(spark: SparkSession, folder: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Records of the JSON lines files that arrive in a folder, and the problems (file, value, problem) of the lines that are none, as streams. Blank
    lines are skipped; no other is lost."""
    lines = spark.readStream.option("lineSep", "\n").text(folder).select(F.col("_metadata.file_name").alias("file"), "value")
    found = checked(lines.filter(F.trim("value", F.lit(" \t\r\x0b\x0c")) != ""), name)
    return found.filter(F.size("problems") == 0).select("r.*"), found.select("file", "value", F.explode("problems").alias("problem"))


def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(name, actual): the SHA-256 of each file of a package, read in chunks."""
    return folder_digests(spark, folder).select("name", F.col("sha256").alias("actual"))


def checksum_violations(spark: SparkSession, folder: str) -> DataFrame:
    """(kind, key): files that are listed and missing, not as listed, or lines that are no checksum."""
    lines = scan_lines(spark, f"{folder}/checksums.sha256")
    listed = lines.select(F.regexp_extract("value", "^([a-f0-9]{64})  ([a-z0-9.-]+)$", 1).alias("digest"), F.regexp_extract("value", "^([a-f0-9]{64})  ([a-z0-9.-]+)$", 2).alias("name"), "value")
    files = file_digests(spark, folder)
    joined = listed.filter("name <> ''").join(files, "name", "left")
    return (
        listed.filter("name = ''").select(F.lit("bad checksum line").alias("kind"), F.col("value").alias("key"))
        .unionByName(joined.filter("actual is null").select(F.lit("missing file").alias("kind"), F.col("name").alias("key")))
        .unionByName(joined.filter("actual <> digest").select(F.lit("checksum mismatch").alias("kind"), F.col("name").alias("key")))
    )


MANIFEST = "format string, formatVersion long, packageId string, packageType string, source struct<key:string,origin:string>, createdAt string, collectorVersion string, previousPackageId string, records map<string,bigint>"


def scan_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("multiLine", True).schema(MANIFEST).json(f"{folder}/manifest.json")


def manifest_violations(manifest: DataFrame, format_name: str | None = None) -> DataFrame:
    """(kind, key); ``format_name``: what the manifest's format must be, if given."""
    rules = {
        "formatVersion": F.col("formatVersion") == 1, "packageId": X.is_uuid("packageId"), "packageType": F.col("packageType").isin("snapshot", "incremental"),
        "source.key": F.length("source.key").between(1, 100), "source.origin": X.is_http_url("source.origin"), "createdAt": X.is_iso_datetime("createdAt"), "collectorVersion": F.length("collectorVersion") > 0,
        "previousPackageId": (F.col("packageType") == "snapshot") == F.col("previousPackageId").isNull(), "records": F.forall(F.map_values("records"), lambda n: n >= 0),
    }
    if format_name is not None:
        rules["format"] = F.col("format") == format_name
    bad = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items()]))
    return manifest.select(F.explode(bad).alias("key")).select(F.lit("manifest").alias("kind"), "key")


def read_package(spark: SparkSession, folder: str, format_name: str | None = None) -> tuple[DataFrame, dict[str, DataFrame], DataFrame]:
    """(manifest, record sets, violations (kind, key) in the order of the checks by ``step``)."""
    manifest = scan_manifest(spark, folder)
    present = listing(spark, folder)
    steps = [checksum_violations(spark, folder), manifest_violations(manifest, format_name)]
    sets, rows = {}, []
    for name, file in FILES.items():
        if file in present:
            sets[name], problems = scan_records(spark, f"{folder}/{file}", name)
            rows.append(problems.select(F.lit("row").alias("kind"), F.concat_ws(": ", F.concat_ws(":", "file", F.col("line").cast("string")), "problem").alias("key")))
        else:
            sets[name] = spark.createDataFrame([], record_schema(name))
            if name not in OPTIONAL:
                rows.append(spark.range(1).select(F.lit("missing file").alias("kind"), F.lit(file).alias("key")))
    for r in rows[1:]:
        rows[0] = rows[0].unionByName(r)
    expected = manifest.select(F.explode("records").alias("name", "n"))
    counts = integrity.count_violations(sets, expected).select(F.lit("count").alias("kind"), F.col("name").alias("key"))
    steps += [rows[0], integrity.identity_violations(sets).unionByName(integrity.reference_violations(sets)), counts]
    found = steps[0].withColumn("step", F.lit(0))
    for k, s in enumerate(steps[1:], 1):
        found = found.unionByName(s.withColumn("step", F.lit(k)))
    return manifest, sets, found


def require(violations: DataFrame) -> None:
    first = violations.orderBy("step", "kind", "key").limit(1).collect()
    if first:
        raise ValueError(f"{first[0]['kind']}: {first[0]['key']}")


def record_lines(df: DataFrame, name: str) -> DataFrame:
    """(value): each record as a line of JSON, fields in the contract's order, nulls written."""
    fields = [F.col(f).cast(_type(rule)).alias(f) for f, rule in FIELDS[name].items()]
    return df.select(X.canonical_json(*fields).alias("value"))


def write_package(spark: SparkSession, folder: str, manifest: dict, sets: dict[str, DataFrame]) -> None:
    """Check references and write a package, its checksums last. A record set is one file, written by one task
    in the order of its first key: packages hold at most some thousand works."""
    require(integrity.identity_violations(sets).unionByName(integrity.reference_violations(sets)).withColumn("step", F.lit(0)))
    fs = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    root = fs.Path(folder)
    disk = root.getFileSystem(conf)
    disk.delete(root, True)
    disk.mkdirs(root)

    def bare(name: str) -> None:
        """Local file systems keep a checksum beside a file; a package's own are in checksums.sha256, and a reader must
        see a file that was changed as it is."""
        disk.delete(fs.Path(root, f".{name}.crc"), False)

    def put(name: str, data: bytes) -> None:
        out = disk.create(fs.Path(root, name), True)
        out.write(bytearray(data))
        out.close()
        bare(name)

    counts = {r["name"]: r["n"] for r in integrity.record_counts(sets).collect()}
    put("manifest.json", (json.dumps(manifest | {"records": {name: counts.get(name, 0) for name in FILES}}, indent=2, ensure_ascii=False) + "\n").encode())
    for name, file in FILES.items():
        df = sets.get(name, spark.createDataFrame([], record_schema(name)))
        part = fs.Path(root, f".{file}")
        record_lines(df.repartition(1).sortWithinPartitions(*[c for c in FIELDS[name] if c in df.columns and c != "tags"]), name).write.mode("overwrite").text(part.toString())
        made = [s.getPath() for s in disk.listStatus(part) if s.getPath().getName().startswith("part-")]
        if made:
            disk.rename(made[0], fs.Path(root, file))
            bare(file)
        else:
            put(file, b"")
        disk.delete(part, True)
    known = {r["name"]: r["actual"] for r in file_digests(spark, folder).collect()}  # 13 rows
    put("checksums.sha256", "".join(f"{known[n]}  {n}\n" for n in ["manifest.json", *FILES.values()]).encode())


def blobs(pages: DataFrame, html: str = "html") -> DataFrame:
    """(body_hash, storage_key, byte_length, body): each distinct body once, under the key of its content."""
    own = pages.select(X.content_hash(html).alias("body_hash"), X.byte_length(html).alias("byte_length"), F.col(html).alias("body"))
    once = own.groupBy("body_hash").agg(F.first("byte_length").alias("byte_length"), F.first("body").alias("body"))
    return once.select("body_hash", X.storage_key("body_hash").alias("storage_key"), "byte_length", "body")


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """(id): trimmed lines that are not empty."""
    return spark.read.text(path).select(F.trim(F.regexp_replace("value", "\r$", "")).alias("id")).filter("id <> ''")


def raw_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(work_id, html): pages saved as ``<id>.html``."""
    return spark.read.text(f"{folder}/*.html", wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.html$", 1).alias("work_id"), F.col("value").alias("html"))


def sse_blocks(event: Column, payload: Column) -> Column:
    """A server-sent event as text."""
    return F.concat(F.lit("event: "), event, F.lit("\ndata: "), payload, F.lit("\n\n"))


def parse_sse(df: DataFrame, column: str = "value") -> DataFrame:
    """(event, data): events of text blocks; payloads that are no JSON are dropped."""
    blocks = df.select(F.explode(F.split(column, "\n\n")).alias("b")).filter("b <> ''")
    return blocks.select(F.regexp_extract("b", r"(?m)^event: ?(.*)$", 1).alias("event"), F.regexp_extract("b", r"(?m)^data: ?(.*)$", 1).alias("data")).filter(F.try_parse_json("data").isNotNull() & (F.col("data") != ""))


def latest_line(df: DataFrame) -> DataFrame:
    """The last line of each file."""
    return df.withColumn("n", F.row_number().over(Window.partitionBy("file").orderBy(F.desc("line")))).filter("n = 1").drop("n")

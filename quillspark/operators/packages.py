"""Incremental exports, their lineage and the reconciliation of packages on import."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_WORKS = 5000

# Tags that works must have, and older names of tags by their type.
REQUIRED_TAGS = {"Rating": "Not Rated", "ArchiveWarning": "Choose Not To Use Archive Warnings", "Fandom": "No Fandom"}
TAG_ALIASES = {"ArchiveWarning": {"Creator Chose Not To Use Archive Warnings": "Choose Not To Use Archive Warnings"}}


def changed_works(works: DataFrame, maximum: int) -> DataFrame:
    """The oldest works whose content differs from what was exported last, or that never were."""
    if not 1 <= maximum <= MAX_WORKS:
        raise ValueError(f"a package holds 1 to {MAX_WORKS} works")
    return works.filter(~F.col("content_hash").eqNullSafe(F.col("last_exported_hash"))).orderBy("id").limit(maximum)


def missing_works(asked: DataFrame, works: DataFrame, key: str = "source_work_id") -> DataFrame:
    return asked.select(key).distinct().join(works, key, "left_anti")


def children_of(selected: DataFrame, sets: dict[str, DataFrame], keys: dict[str, str]) -> dict[str, DataFrame]:
    """Rows of each record set that belong to the selected works; ``keys`` names each set's work column."""
    works = selected.select(F.col("source_work_id").alias("__w"))
    return {name: df.join(works, df[keys[name]] == works["__w"], "left_semi") for name, df in sets.items()}


def mark_exported(works: DataFrame, exported: DataFrame, package_id: str, now: Column) -> DataFrame:
    """Works of a package remember what was exported of them, by which package and when."""
    done = exported.select("id", F.col("content_hash").alias("__hash"))
    joined = works.join(done, "id", "left")
    hit = F.col("__hash").isNotNull()
    return joined.withColumns({
        "last_exported_hash": F.when(hit, F.col("__hash")).otherwise(F.col("last_exported_hash")),
        "last_exported_at": F.when(hit, now).otherwise(F.col("last_exported_at")),
        "last_export_package_id": F.when(hit, F.lit(package_id)).otherwise(F.col("last_export_package_id")),
    }).select(works.columns)


def lineage(runs: DataFrame, source: str = "source_id", order: str = "id", package: str = "package_id") -> DataFrame:
    """Completed runs with sequence_number, previous_package_id and package_type (the first of a source is a snapshot)."""
    w = Window.partitionBy(source).orderBy(order)
    numbered = runs.withColumns({"sequence_number": F.row_number().over(w).cast("bigint"), "previous_package_id": F.lag(package).over(w)})
    return numbered.withColumn("package_type", F.when(F.col("previous_package_id").isNull(), "snapshot").otherwise("incremental"))


def outcome(known: Column, same: Column, hides: Column) -> Column:
    """What becomes of an incoming row: skipped if what is known has its hash, whatever it asks for; failed if it hides what is not known; hidden, updated or created."""
    same = F.coalesce(same, F.lit(False))
    return F.when(known & same, "skipped").when(hides & ~known, "failed").when(hides, "hidden").when(known, "updated").otherwise("created")


def diff(old: DataFrame, new: DataFrame, keys: list[str], digest: str, operation: str | None = None) -> DataFrame:
    """(keys, outcome) for each incoming row, by ``outcome``."""
    o = old.select(*keys, F.col(digest).alias("__old"), F.lit(True).alias("__had"))
    hides = F.col(operation) == "hide" if operation else F.lit(False)
    return new.join(o, keys, "left").select(*keys, outcome(F.col("__had").isNotNull(), F.col("__old").eqNullSafe(F.col(digest)), hides).alias("outcome"))


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    o = F.col("outcome")
    return outcomes.agg(*[F.count_if(o == k).alias(k) for k in ("created", "updated", "skipped", "hidden", "failed")])


def import_plan(package: DataFrame, imported: DataFrame) -> DataFrame:
    """``package`` (package_id, previous_package_id) with ``decision``: already_imported, missing_predecessor or import.
    ``imported``: (package_id, status)."""
    done = imported.filter("status = 'completed'").select("package_id").distinct()
    own = done.select("package_id", F.lit(True).alias("__own"))
    before = done.select(F.col("package_id").alias("previous_package_id"), F.lit(True).alias("__before"))
    joined = package.join(own, "package_id", "left").join(before, "previous_package_id", "left")
    decision = F.when(F.col("__own"), "already_imported").when(F.col("previous_package_id").isNotNull() & F.col("__before").isNull(), "missing_predecessor").otherwise("import")
    return joined.withColumn("decision", decision).drop("__own", "__before")


def tag_names(works: DataFrame, work_tags: DataFrame, tags: DataFrame, work: str = "sourceWorkId", tag: str = "sourceTagId") -> DataFrame:
    """(work, type, names) for each type of tag that a work of ``works`` has or must have: names in order of position, older names replaced, and the default where a required
    type is missing. work_tags: (work, tag, position); tags: (tag, type, name)."""
    older = [F.when((F.col("type") == kind) & (F.col("name") == was), now) for kind, names in TAG_ALIASES.items() for was, now in names.items()]
    own = work_tags.join(works.select(work), work, "left_semi").join(tags.select(tag, "type", "name"), tag)
    held = own.groupBy(work, "type").agg(F.array_sort(F.collect_list(F.struct("position", F.coalesce(*older, F.col("name")).alias("name")))).alias("x")).select(work, "type", F.transform("x", lambda t: t["name"]).alias("names"))
    must = F.explode(F.array(*[F.struct(F.lit(k).alias("type"), F.array(F.lit(v)).alias("names")) for k, v in REQUIRED_TAGS.items()]))
    lacking = works.select(work, must.alias("r")).select(work, "r.*").join(held.select(work, "type"), [work, "type"], "left_anti")
    return held.unionByName(lacking)


def bylines(bridge: DataFrame, authors: DataFrame) -> DataFrame:
    """(source_work_id, byline): display names in order; Anonymous if all authors are."""
    rows = bridge.join(authors, "source_author_id").groupBy("source_work_id").agg(
        F.array_sort(F.collect_list(F.struct("position", "name"))).alias("x"), F.bool_and("anonymous").alias("hidden")
    )
    return rows.select("source_work_id", F.when(F.col("hidden"), "Anonymous").otherwise(F.array_join(F.transform("x", lambda a: a["name"]), ", ")).alias("byline"))

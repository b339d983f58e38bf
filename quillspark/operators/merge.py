"""Keyed merges with a policy for each column, and the merges of captured works.

Tables are immutable: a merge is a function from the old state and new rows to the new state.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import first_by_key, lowest_place

#: new: the new row's value, null too; keep: the old row's; fill: the new value unless null; or an expression of old and new.
Policy = Literal["new", "keep", "fill"]


def merged_columns(old: DataFrame, new: DataFrame, keys: Sequence[str], policy: Mapping[str, Policy | Column] | None = None, default: Policy = "new") -> list[Column]:
    """The columns of ``old`` after a merge, over rows (__o, __n): the structs of both sides' columns, null where a side lacks the key."""
    policy = policy or {}
    only_old, only_new = F.col("__n").isNull(), F.col("__o").isNull()
    columns = []
    for f in old.schema.fields:
        had = F.col(f"__o.{f.name}")
        comes = F.col(f"__n.{f.name}").cast(f.dataType) if f.name in new.columns else F.lit(None).cast(f.dataType)
        rule = "keep" if f.name in keys else policy.get(f.name, default if f.name in new.columns else "keep")
        both = rule if isinstance(rule, Column) else {"new": comes, "keep": had, "fill": F.coalesce(comes, had)}[rule]
        columns.append(F.when(only_old, had).when(only_new, comes).otherwise(both).alias(f.name))
    return columns


def merge(old: DataFrame, new: DataFrame, keys: Sequence[str], policy: Mapping[str, Policy | Column] | None = None, default: Policy = "new") -> DataFrame:
    """Rows of both sides by key; where both have it each column follows its policy. Columns that only one
    side has are null or kept for the other. New keys must be unique."""
    o = old.select(F.struct(*old.columns).alias("__o"), *keys)
    n = new.select(F.struct(*new.columns).alias("__n"), *keys)
    return o.join(n, list(keys), "full").select(*merged_columns(old, new, keys, policy, default))


def replace_set(old: DataFrame, new: DataFrame, owner: Sequence[str]) -> DataFrame:
    """Owners with new rows have only these; the others keep theirs."""
    return old.join(new.select(*owner).distinct(), list(owner), "left_anti").unionByName(new.select(old.columns))


def reconcile(old: DataFrame, new: DataFrame, owner: Sequence[str], keys: Sequence[str], policy: Mapping[str, Policy | Column] | None = None) -> DataFrame:
    """Owners with new rows lose the rows that are not among them; the rest is merged by key."""
    owners = new.select(*owner).distinct()
    stale = old.join(owners, list(owner), "left_semi").join(new.select(*keys).distinct(), list(keys), "left_anti").select(*keys)
    return merge(old.join(stale, list(keys), "left_anti"), new, keys, policy)


def first_write(old: DataFrame, new: DataFrame, keys: Sequence[str], touched: str | None = None) -> DataFrame:
    """What is there stays; only ``touched`` follows the new row."""
    return merge(old, new, keys, {touched: "new"} if touched else {}, default="keep")


def upsert_works(old: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """Content follows the capture; when a work was first seen and what was exported of it stay."""
    seen = new.withColumns({"availability": F.lit("public"), "first_seen_at": now, "last_seen_at": now, "last_successful_capture_at": now})
    kept = {c: "keep" for c in ("id", "first_seen_at", "last_exported_hash", "last_exported_at", "last_export_package_id") if c in old.columns}
    return merge(old, seen, ["source_id", "source_work_id"], kept)


def replace_work_authors(old: DataFrame, new: DataFrame) -> DataFrame:
    """Bridge rows (work, author, position) of the works at hand; an author once, at the lowest place."""
    return replace_set(old, lowest_place(new, ["source_work_id", "source_author_id"], "position"), ["source_work_id"])


def replace_work_tags(old: DataFrame, new: DataFrame) -> DataFrame:
    return replace_set(old, lowest_place(new, ["source_work_id", "source_tag_id"], "position"), ["source_work_id"])


def reconcile_chapters(old: DataFrame, new: DataFrame) -> DataFrame:
    return reconcile(old, new, ["source_work_id"], ["source_work_id", "source_chapter_id"])


def upsert_series_works(old: DataFrame, new: DataFrame) -> DataFrame:
    """Memberships are added or moved, never taken away; of several rows for one work the first counts."""
    return merge(old, first_by_key(new, ["source_series_id", "source_work_id"], "position"), ["source_series_id", "source_work_id"])


def series_collisions(series_works: DataFrame) -> DataFrame:
    """(series, position, n): places that several works claim."""
    return series_works.groupBy("source_series_id", "position").agg(F.count("*").alias("n")).filter("n > 1")


def record_observations(old: DataFrame, new: DataFrame, columns: Sequence[str] = ("content_hash",)) -> DataFrame:
    """Observations are appended; one of the same work and instant only has ``columns`` overwritten."""
    return merge(old, new, ["source_id", "source_work_id", "observed_at"], {c: "new" for c in columns}, default="keep")


def propagate_availability(works: DataFrame, observations: DataFrame) -> DataFrame:
    """Works with the availability of their latest observation; of several of one instant that of highest id, else the last by name."""
    last = observations.groupBy("source_id", "source_work_id").agg(F.max_by("availability", F.struct("observed_at", *(["id"] if "id" in observations.columns else []), "availability")).alias("__now"))
    joined = works.join(last, ["source_id", "source_work_id"], "left")
    return joined.withColumn("availability", F.coalesce("__now", "availability")).drop("__now").select(works.columns)


def upsert_comments(old: DataFrame, new: DataFrame) -> DataFrame:
    kept = {c: "keep" for c in ("first_seen_at",) if c in old.columns}
    return merge(old, new.withColumn("hidden", F.lit(False)), ["source_work_id", "source_comment_id"], kept)


def add_snapshots(old: DataFrame, new: DataFrame) -> DataFrame:
    """Fetches are appended; of fetches of one body at one address the first row stays, with the newest parser version.
    Fetches without a body are all kept."""
    keys = ["source_id", "url_hash", "body_hash"]
    empty = old.filter("body_hash is null").unionByName(new.filter("body_hash is null").select(old.columns))
    fetched = new.filter("body_hash is not null")
    latest = fetched.groupBy(*keys).agg(F.max_by("parser_version", F.struct("fetched_at", "parser_version")).alias("__latest"))
    first = first_by_key(fetched, keys, "fetched_at").join(latest, keys).withColumn("parser_version", F.col("__latest")).drop("__latest")
    return merge(old.filter("body_hash is not null"), first, keys, {"parser_version": "new"}, default="keep").unionByName(empty)


def merge_record_sets(sets: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Record sets of several documents as one; of rows with one key that of the earliest set stays."""
    tagged = [s.withColumn("__set", F.lit(k)) for k, s in enumerate(sets)]
    together = tagged[0]
    for t in tagged[1:]:
        together = together.unionByName(t)
    rest = [c for c in sets[0].columns if c not in keys]
    return first_by_key(together, keys, "__set", *rest).drop("__set")

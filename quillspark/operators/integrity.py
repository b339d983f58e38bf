"""Checks of record sets: unique keys, references, counts, required children. Each gives the violations as rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys of the record sets, and references (child, columns, parent, columns).
IDENTITIES = {
    "authors": ("sourceAuthorId",), "works": ("sourceWorkId",), "chapters": ("sourceWorkId", "sourceChapterId"), "tags": ("sourceTagId",),
    "series": ("sourceSeriesId",), "comments": ("sourceWorkId", "sourceCommentId"), "kudos": ("sourceWorkId", "sourceKudoId"), "bookmarks": ("sourceWorkId", "sourceBookmarkId"),
}
REFERENCES = (
    ("workAuthors", "sourceWorkId", "works"), ("workAuthors", "sourceAuthorId", "authors"), ("chapters", "sourceWorkId", "works"),
    ("workTags", "sourceWorkId", "works"), ("workTags", "sourceTagId", "tags"), ("seriesWorks", "sourceSeriesId", "series"), ("seriesWorks", "sourceWorkId", "works"),
    ("comments", "sourceWorkId", "works"), ("kudos", "sourceWorkId", "works"), ("bookmarks", "sourceWorkId", "works"),
)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _key(columns: tuple[str, ...] | list[str]) -> Column:
    return F.concat_ws("/", *[F.col(c).cast("string") for c in columns])


def duplicates(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """(keys, n): keys that more than one row has."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(child: DataFrame, parent: DataFrame, column: str, parent_column: str | None = None) -> DataFrame:
    """Rows of ``child`` whose reference is in no row of ``parent``; null references are none."""
    keys = parent.select(F.col(parent_column or column).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def childless(parent: DataFrame, child: DataFrame, column: str) -> DataFrame:
    return parent.join(child.select(column).distinct(), column, "left_anti")


def identity_violations(sets: dict[str, DataFrame]) -> DataFrame:
    """(kind, key): keys that repeat within a record set."""
    found = [duplicates(sets[name], keys).select(F.lit(f"duplicate {name}").alias("kind"), _key(keys).alias("key")) for name, keys in IDENTITIES.items() if name in sets]
    return _union(found)


def reference_violations(sets: dict[str, DataFrame]) -> DataFrame:
    """(kind, key): references that lead nowhere, each once."""
    found = [
        orphans(sets[child], sets[parent], column).select(F.lit(f"{child} refers to missing {parent}").alias("kind"), F.col(column).cast("string").alias("key")).distinct()
        for child, column, parent in REFERENCES if child in sets and parent in sets
    ]
    return _union(found)


def record_counts(sets: dict[str, DataFrame]) -> DataFrame:
    """(name, n) of every record set."""
    return _union([df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in sets.items()])


def count_violations(sets: dict[str, DataFrame], expected: DataFrame) -> DataFrame:
    """(name, n, expected): record sets that are not as long as the manifest says; counts it leaves out are zero."""
    joined = record_counts(sets).join(expected.select("name", F.col("n").alias("expected")), "name", "left")
    return joined.withColumn("expected", F.coalesce("expected", F.lit(0))).filter("n <> expected")


def incomplete(sets: dict[str, DataFrame]) -> DataFrame:
    """(kind, key): works without chapters and series without works."""
    works = childless(sets["works"].filter("operation <> 'hide'"), sets["chapters"], "sourceWorkId")
    series = childless(sets["series"], sets["seriesWorks"], "sourceSeriesId")
    return works.select(F.lit("work without chapters").alias("kind"), F.col("sourceWorkId").alias("key")).unionByName(
        series.select(F.lit("series without works").alias("kind"), F.col("sourceSeriesId").alias("key"))
    )

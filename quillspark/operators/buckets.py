"""Tables laid out by hash of their key, and merges that leave the rest of them in place.

A table is a folder of ``bucket=<n>`` folders. A merge rewrites the buckets that the new keys fall into and reads no others; the new rows are broadcast after they have been counted, so
the old rows of these buckets are not shuffled. Beyond the count both sides are joined by a shuffle, over the touched buckets alone. Keys are compared
null-safe; new keys must be unique.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .merge import Policy, merged_columns

#: New rows up to which a merge broadcasts them.
BROADCAST_ROWS = 200_000
BUCKET = "bucket"


def bucket_of(keys: Sequence[str], count: int) -> Column:
    return F.pmod(F.xxhash64(*[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("\0")) for k in keys]), F.lit(count)).cast("int")


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], count: int) -> None:
    """Lay a table out in ``count`` buckets. Each is written by one task: choose the count so that a bucket is a file of some hundred megabytes."""
    if BUCKET in df.columns:
        raise ValueError(f"a column is named {BUCKET}")
    df.withColumn(BUCKET, bucket_of(keys, count)).repartition(count, BUCKET).write.partitionBy(BUCKET).mode("overwrite").parquet(path)


def read_buckets(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of a table of this schema, with their bucket."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(path)


def touched(new: DataFrame, keys: Sequence[str], count: int) -> list[int]:
    """The buckets that new rows fall into, ``count`` numbers at most."""
    return sorted(r[0] for r in new.select(bucket_of(keys, count)).distinct().collect())


def merged_buckets(old: DataFrame, new: DataFrame, keys: Sequence[str], policy: Mapping[str, Policy | Column] | None = None, default: Policy = "new", small: bool = True) -> DataFrame:
    """The rows of touched buckets after the merge. small: whether the new rows are few enough to be broadcast."""
    few = F.broadcast if small else (lambda df: df)
    o = old.select(F.struct(*[f"`{c}`" for c in old.columns]).alias("__o"), *[F.col(f"`{k}`").alias(f"__{i}") for i, k in enumerate(keys)])
    n = new.select(F.struct(*[f"`{c}`" for c in new.columns]).alias("__n"), *[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)])
    same = [F.col(f"__{i}").eqNullSafe(F.col(f"__k{i}")) for i in range(len(keys))]
    kept = o.join(few(n), same, "left").select("__o", "__n")
    # which new keys are there already: one row for each of them at most, found without moving the old rows
    met = o.select(*[f"__{i}" for i in range(len(keys))]).join(few(n.select(*[f"__k{i}" for i in range(len(keys))])), same, "left_semi")
    added = n.join(few(met), same, "left_anti").select(F.lit(None).cast(kept.schema["__o"].dataType).alias("__o"), "__n")
    return kept.unionByName(added).select(*merged_columns(old, new, keys, policy, default))


def merge_buckets(spark: SparkSession, path: str, schema: T.StructType, new: DataFrame, keys: Sequence[str], count: int, policy: Mapping[str, Policy | Column] | None = None, default: Policy = "new") -> list[int]:
    """Merge new rows into a table that ``write_buckets`` has laid out with the same keys and count. Only the touched buckets are read and replaced; returns them. Replacing a bucket is
    the writer's last step, bucket by bucket: one writer at a time, and readers that must see all or nothing go by a published version."""
    rows = new.count()
    if not rows:
        return []
    own = touched(new, keys, count)
    old = read_buckets(spark, path, schema).filter(F.col(BUCKET).isin(own)).drop(BUCKET)
    merged = merged_buckets(old, new, keys, policy, default, rows <= BROADCAST_ROWS).withColumn(BUCKET, bucket_of(keys, count))
    merged.repartition(len(own), BUCKET).write.partitionBy(BUCKET).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return own

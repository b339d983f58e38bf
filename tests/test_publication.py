"""Versions, conflicts, retention, backup and restore, and merges into buckets."""

import os

import pytest
from pyspark.sql import functions as F

from quillspark.operators import buckets, merge, publication

COUNT = 8


def store(spark, *n):
    return {name: spark.range(k).withColumn("t", F.lit(name)) for name, k in zip("ab", n)}


def sizes(spark, folder, number=None):
    return {name: df.count() for name, df in publication.read_version(spark, folder, number)[1].items()}


def test_of_two_writers_one_is_told(spark, tmp_path):
    folder = f"file://{tmp_path}/store"
    assert publication.read_version(spark, folder) == (0, {})
    assert publication.publish_version(spark, folder, 0, store(spark, 3, 1)) == 1
    base, _ = publication.read_version(spark, folder)
    assert publication.publish_version(spark, folder, base, {"a": spark.range(5)}) == 2  # b is that of version 1
    with pytest.raises(publication.Conflict):
        publication.publish_version(spark, folder, base, {"a": spark.range(9)})
    assert sizes(spark, folder) == {"a": 5, "b": 1} and sizes(spark, folder, 1) == {"a": 3, "b": 1}
    # a writer that only learns of the other when it gives its version a name leaves nothing behind
    before = set(os.listdir(tmp_path / "store" / "data"))
    real = publication.versions
    try:
        publication.versions = lambda *a: real(*a)[:1]
        with pytest.raises(publication.Conflict):
            publication.publish_version(spark, folder, base, {"a": spark.range(9)})
    finally:
        publication.versions = real
    assert set(os.listdir(tmp_path / "store" / "data")) == before and not [n for n in os.listdir(tmp_path / "store") if n.startswith(".") and not n.endswith(".crc")]


def test_retention(spark, tmp_path):
    folder = f"file://{tmp_path}/store"
    for k in range(4):
        publication.publish_version(spark, folder, k, store(spark, k, 1) if k != 3 else {"a": spark.range(9)})
    (tmp_path / "store" / "data" / "unfinished").mkdir()
    gone = publication.prune(spark, folder, 1)
    assert gone == [f"versions/{k:012d}.json" for k in (1, 2, 3)]  # the data is younger than the grace
    gone = publication.prune(spark, folder, 1, grace=-60)
    assert len(gone) == 3 and "data/unfinished" in gone  # version 4 still has b of version 3
    assert sizes(spark, folder) == {"a": 9, "b": 1} and publication.versions(spark, folder) == [4]
    with pytest.raises(ValueError):
        publication.prune(spark, folder, 0)


def test_backup_and_restore(spark, tmp_path):
    folder, pool = f"file://{tmp_path}/store", f"file://{tmp_path}/pool"
    with pytest.raises(ValueError):
        publication.backup(spark, folder, pool)
    publication.publish_version(spark, folder, 0, store(spark, 300, 7))
    first, files, copied = publication.backup(spark, folder, pool)
    assert files == copied > 0
    publication.publish_version(spark, folder, 1, {"b": spark.range(5)})
    second, files, again = publication.backup(spark, folder, pool)
    assert again < files and publication.backups(spark, pool) == [first, second]  # a was in the pool
    assert publication.restore(spark, pool, first, folder) == 3
    assert sizes(spark, folder) == {"a": 300, "b": 7} and sizes(spark, folder, 2) == {"a": 300, "b": 5}
    other = f"file://{tmp_path}/other"
    assert publication.restore(spark, pool, second, other) == 1 and sizes(spark, other) == {"a": 300, "b": 5}
    blobs = sorted(p for p in (tmp_path / "pool" / "blobs").rglob("*") if p.is_file() and not p.name.endswith(".crc"))
    blobs[0].write_bytes(blobs[0].read_bytes() + b"x")
    blobs[1].unlink()
    found = {r["problem"] for n in (first, second) for r in publication.backup_problems(spark, pool, n).collect()}
    assert found == {"changed", "missing"}
    bad = next(n for n in (first, second) if publication.backup_problems(spark, pool, n).count())
    with pytest.raises(ValueError, match="changed|missing"):
        publication.restore(spark, pool, bad, folder)
    assert publication.versions(spark, folder) == [1, 2, 3] and sizes(spark, folder) == {"a": 300, "b": 7}
    with pytest.raises(ValueError, match="no backup"):
        publication.restore(spark, pool, "none", folder)


@pytest.mark.parametrize("limit", [200_000, 0])
def test_bucket_merges_equal_whole_merges(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(buckets, "BROADCAST_ROWS", limit)
    old = spark.range(2000).select(F.when(F.col("id") != 7, F.col("id")).alias("k"), (F.col("id") % 3).cast("string").alias("j"), F.lit("old").alias("v"), F.lit("was").alias("kept"))
    new = spark.createDataFrame([(5, "2", "new", "is"), (5, "1", "new", "is"), (None, "1", "new", "is"), (3000, None, "new", "is"), (None, None, None, None)], "k long, j string, v string, kept string")
    path = f"{tmp_path}/t"
    buckets.write_buckets(old, path, ["k", "j"], COUNT)
    policy = {"kept": "keep", "v": F.coalesce(F.col("__n.v"), F.lit("none"))}
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    own = buckets.merge_buckets(spark, path, old.schema, new, ["k", "j"], COUNT, policy)
    found = buckets.read_buckets(spark, path, old.schema)
    rows = {(r["k"], r["j"]): (r["v"], r["kept"]) for r in found.collect()}
    want = {(r["k"], r["j"]): (r["v"], r["kept"]) for r in old.collect()}
    want |= {(5, "2"): ("new", "was"), (None, "1"): ("new", "was"), (5, "1"): ("new", "is"), (3000, None): ("new", "is"), (None, None): (None, None)}
    assert rows == want and found.count() == len(want)
    after = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    still = {p for p in before if int(p.parent.name.split("=")[1]) not in own}
    assert len(own) < COUNT and still and all(after[p] == before[p] for p in still)
    assert buckets.merge_buckets(spark, path, old.schema, new.limit(0), ["k", "j"], COUNT) == []


def test_small_merges_move_no_old_rows(spark, tmp_path):
    old = spark.range(2000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    path = f"{tmp_path}/t"
    buckets.write_buckets(old, path, ["k"], COUNT)
    new = spark.createDataFrame([(5, "a"), (9999, "b")], "k long, v string")
    part = buckets.read_buckets(spark, path, old.schema).filter(F.col("bucket").isin(buckets.touched(new, ["k"], COUNT))).drop("bucket")
    merged = buckets.merged_buckets(part, new, ["k"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan and "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket", "[bucket")
    assert {r["k"]: r["v"] for r in merged.filter("v <> 'x'").collect()} == {5: "a", 9999: "b"}
    with pytest.raises(ValueError):
        buckets.write_buckets(old.withColumn("bucket", F.lit(1)), path, ["k"], COUNT)


def test_merge_policies_are_shared(spark):
    old, new = spark.createDataFrame([(1, "a", "x")], "k long, v string, w string"), spark.createDataFrame([(1, None), (2, "c")], "k long, v string")
    for made in (merge.merge(old, new, ["k"], {"v": "fill"}), buckets.merged_buckets(old, new, ["k"], {"v": "fill"})):
        assert sorted(map(tuple, made.collect())) == [(1, "a", "x"), (2, "c", None)]

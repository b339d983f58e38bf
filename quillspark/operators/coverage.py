"""Which ids of a source are collected, known to be missing, attempted or open."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PENDING = ("queued", "leased", "retryable_failed")
#: Auto-fill stops queueing beyond this many pending tasks for a batch, and tag subscriptions beyond this many.
BATCHES_AHEAD = 2
MAX_TAG_PENDING = 400
#: Ids of a range are looked at in stretches of two to the power of this.
SPAN_BITS = 20


def _numbers(df: DataFrame, column: str, start: int, end: int) -> DataFrame:
    n = F.col(column).cast("string").try_cast("bigint")
    return df.select(n.alias("id")).filter(F.col("id").between(start, end))


def coverage(works: DataFrame, not_found: DataFrame, attempted: DataFrame, start: int, end: int, column: str = "source_work_id") -> DataFrame:
    """One row (total, collected, not_found, attempted, handled, missing) for the ids from start to end.

    ``not_found`` counts rows, the others distinct ids; handled is in any of the three sets. One pass: the sets are tagged,
    reduced to one row an id, then counted.
    """
    tagged = (
        _numbers(works, column, start, end).select("id", F.lit(1).alias("c"), F.lit(0).alias("m"), F.lit(0).alias("t"))
        .unionByName(_numbers(not_found, column, start, end).select("id", F.lit(0).alias("c"), F.lit(1).alias("m"), F.lit(0).alias("t")))
        .unionByName(_numbers(attempted, column, start, end).select("id", F.lit(0).alias("c"), F.lit(0).alias("m"), F.lit(1).alias("t")))
    )
    per = tagged.groupBy("id").agg(F.max("c").alias("c"), F.sum("m").alias("m"), F.max("t").alias("t"))
    total = end - start + 1
    return per.agg(
        F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("collected"), F.coalesce(F.sum("m"), F.lit(0)).cast("bigint").alias("not_found"),
        F.coalesce(F.sum("t"), F.lit(0)).cast("bigint").alias("attempted"), F.count("*").alias("handled"),
    ).select(F.lit(total).cast("bigint").alias("total"), "collected", "not_found", "attempted", "handled", F.greatest(F.lit(0).cast("bigint"), F.lit(total) - F.col("handled")).alias("missing"))


def find_gaps(spark: SparkSession, handled: DataFrame, start: int, end: int, limit: int, column: str = "id") -> DataFrame:
    """The first ``limit`` ids of the range that are not handled; a call looks at no more than ten times
    as many ids, at least ten thousand."""
    last = min(end, start + max(10 * limit, 10_000) - 1)
    known = _numbers(handled, column, start, last).distinct()
    return spark.range(start, last + 1).join(known, "id", "left_anti").orderBy("id").limit(limit)


def next_cursor(gaps: DataFrame, start: int, end: int, limit: int) -> DataFrame:
    """One row (next_cursor): where the next call starts, null if the range is done. A call that its limit stopped goes on
    after the window of ids it was in."""
    window = max(3 * limit, 3000)
    last = min(end, start + max(10 * limit, 10_000) - 1)
    stats = gaps.agg(F.count("*").alias("n"), F.max("id").alias("at"))
    stop = F.when(F.col("n") >= limit, F.least(F.lit(last), F.lit(start) + (F.floor((F.col("at") - start) / window) + 1) * window - 1)).otherwise(F.lit(last))
    return stats.select((stop + 1).alias("c")).select(F.when(F.col("c") <= end, F.col("c")).alias("next_cursor"))


def filter_uncollected(ids: DataFrame, works: DataFrame, not_found: DataFrame, queued: DataFrame, column: str = "id") -> DataFrame:
    """Rows (ord, id) that are neither collected nor known missing nor queued; order and repeats stay."""
    known = works.select(column).unionByName(not_found.select(column)).unionByName(queued.select(column)).distinct()
    return ids.join(known, column, "left_anti")


def _buckets(df: DataFrame, column: str, start: int, end: int) -> DataFrame:
    """(b, first, last): runs of consecutive ids within each stretch of 2 ** SPAN_BITS ids."""
    ids = _numbers(df, column, start, end).distinct().withColumn("b", F.shiftright("id", SPAN_BITS))
    place = F.col("id") - F.row_number().over(Window.partitionBy("b").orderBy("id"))
    return ids.withColumn("run", place).groupBy("b", "run").agg(F.min("id").alias("first"), F.max("id").alias("last")).drop("run")


def _joined(runs: DataFrame, start: int, end: int) -> DataFrame:
    """(first, last): runs that touch across the borders of stretches as one. Only runs at a border, two a stretch at most, are looked at in one place."""
    low, high = F.greatest(F.shiftleft("b", SPAN_BITS), F.lit(start)), F.least(F.shiftleft(F.col("b") + 1, SPAN_BITS) - 1, F.lit(end))
    marked = runs.withColumn("border", (F.col("first") == low) | (F.col("last") == high))
    order = Window.orderBy("first")
    begins = F.coalesce((F.col("first") != F.lag("last").over(order) + 1).cast("int"), F.lit(1))
    chained = marked.filter("border").withColumn("begins", begins).withColumn("chain", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = chained.groupBy("chain").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("chain")
    return marked.filter("not border").select("first", "last").unionByName(whole)


def islands(df: DataFrame, start: int, end: int, column: str = "id") -> DataFrame:
    """(first, last): the ids of a range that ``df`` has, as ranges of consecutive ids. No range of all ids is made."""
    return _joined(_buckets(df, column, start, end), start, end)


def gap_ranges(df: DataFrame, start: int, end: int, column: str = "id") -> DataFrame:
    """(first, last): the ids of a range that ``df`` lacks, as ranges. One row a stretch of 2 ** SPAN_BITS ids is made, and none an id."""
    spark = df.sparkSession
    held = _buckets(df, column, start, end)
    after = F.lead("first").over(Window.partitionBy("b").orderBy("first"))
    high = F.least(F.shiftleft(F.col("b") + 1, SPAN_BITS) - 1, F.lit(end))
    inner = held.select("b", (F.col("last") + 1).alias("first"), F.coalesce(after - 1, high).alias("last"))
    stretches = spark.range(start >> SPAN_BITS, (end >> SPAN_BITS) + 1).select(F.col("id").alias("b")) if end >= start else spark.range(0).select(F.col("id").alias("b"))
    heads = stretches.join(held.groupBy("b").agg(F.min("first").alias("at")), "b", "left").select("b", F.greatest(F.shiftleft("b", SPAN_BITS), F.lit(start)).alias("first"), F.coalesce(F.col("at") - 1, high).alias("last"))
    return _joined(inner.unionByName(heads).filter("first <= last"), start, end)


def first_gaps(gaps: DataFrame, limit: int) -> DataFrame:
    """(id): the first ``limit`` ids of ranges (first, last). As many ranges are looked at, at most."""
    near = gaps.orderBy("first").limit(limit)
    before = F.coalesce(F.sum(F.col("last") - F.col("first") + 1).over(Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    room = near.withColumn("before", before).filter(F.col("before") < limit)
    return room.select(F.explode(F.sequence("first", F.least("last", F.col("first") + limit - F.col("before") - 1))).alias("id"))

"""The tables at hand as the archive's model: works, tasks, jobs, sources, tags, authors, observations, comments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NOW = "1998-01-01 12:00:00"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def sources(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n_nationkey")
    return table(spark, sf, "nation").select(
        n.cast("bigint").alias("id"), F.col("n_name").alias("source_key"), F.lit(10_000).alias("minimum_delay_ms"), F.when(n % 3 != 0, 250).alias("daily_request_budget"), (n % 5 == 0).alias("paused")
    )


def jobs(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        k.alias("id"), F.col("c_nationkey").cast("bigint").alias("source_id"), F.element_at(F.array(*map(F.lit, ("queued", "running", "cancelled", "paused"))), (k % 4 + 1).cast("int")).alias("status"),
        F.when(k % 7 == 0, "queued").otherwise("completed").alias("planning_status"), F.lit("1997-06-01").cast("timestamp_ntz").alias("updated_at"),
        F.lit(None).cast("timestamp_ntz").alias("completed_at"), F.lit(0).cast("bigint").alias("discovered_count"), F.lit(0).cast("bigint").alias("succeeded_count"),
        F.lit(0).cast("bigint").alias("failed_count"), F.lit(0).cast("bigint").alias("skipped_count"),
    )


def tasks(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("o_orderstatus")
    leased = F.col("o_orderkey") % 10 == 3
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("job_id"), F.col("o_orderkey").cast("string").alias("source_work_id"),
        F.when(s == "F", F.when(F.col("o_orderkey") % 6 == 0, "terminal_failed").otherwise("succeeded")).when(leased, "leased").when(s == "O", "queued").otherwise("retryable_failed").alias("status"),
        (F.col("o_orderkey") % 8).cast("int").alias("attempts"), F.col("o_orderdate").alias("available_at"), F.when((s != "F") & leased, F.col("o_orderdate") + F.expr("INTERVAL 120 SECONDS")).alias("lease_expires_at"),
        F.lit(None).cast("string").alias("lease_token"), F.lit(None).cast("string").alias("leased_by"), F.lit(None).cast("string").alias("last_error_code"), F.lit(None).cast("string").alias("last_error_message"),
        F.col("o_orderdate").alias("updated_at"),
    )


def works(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.lit(1).cast("bigint").alias("source_id"), F.col("doc_id").cast("string").alias("source_work_id"), F.col("source").alias("source_key"), F.col("lang").alias("language"),
        F.col("n_chars").alias("words"), F.substring_index("text", "\n", 1).alias("title"), F.concat(F.lit("sha256:"), F.sha2("text", 256)).alias("content_hash"),
    )


def work_tags(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("source_work_id"), F.col("l_partkey").alias("source_tag_id"), F.col("l_linenumber").alias("position"))


def tags(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_partkey").alias("source_tag_id"), F.col("p_type").alias("type"), F.col("p_name").alias("name"))


def work_authors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("source_work_id"), F.col("l_suppkey").alias("source_author_id"), F.col("l_linenumber").alias("position"))


def authors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("source_author_id"), F.col("s_name").alias("name"), (F.col("s_suppkey") % 3 == 0).alias("anonymous"))


def observations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.lit(1).cast("bigint").alias("source_id"), F.col("user_id").cast("string").alias("source_work_id"), F.col("ts").alias("observed_at"),
        F.when(F.col("event_type") == "error", "not_found").otherwise("public").alias("availability"), F.col("event_type"), F.col("value"),
    )


def comments(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("work_id"), F.col("turn").cast("string").alias("comment_id"), F.when(F.col("turn") > 0, (F.col("turn") - 1).cast("string")).alias("parent_id"), "role", "text", "turn"
    )

"""Lines of text files with their numbers, read in splits.

A file of any size is read by many tasks. One pass counts the lines of every split; a split's first line has the number of lines before
it in its file, by a sum over these counts, and the second pass numbers on from there. No row holds a file, and lines are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Splits whose counts (three numbers each) are broadcast at most; beyond, lines are joined to them by a shuffle.
BROADCAST_SPLITS = 2_000_000


def _splits_at_most(files: DataFrame) -> int:
    """A bound on the splits that files are read in, from their number and size alone."""
    smallest = int(str(files.sparkSession._jsparkSession.sessionState().conf().filesOpenCostInBytes()))
    return len(files.inputFiles()) + int(str(files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) // smallest


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): lines of text files, numbered from 1 within their file. A file's last, empty line is none; an empty file has no lines. Compressed
    files are one split each. Files must not change between the passes."""
    files = spark.read.option("lineSep", "\n").text(path)
    lines = files.select(
        F.col("_metadata.file_name").alias("file"), F.xxhash64("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), "value",
    )
    # a split is read in order by one task, so its rows have consecutive numbers; both passes read the same splits
    counted = lines.groupBy("f", "start").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    above = Window.partitionBy("f").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    begins = counted.select("f", "start", (F.coalesce(F.sum("n").over(above), F.lit(0)) - F.col("first") + 1).alias("shift"))
    if _splits_at_most(files) <= BROADCAST_SPLITS:
        begins = F.broadcast(begins)
    return lines.join(begins, ["f", "start"]).select("file", (F.col("at") + F.col("shift")).alias("line"), "value")

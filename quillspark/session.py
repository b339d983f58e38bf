"""A session with the settings that the library's results rest on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def session(name: str = "quillspark", master: str | None = None, **conf: str) -> SparkSession:
    """Times are UTC, casts are strict, plans adapt to the data; ``conf`` adds or overrides settings."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which the driver and all executors share. Only where it is
    unset and the master is local, as in tests on one machine, a temporary folder takes its place."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="quillspark-")
        spark.conf.set("spark.checkpoint.dir", at)
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(at)
    return at.rstrip("/")

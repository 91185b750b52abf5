"""Session for tests, checks and the bench. On a cluster the caller's session is used as is."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from hazeline.sources.stages import ensure_checkpoint_dir


def local_session(name: str, cpus: str | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", cpus.replace("*", "8"))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark

"""Session settings used by the bench and the tests; operators never create a session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "ledgerflow", cpus: int | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call-site capture per column
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark

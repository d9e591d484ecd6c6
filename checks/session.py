"""Local session for tests and benchmarks."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from voltlake.session import build_session


def local_session(cpus: int | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    settings = {
        "spark.master": f"local[{cpus}]",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("voltlake-checks", conf=settings)
    spark.sparkContext.setLogLevel("ERROR")
    return spark

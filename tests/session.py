"""The local session of tests and benchmarks."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from crowdtape.session import SETTINGS


def start(cpus: int | None = None, app: str = "crowdtape-tests") -> SparkSession:
    cpus = cpus or min(8, os.cpu_count() or 1)
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.driver.host": "localhost",
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

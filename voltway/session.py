"""SparkSession defaults for local runs and tests; a cluster brings its own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A UTC, AQE-enabled session on this machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("voltway")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("VOLTWAY_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )

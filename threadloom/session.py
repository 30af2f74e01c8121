"""Session settings. A cluster brings its own master, memory and ``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # building a plan of hundreds of expressions need not look up the caller of each of them
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", memory: str = "8g", **extra: str) -> SparkSession:
    """A session on this machine for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("threadloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

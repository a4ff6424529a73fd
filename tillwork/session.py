"""Session settings."""

from __future__ import annotations


from pyspark.sql import SparkSession


def local_session(cpus: int = 8, memory: str = "8g", app: str = "tillwork") -> SparkSession:
    """A local session for tests and benchmarks, without web page."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # call-site capture costs several JVM calls per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # a session of many reports compiles more stages than the default cache keeps
        .config("spark.sql.codegen.cache.maxEntries", "1000")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark

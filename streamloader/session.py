"""A local session with the settings the library expects, for tests, benchmarks and notebooks."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", memory: str = "8g", app: str = "streamloader") -> SparkSession:
    """Time zone UTC (text timestamps have none), shuffle width for one machine, adaptive execution.

    On a cluster leave `spark.sql.shuffle.partitions` to the size of the data: adaptive execution
    only merges partitions, so it should err on the high side.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )

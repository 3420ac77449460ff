"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# All of these are ordinary settings; a cluster may override every one of them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Call sites for error messages cost a stack walk per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    memory: str = "8g",
    app_name: str = "rollcall",
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
    )
    for key, value in {**DEFAULTS, **(settings or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

"""Session factory with the defaults that the operators are written for."""

import os

from pyspark.sql import SparkSession


def build_session(app: str = "heddle", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and dynamic partition overwrite.

    ``shuffle_partitions`` is only a starting number: adaptive execution
    coalesces small partitions and splits skewed ones.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or os.environ.get("HEDDLE_SHUFFLE_PARTITIONS", 200)),
    } | conf
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

"""Parquet tables under one directory, whatever file system holds it."""

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of the data set at ``sf_dir``; only Spark touches the path."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

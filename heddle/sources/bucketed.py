"""Catalog tables that are bucketed and sorted by key, so that what is grouped by it needs no shuffle and no sort."""

from pyspark.sql import DataFrame, SparkSession

#: Rows of a bucket, about: a task reads a bucket.
BUCKET_ROWS = 5_000_000


def buckets_for(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """A power of two, so that tables of different sizes still join bucket by bucket."""
    return 1 << max(0, -(-rows // bucket_rows) - 1).bit_length()


def save_bucketed(df: DataFrame, name: str, key: str, order: list[str], buckets: int, path: str | None = None) -> DataFrame:
    """``df`` as the table ``name``, in ``buckets`` files by a hash of ``key``, each in the order of ``key`` and ``order``.

    Replaces a table of that name. The rows are dealt to one task for each bucket,
    so a bucket is one file and its order is known to readers. With ``path`` the
    table lies there, else in the warehouse.
    """
    dealt = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key, *order).mode("overwrite")
    (dealt.option("path", path) if path else dealt).saveAsTable(name)
    return bucketed(df.sparkSession, name)


def bucketed(spark: SparkSession, name: str) -> DataFrame:
    """The table ``name``, whose files' order is made use of where each bucket is one file.

    Rows that were appended since make more files: then the order is unknown and
    Spark sorts again, but still shuffles nothing.
    """
    # a setting of the session, as there is none for a single table
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    return spark.table(name)

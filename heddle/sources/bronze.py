"""Raw crawl records: schema, builder, reader and writers."""

import base64
import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heddle.functions.web import last_segment

SCHEMA = "listing_id string, source string, url string, crawl_ts string, http_status int, content_hash string, html_gz_b64 string, fetch_ms double, crawl_kind string"


def gzip_base64(payload: Column) -> Column:
    """Bytes compressed and written in base64; the same bytes give the same text."""

    @F.pandas_udf("string")
    def packed(payloads: pd.Series) -> pd.Series:
        return payloads.map(lambda b: None if b is None else base64.b64encode(gzip.compress(b, mtime=0)).decode())

    return packed(payload)


def bronze_records(pages: DataFrame, source: Column, status: Column, crawl_ts: Column, fetch_ms: Column, crawl_kind: str, url: str = "url", html: str = "html") -> DataFrame:
    """A bronze row for each page: id from the url's last segment, hash and compressed text of the page."""
    raw = F.coalesce(F.col(html), F.lit("")).cast("binary")
    return pages.select(
        F.concat(source, F.lit(":"), last_segment(F.col(url))).alias("listing_id"),
        source.alias("source"),
        F.col(url).alias("url"),
        crawl_ts.alias("crawl_ts"),
        status.cast("int").alias("http_status"),
        F.concat(F.lit("sha256:"), F.sha2(raw, 256)).alias("content_hash"),
        gzip_base64(raw).alias("html_gz_b64"),
        fetch_ms.cast("double").alias("fetch_ms"),
        F.lit(crawl_kind).alias("crawl_kind"),
    )


def read_bronze(spark: SparkSession, root: str, day: str | None = None) -> DataFrame:
    """JSON lines, plain or gzipped, under ``root``, of one ``dt`` or all; the schema is fixed."""
    return spark.read.schema(SCHEMA).option("mode", "PERMISSIVE").json(f"{root}/dt={day}" if day else root)


def bronze_from_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Rows of a column of JSON texts; what isn't JSON becomes a row of nulls."""
    return lines.select(F.from_json(column, SCHEMA).alias("row")).select("row.*")


def write_bronze(records: DataFrame, path: str, records_per_file: int = 20_000, by_day: bool = True) -> None:
    """Gzipped JSON lines in ``dt=`` and ``source=`` folders, files cut at a number of records."""
    writer = records.withColumn("dt", F.substring("crawl_ts", 1, 10)) if by_day else records
    out = writer.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", records_per_file)
    (out.partitionBy("dt", "source") if by_day else out).json(path)


def write_partitioned(df: DataFrame, path: str, *by: str) -> None:
    """Parquet in folders by ``by``, replacing only the partitions that ``df`` has.

    The rebalance hint gives files of the advisory size and splits a partition
    that is large, so one busy folder doesn't land in one task.
    """
    df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_probes(probes: DataFrame, path: str) -> None:
    """Probe records by day."""
    days = probes.withColumn("obs_date", F.col("obs_date").cast("date"))
    write_partitioned(days.withColumn("dt", F.col("obs_date").cast("string")), path, "dt")


def read_probes(spark: SparkSession, path: str) -> DataFrame:
    """(listing_id, obs_date, is_present) of probe records, whose schema is fixed; only these columns are read."""
    return spark.read.schema("listing_id string, obs_date date, is_present boolean").parquet(path)


def write_panel(panel: DataFrame, path: str) -> None:
    """A panel by month: a folder for each listing would hold a few rows."""
    write_partitioned(panel.withColumn("month", F.date_format("obs_date", "yyyy-MM")), path, "month")


def register_views(spark: SparkSession, sf_dir: str, names: list[str]) -> None:
    """Temporary views over tables, for ad-hoc SQL."""
    from heddle.sources.tables import table

    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def layer_path(root: str, layer: str, *parts: str) -> str:
    """root/layer/part/..., without doubled slashes."""
    return "/".join(p.strip("/") if i else p.rstrip("/") for i, p in enumerate((root, layer, *parts)) if p)

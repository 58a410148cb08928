"""Silver tables: listings in folders by province and day, read by a fixed schema."""

from pyspark.sql import DataFrame, SparkSession, functions as F

#: The columns of ``pages.parse_bronze``. Partition columns are strings, whatever their folders look like.
SCHEMA = (
    "listing_id string, source string, url string, crawl_ts string, crawl_date date, title string, asking_rent_vnd long, area_sqm double, bedrooms int, bathrooms int, "
    "property_type string, ward string, address string, district string, latitude double, longitude double, furnishing string, amenities array<string>, description_clean string, "
    "posted_date date, image_count int, content_hash string, is_active boolean, parse_ok boolean, parse_error string, province string, dt string"
)


def read_silver(spark: SparkSession, path: str, first: str | None = None, last: str | None = None, provinces: list[str] | None = None) -> DataFrame:
    """Silver of the days from ``first`` to ``last`` and of ``provinces``, of all where not given.

    Days and provinces are folders, so the others aren't read, and no file is opened
    for its schema. A column that older files lack is null.
    """
    rows = spark.read.schema(SCHEMA).parquet(path)
    if first:
        rows = rows.where(F.col("dt") >= first)
    if last:
        rows = rows.where(F.col("dt") <= last)
    return rows if provinces is None else rows.where(F.col("province").isin(provinces))

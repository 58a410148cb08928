"""The crawl frontier as a table and functions from (state, events) to state."""

import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Consecutive failures after which a URL is gone.
FAILURES = 2
SCHEMA = (
    "url string, source string, first_seen timestamp, last_fetch_ts timestamp, last_status int, content_hash string, "
    "consecutive_failures int, in_panel boolean, gone_date date"
)


def new_urls(found: DataFrame, frontier: DataFrame) -> DataFrame:
    """The rows of ``found(url, source, first_seen)`` not in the frontier, the earliest of each url."""
    first = found.groupBy("url").agg(F.min_by(F.struct("source", "first_seen"), F.struct("first_seen", "source")).alias("first"))
    return first.select("url", "first.*").join(frontier.select("url"), "url", "left_anti")


def add_urls(found: DataFrame, frontier: DataFrame) -> DataFrame:
    """The frontier with new urls added; known ones keep their state."""
    added = new_urls(found, frontier).select(
        "url", "source", "first_seen", F.lit(None).cast("timestamp").alias("last_fetch_ts"), F.lit(None).cast("int").alias("last_status"),
        F.lit(None).cast("string").alias("content_hash"), F.lit(0).alias("consecutive_failures"), F.lit(False).alias("in_panel"), F.lit(None).cast("date").alias("gone_date"),
    )
    return frontier.unionByName(added)


def fetch_outcomes(fetches: DataFrame) -> DataFrame:
    """The state that a log of fetches ``(url, ts, status, ok, content_hash)`` leaves, by url.

    Failures count from the last success on; the second in a row stamps the day,
    and each later one stamps it anew. A column ``before`` of the log, if there is
    one, says how many failures in a row came ahead of it.
    """
    before = F.coalesce("before", F.lit(0)) if "before" in fetches.columns else F.lit(0)
    log = Window.partitionBy("url").orderBy("ts")
    runs = fetches.withColumn("run", F.sum(F.col("ok").cast("int")).over(log.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.withColumn("failures", F.sum((~F.col("ok")).cast("int")).over(Window.partitionBy("url", "run").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)) + F.when(F.col("run") == 0, before).otherwise(0))
    gone = F.when(~F.col("ok") & (F.col("failures") >= FAILURES), F.to_date("ts"))
    return runs.groupBy("url").agg(
        F.max(F.when(F.col("ok"), F.col("ts"))).alias("last_fetch_ts"),
        F.max_by("status", F.when(F.col("ok"), F.col("ts"))).alias("last_status"),
        F.max_by("content_hash", F.when(F.col("ok"), F.col("ts"))).alias("content_hash"),
        F.max_by("failures", "ts").cast("int").alias("consecutive_failures"),
        F.max(gone).alias("gone_date"),
    )


def apply_fetches(frontier: DataFrame, fetches: DataFrame) -> DataFrame:
    """The frontier after a batch of fetches; failures before the batch add to its leading ones, and stamp no day again."""
    before = frontier.where("consecutive_failures > 0").select("url", F.col("consecutive_failures").alias("before"))
    after = fetch_outcomes(fetches.select("url", "ts", "status", "ok", "content_hash").join(before, "url", "left"))
    later = after.select("url", *(F.col(c).alias(f"new_{c}") for c in after.columns if c != "url"))
    joined = frontier.join(later, "url", "left")
    merged = [F.coalesce(f"new_{c}", c).alias(c) for c in ("last_fetch_ts", "last_status", "content_hash", "consecutive_failures", "gone_date")]
    return joined.select("url", "source", "first_seen", *merged[:4], "in_panel", merged[4])


def is_gone(frontier: DataFrame) -> Column:
    return frontier["gone_date"].isNotNull()


def panel_batch(frontier: DataFrame, n: int) -> DataFrame:
    """The ``n`` panel urls longest not fetched, never fetched ones first."""
    return frontier.where("in_panel").orderBy(F.asc_nulls_first("last_fetch_ts"), "url").limit(n)


def discovery_batch(frontier: DataFrame, n: int) -> DataFrame:
    """The ``n`` earliest urls never fetched and not gone."""
    return frontier.where("last_fetch_ts is null and gone_date is null").orderBy("first_seen", "url").limit(n)


def panel_due(frontier: DataFrame) -> DataFrame:
    return frontier.where("in_panel and gone_date is null").select("url")


def freeze_cohort(frontier: DataFrame, n: int, salt: str = "cohort", by: str | None = None) -> DataFrame:
    """``n`` fetched urls, not gone and not in the panel, in an order that a hash fixes.

    With ``by``, ``n`` of each of its values.
    """
    fit = frontier.where("last_fetch_ts is not null and gone_date is null and not in_panel").withColumn("draw", F.sha2(F.concat(F.lit(f"{salt}:"), F.col("url")), 256))
    if by is None:
        return fit.orderBy("draw", "url").limit(n).drop("draw")
    place = F.row_number().over(Window.partitionBy(by).orderBy("draw", "url"))
    return fit.withColumn("place", place).where(F.col("place") <= n).drop("draw", "place")


def two_failures(log: DataFrame, url: str, day: str, ok: str) -> DataFrame:
    """(url, consecutive_failures, gone_date) at the end of a log of one row for each url and day."""
    fetches = log.select(F.col(url).alias("url"), F.col(day).cast("timestamp").alias("ts"), F.lit(None).cast("int").alias("status"), F.col(ok).alias("ok"), F.lit(None).cast("string").alias("content_hash"))
    return fetch_outcomes(fetches).select(F.col("url").alias(url), "consecutive_failures", "gone_date")


def today(value: datetime.date | None = None) -> datetime.date:
    """The given day, else today's in UTC."""
    return value or datetime.datetime.now(datetime.timezone.utc).date()

"""Streams over bronze records: silver rows, daily probe counts, failure streaks."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from heddle.functions.web import classify_probe
from heddle.operators.frontier import FAILURES
from heddle.operators.pages import parse_bronze
from heddle.sources.bronze import SCHEMA


def read_bronze_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """New JSON-lines files under ``path``, plain or gzipped."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", "true").json(path)


def silver_stream(bronze: DataFrame, day: str, out: str, checkpoint: str):
    """Start the parse job as a stream that appends Parquet by province; stateless, exactly once by its checkpoint."""
    parsed = parse_bronze(bronze, day)
    return parsed.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).partitionBy("province", "dt").trigger(availableNow=True).start()


def probe_stream(probes: DataFrame, lateness: str = "2 days") -> DataFrame:
    """(day, source, probes, present) of each day; a day is complete once the watermark has passed it."""
    present, _ = classify_probe(F.col("http_status"), F.col("html"))
    seen = probes.select(F.col("crawl_ts").cast("timestamp").alias("ts"), "source", present.alias("present")).withWatermark("ts", lateness)
    counts = seen.groupBy(F.window("ts", "1 day").alias("day"), "source").agg(F.count("*").alias("probes"), F.count_if("present").alias("present"))
    return counts.select(F.col("day.start").cast("date").alias("day"), "source", "probes", "present")


def failure_streaks(fetches: DataFrame) -> DataFrame:
    """(url, consecutive_failures, gone) after each batch, from a stream of ``(url, ts, ok)``.

    State is one number for each url: failures since the last success.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        failures = state.get[0] if state.exists else 0
        for ok in pd.concat(list(batches)).sort_values("ts")["ok"]:
            failures = 0 if ok else failures + 1
        state.update((failures,))
        yield pd.DataFrame({"url": [key[0]], "consecutive_failures": [failures], "gone": [failures >= FAILURES]})

    rows = fetches.select("url", "ts", "ok").groupBy("url")
    return rows.applyInPandasWithState(step, "url string, consecutive_failures int, gone boolean", "failures int", "update", GroupStateTimeout.NoTimeout)

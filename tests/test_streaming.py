import datetime as dt
import json

from heddle import streaming
from tests.test_pages import PORTAL_C, row

NAMES = ["listing_id", "source", "url", "crawl_ts", "http_status", "content_hash", "html_gz_b64", "fetch_ms", "crawl_kind"]


def test_silver_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i, r in enumerate([row("mogi", PORTAL_C), row("zillow", "x")]):
        (tmp_path / "in" / f"{i}.jsonl").write_text(json.dumps(dict(zip(NAMES, r))))
    out = str(tmp_path / "silver")
    for _ in range(2):
        streaming.silver_stream(streaming.read_bronze_stream(spark, str(tmp_path / "in")), "2026-09-20", out, str(tmp_path / "state")).awaitTermination(120)
    assert sorted(r["parse_ok"] for r in spark.read.parquet(out).collect()) == [False, True]


def test_failure_streaks(spark, tmp_path):
    at = dt.datetime(2026, 9, 1)
    rows = [("a", at, False), ("a", at + dt.timedelta(1), False), ("b", at, False), ("b", at + dt.timedelta(1), True)]
    spark.createDataFrame(rows, "url string, ts timestamp, ok boolean").write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema("url string, ts timestamp, ok boolean").parquet(str(tmp_path / "log"))
    query = streaming.failure_streaks(stream).writeStream.outputMode("update").format("memory").queryName("streaks").option("checkpointLocation", str(tmp_path / "c")).start()
    query.processAllAvailable()
    query.stop()
    assert sorted(tuple(r) for r in spark.table("streaks").collect()) == [("a", 2, True), ("b", 0, False)]


def test_probe_days(spark, tmp_path):
    rows = [("2026-09-01T10:00:00Z", "mogi", 200, "ok"), ("2026-09-01T23:59:59Z", "mogi", 404, ""), ("2026-09-09T00:00:00Z", "mogi", 200, "ok")]
    spark.createDataFrame(rows, "crawl_ts string, source string, http_status int, html string").coalesce(1).write.parquet(str(tmp_path / "p"))
    stream = spark.readStream.schema("crawl_ts string, source string, http_status int, html string").parquet(str(tmp_path / "p"))
    query = streaming.probe_stream(stream).writeStream.outputMode("append").format("memory").queryName("probe_days").option("checkpointLocation", str(tmp_path / "c")).start()
    query.processAllAvailable()
    query.stop()
    assert [tuple(r) for r in spark.table("probe_days").collect()] == [(dt.date(2026, 9, 1), "mogi", 2, 1)]

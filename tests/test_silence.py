import datetime as dt
import random

from heddle.streaming.silence import silence_stream, silences

START = dt.datetime(2026, 9, 1, 12)
SCHEMA = "listing_id string, ts timestamp, present boolean"


def run(spark, tmp_path, batches, name, **options):
    """One start of the stream for each batch, that is a restart between any two; what all of them gave."""
    log, out, state = (str(tmp_path / f"{name}-{part}") for part in ("log", "out", "state"))
    for rows in batches:
        spark.createDataFrame([(k, START + dt.timedelta(days=d), p) for k, d, p in rows], SCHEMA).coalesce(1).write.mode("append").parquet(log)
        stream = silence_stream(spark.readStream.schema(SCHEMA).parquet(log), **options)
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start()
        assert query.awaitTermination(180)
    return sorted(tuple(r) for r in spark.read.schema("listing_id string, last_seen date, gone_date date").parquet(out).collect())


def day(n):
    return START.date() + dt.timedelta(days=n)


def test_silence_makes_gone_without_a_row(spark, tmp_path):
    """a falls silent and returns, b misses one day, c is reported absent; others only move time on."""
    batches = [
        [("a", 0, True), ("b", 0, True), ("c", 0, True), (None, 0, True)],
        [("b", 2, True), ("c", 1, False), ("c", 2, False)],
        [("z", 6, True), ("b", 4, True)],
        [("a", 7, True), ("z", 8, True), ("c", 8, None)],
        [("z", 12, True), ("z", 14, True)],
        [("z", 16, True)],
    ]
    found = run(spark, tmp_path, batches, "plain")
    assert found == [("a", day(0), day(2)), ("a", day(7), day(9)), ("b", day(4), day(6)), ("c", day(0), day(2)), ("z", day(8), day(10))]


def test_order_within_the_lateness_does_not_matter(spark, tmp_path):
    """Drawn sightings, shuffled within the lateness and cut into runs, against the window over all of them."""
    chance = random.Random(5)
    rows = [(f"l{k}", d, True) for k in range(12) for d in range(20) if chance.random() < 0.55]
    rows += [("clock", d, True) for d in range(27)]
    rows.sort(key=lambda r: r[1] + chance.random() * 2.9)
    batches = [rows[i : i + 40] for i in range(0, len(rows), 40)]
    found = run(spark, tmp_path, [*batches, [("clock", 27, True)]], "mixed", lateness="3 days", forget=4)
    seen = spark.createDataFrame([(k, day(d)) for k, d, _ in rows], "listing_id string, day date")
    # the last sighting less the lateness is noon of day 24, so day 23 is the last whole one
    wanted = sorted(tuple(r) for r in silences(seen, day(23)).collect() if r["listing_id"] != "clock")
    assert len(wanted) > 12 and [r for r in found if r[0] != "clock"] == wanted

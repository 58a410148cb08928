import datetime as dt

from heddle.operators import frontier

T = dt.datetime(2026, 9, 1)


def state(spark, *rows):
    base = {"url": "u", "source": "s", "first_seen": T, "last_fetch_ts": None, "last_status": None, "content_hash": None, "consecutive_failures": 0, "in_panel": False, "gone_date": None}
    return spark.createDataFrame([tuple((base | r).values()) for r in rows], frontier.SCHEMA)


def fetches(spark, *rows):
    return spark.createDataFrame(list(rows), "url string, ts timestamp, status int, ok boolean, content_hash string")


def hours(n):
    return T + dt.timedelta(hours=n)


def test_first_insert_wins(spark):
    found = spark.createDataFrame([("a", "s", T), ("b", "s", hours(2)), ("b", "t", hours(1)), ("b", "s", hours(2))], "url string, source string, first_seen timestamp")
    known = state(spark, {"url": "a", "in_panel": True})
    assert [(r["url"], r["source"]) for r in frontier.new_urls(found, known).collect()] == [("b", "t")]
    assert frontier.add_urls(found, known).where("in_panel").count() == 1


def test_two_failures_in_a_row(spark):
    log = fetches(spark, ("a", hours(1), 500, False, None), ("a", hours(30), 500, False, None), ("b", hours(1), 500, False, None), ("b", hours(2), 200, True, "h"), ("b", hours(3), 500, False, None), ("c", hours(1), 404, False, None))
    after = {r["url"]: r for r in frontier.apply_fetches(state(spark, {"url": "a"}, {"url": "b"}, {"url": "c", "consecutive_failures": 1}, {"url": "d"}), log).collect()}
    assert (after["a"]["consecutive_failures"], after["a"]["gone_date"]) == (2, dt.date(2026, 9, 2))
    assert (after["b"]["consecutive_failures"], after["b"]["gone_date"], after["b"]["content_hash"]) == (1, None, "h")
    assert (after["c"]["consecutive_failures"], after["c"]["gone_date"]) == (2, dt.date(2026, 9, 1))
    assert (after["d"]["consecutive_failures"], after["d"]["last_fetch_ts"]) == (0, None)


def test_a_gone_day_outlives_a_success(spark):
    """Only failures of the batch stamp a day: those before it did so in their own."""
    known = {"consecutive_failures": 2, "gone_date": dt.date(2026, 8, 5)}
    log = fetches(spark, ("a", hours(1), 200, True, "h"), ("b", hours(1), 500, False, None), ("c", hours(1), 200, True, "h"), ("c", hours(2), 500, False, None))
    after = {r["url"]: r for r in frontier.apply_fetches(state(spark, *({"url": u} | known for u in "abcd")), log).collect()}
    assert {u: (r["consecutive_failures"], r["gone_date"]) for u, r in after.items()} == {
        "a": (0, dt.date(2026, 8, 5)), "b": (3, dt.date(2026, 9, 1)), "c": (1, dt.date(2026, 8, 5)), "d": (2, dt.date(2026, 8, 5)),
    }


def test_batches_and_cohort(spark):
    rows = [{"url": f"u{i:03}", "last_fetch_ts": hours(i) if i % 2 else None, "in_panel": i % 3 == 0, "first_seen": hours(-i)} for i in range(30)]
    df = state(spark, *rows)
    assert [r["url"] for r in frontier.panel_batch(df, 3).collect()] == ["u000", "u006", "u012"]
    assert [r["url"] for r in frontier.discovery_batch(df, 2).collect()] == ["u028", "u026"]
    cohort = [r["url"] for r in frontier.freeze_cohort(df, 5).collect()]
    assert len(cohort) == 5 and cohort == [r["url"] for r in frontier.freeze_cohort(df.repartition(3), 5).collect()]
    assert frontier.freeze_cohort(df, 2, by="source").count() == 2
    assert frontier.panel_due(df).count() == 10

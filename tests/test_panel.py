import datetime as dt

from heddle.operators import panel

DAYS = [dt.date(2026, 9, 25) + dt.timedelta(days=i) for i in range(5)]


def frame(spark, presence):
    rows = [(k, DAYS[i], c == "T") for k, marks in presence.items() for i, c in enumerate(marks) if c != "."]
    return spark.createDataFrame(rows, "listing_id string, obs_date date, is_present boolean")


def labels(df):
    return {r["listing_id"]: (r["duration_days"], r["event_observed"]) for r in df.collect()}


def test_survival(spark):
    df = frame(spark, {"a": "TTTFF", "b": "TTTTT", "c": "TFTTT", "x": "FF...", "early": "FFTT."})
    found = labels(panel.survival_labels(df, DAYS[-1]))
    assert found == {"a": (3, True), "b": (4, False), "c": (4, False), "early": (-2, True)}
    assert panel.survival_labels(df, DAYS[-1]).filter("not left_truncated").count() == 0


def test_survival_on_the_calendar(spark):
    df = frame(spark, {"a": "TTTFF", "early": "FFTT.", "gap": "TF.F.", "back": "TFFTT", "x": "FF..."})
    assert labels(panel.survival_labels_calendar(df, DAYS[-1])) == {"a": (3, True), "early": (2, False), "gap": (4, False), "back": (4, False)}


def test_clusters_end_with_their_last_member(spark):
    df = frame(spark, {"a": "TFF..", "b": "TTTFF"})
    members = spark.createDataFrame([("a", "a"), ("b", "a")], "listing_id string, canonical_id string")
    found = panel.survival_labels(panel.cluster_panel(df, members), DAYS[-1], "canonical_id").collect()
    assert [(r["canonical_id"], r["duration_days"], r["event_observed"]) for r in found] == [("a", 3, True)]


def test_panel_and_rates(spark):
    seen = spark.createDataFrame([("a", DAYS[0]), ("a", DAYS[0]), ("a", DAYS[2])], "id string, day date")
    made = panel.presence_panel(seen, "id", "day", DAYS[0], DAYS[2])
    assert sorted((r["obs_date"], r["is_present"]) for r in made.collect()) == [(DAYS[0], True), (DAYS[1], False), (DAYS[2], True)]
    assert panel.transient_absences(made, "id").first()["absences"] == 1
    assert panel.presence_panel(seen.limit(0), "id", "day", DAYS[0], DAYS[2]).count() == 0


def test_kaplan_meier_reaches_zero(spark):
    rows = [(1, True), (2, True), (2, False), (3, True)]
    found = panel.kaplan_meier(spark.createDataFrame(rows, "duration_days int, event_observed boolean")).orderBy("duration_days").collect()
    assert [r["survival"] for r in found] == [0.75, 0.5, 0.0]

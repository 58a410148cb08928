"""Panel and survival queries over ``events``: a user is present on days with an event."""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from heddle.operators import evaluation, frontier, panel
from heddle.plans.durable import Scratch
from heddle.sources import table
from heddle.sources.bucketed import buckets_for, save_bucketed
from heddle.streaming.silence import silences


def user_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, obs_date, is_present) over all days between the first and last event."""
    seen = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"))
    lo, hi = seen.agg(F.min("day"), F.max("day")).first()
    return panel.presence_panel(seen, "user_id", "day", lo, hi)


def last_day(spark: SparkSession, sf_dir: str):
    return table(spark, sf_dir, "events").agg(F.max(F.to_date("ts"))).first()[0]


def survival_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.survival_labels(user_panel(spark, sf_dir), last_day(spark, sf_dir), "user_id")


def survival_calendar_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.survival_labels_calendar(user_panel(spark, sf_dir), last_day(spark, sf_dir), "user_id")


def survival_by_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of clusters of users, ten neighbouring ids each."""
    base = user_panel(spark, sf_dir)
    members = base.select("user_id", F.floor(F.col("user_id") / 10).alias("canonical_id")).distinct()
    return panel.survival_labels(panel.cluster_panel(base, members, "user_id"), last_day(spark, sf_dir), "canonical_id")


def survival_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same labels from the panel as a bucketed table: its rows are shuffled once, when they are written."""
    scratch = Scratch(spark, "panel")
    rows = user_panel(spark, sf_dir)
    name = f"panel_{uuid.uuid4().hex}"
    kept = save_bucketed(rows, name, "user_id", ["obs_date"], buckets_for(rows.count()), f"{scratch.root}/{name}")
    return panel.survival_labels(kept, last_day(spark, sf_dir), "user_id")


def panel_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with the day's number of events as price."""
    counts = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("obs_date")).agg(F.count("*").alias("price"))
    base = user_panel(spark, sf_dir).join(counts, ["user_id", "obs_date"], "left").withColumn("price", F.coalesce("price", F.lit(0)))
    return panel.enriched_panel(base, "user_id", "price")


def transient_absences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.transient_absences(user_panel(spark, sf_dir), "user_id")


def survival_event_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    return panel.event_rate(survival_labels(spark, sf_dir).join(segments, "user_id"), "segment")


def kaplan_meier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.kaplan_meier(survival_labels(spark, sf_dir))


def concordance_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well few events, as risk, order the durations."""
    events = table(spark, sf_dir, "events").groupBy("user_id").agg((-F.count("*")).alias("risk"))
    return evaluation.concordance_index(survival_labels(spark, sf_dir).join(events, "user_id"), "duration_days", "event_observed", "risk")


def frontier_two_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absent days as failed fetches."""
    return frontier.two_failures(user_panel(spark, sf_dir), "user_id", "obs_date", "is_present")


def user_silences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of two or more days without an event of a user."""
    seen = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"))
    return silences(seen, last_day(spark, sf_dir), "user_id")


QUERIES = {
    "panel_presence": user_panel, "panel_enriched": panel_enriched, "survival_labels": survival_labels, "survival_bucketed": survival_bucketed, "survival_event_rate": survival_event_rate,
    "survival_calendar_safe": survival_calendar_safe, "survival_by_cluster": survival_by_cluster, "transient_absences": transient_absences, "kaplan_meier": kaplan_meier,
    "concordance_index": concordance_index, "frontier_two_failures": frontier_two_failures, "user_silences": user_silences,
}

_PANEL = """seen AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events),
    days AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS obs_date FROM seen),
    users AS (SELECT DISTINCT user_id FROM seen),
    panel AS (SELECT u.user_id, x.obs_date, s.d IS NOT NULL AS is_present
        FROM users u CROSS JOIN days x LEFT JOIN seen s ON s.user_id = u.user_id AND s.d = x.obs_date)"""
_CENSOR = "(SELECT max(obs_date) FROM panel)"


def _labels(source: str, entity: str) -> str:
    return f"""nxt AS (SELECT *, lead(is_present) OVER (PARTITION BY {entity} ORDER BY obs_date) AS np FROM {source}),
    gone AS (SELECT {entity}, min(obs_date) AS g FROM nxt WHERE NOT is_present AND np = false GROUP BY 1),
    firsts AS (SELECT {entity}, min(obs_date) AS first_seen FROM {source} WHERE is_present GROUP BY 1),
    labels AS (SELECT f.{entity}, first_seen, CAST(coalesce(g, {_CENSOR}) - first_seen AS INTEGER) AS duration_days,
        g IS NOT NULL AS event_observed, true AS left_truncated FROM firsts f LEFT JOIN gone USING ({entity}))"""


_USERS = f"WITH {_PANEL}, {_labels('panel', 'user_id')}"
ORACLE_SQL = {
    "panel_presence": f"WITH {_PANEL} SELECT * FROM panel",
    "panel_enriched": f"""WITH {_PANEL}, n AS (SELECT user_id, CAST(ts AS DATE) AS obs_date, count(*) AS c FROM events GROUP BY ALL),
        p AS (SELECT user_id, obs_date, is_present, coalesce(c, 0) AS price FROM panel LEFT JOIN n USING (user_id, obs_date))
        SELECT user_id, obs_date, is_present, price,
            CAST(obs_date - min(obs_date) FILTER (WHERE is_present) OVER (PARTITION BY user_id) AS INTEGER) AS days_since_first_seen,
            max(obs_date) FILTER (WHERE is_present) OVER (PARTITION BY user_id) AS last_seen,
            coalesce(price <> lag(price) OVER (PARTITION BY user_id ORDER BY obs_date), false) AS price_changed FROM p""",
    "survival_labels": f"{_USERS} SELECT * FROM labels",
    "survival_bucketed": f"{_USERS} SELECT * FROM labels",
    "survival_event_rate": f"""{_USERS} SELECT c_mktsegment AS segment, count(*) AS entities, count(*) FILTER (WHERE event_observed) AS events,
        round(avg(CAST(event_observed AS INT)), 6) AS event_rate FROM labels JOIN customer ON c_custkey = user_id GROUP BY 1""",
    "survival_calendar_safe": f"""WITH {_PANEL}, m AS (SELECT *, max(obs_date) FILTER (WHERE is_present) OVER (PARTITION BY user_id) AS lst,
            min(obs_date) FILTER (WHERE is_present) OVER (PARTITION BY user_id) AS fst FROM panel),
        e AS (SELECT a.user_id, a.fst AS first_seen, min(a.obs_date) FILTER (WHERE NOT a.is_present AND b.is_present = false AND a.obs_date > a.lst) AS g
            FROM m a LEFT JOIN m b ON b.user_id = a.user_id AND b.obs_date = a.obs_date + 1 GROUP BY 1, 2)
        SELECT user_id, first_seen, CAST(coalesce(g, {_CENSOR}) - first_seen AS INTEGER) AS duration_days, g IS NOT NULL AS event_observed, true AS left_truncated
        FROM e WHERE first_seen IS NOT NULL""",
    "survival_by_cluster": f"""WITH {_PANEL}, cl AS (SELECT user_id // 10 AS canonical_id, obs_date, bool_or(is_present) AS is_present FROM panel GROUP BY ALL),
        {_labels('cl', 'canonical_id')} SELECT * FROM labels""",
    "transient_absences": f"""WITH {_PANEL}, t AS (SELECT user_id, NOT is_present AND lag(is_present) OVER w AND lead(is_present) OVER w AS alone
            FROM panel WINDOW w AS (PARTITION BY user_id ORDER BY obs_date))
        SELECT user_id, count(*) FILTER (WHERE alone) AS absences FROM t GROUP BY 1""",
    "kaplan_meier": f"""{_USERS}, c AS (SELECT duration_days, count(*) AS n, count(*) FILTER (WHERE event_observed) AS events FROM labels GROUP BY 1),
        r AS (SELECT *, CAST(sum(n) OVER (ORDER BY duration_days DESC) AS BIGINT) AS at_risk FROM c)
        SELECT duration_days, at_risk, events, round(CASE WHEN max(CAST(events = at_risk AS INT)) OVER (ORDER BY duration_days) = 1 THEN 0.0
            ELSE exp(coalesce(sum(CASE WHEN events < at_risk THEN ln(1 - events / at_risk) END) OVER (ORDER BY duration_days), 0.0)) END, 6) AS survival FROM r""",
    "concordance_index": f"""{_USERS}, s AS (SELECT duration_days AS t, event_observed AS e, -n AS r FROM labels JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) USING (user_id)),
        p AS (SELECT count(*) AS comparable, count(*) FILTER (WHERE a.r > b.r) AS concordant, count(*) FILTER (WHERE a.r = b.r) AS tied FROM s a JOIN s b ON a.e AND a.t < b.t)
        SELECT *, round((concordant + tied / 2) / nullif(comparable, 0), 6) AS c_index FROM p""",
    "frontier_two_failures": f"""WITH {_PANEL}, r AS (SELECT *, sum(CAST(is_present AS INT)) OVER (PARTITION BY user_id ORDER BY obs_date) AS run FROM panel),
        f AS (SELECT *, sum(CAST(NOT is_present AS INT)) OVER (PARTITION BY user_id, run ORDER BY obs_date) AS k FROM r)
        SELECT user_id, CAST(arg_max(k, obs_date) AS INTEGER) AS consecutive_failures, max(obs_date) FILTER (WHERE NOT is_present AND k >= 2) AS gone_date FROM f GROUP BY 1""",
    "user_silences": """WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS last_seen FROM events),
        n AS (SELECT user_id, last_seen, last_seen + 2 AS gone_date, lead(last_seen) OVER (PARTITION BY user_id ORDER BY last_seen) AS back FROM d)
        SELECT user_id, last_seen, gone_date FROM n WHERE CASE WHEN back IS NULL THEN gone_date <= (SELECT max(last_seen) FROM d) ELSE back > gone_date END""",
}

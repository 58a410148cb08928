"""The entity-by-day panel: presence, gaps, survival labels and curves."""

import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from heddle.plans.joins import join_dimension


def presence_panel(seen: DataFrame, entity: str, day: str, first: datetime.date, last: datetime.date) -> DataFrame:
    """(entity, obs_date, is_present) for each entity and each day from ``first`` to ``last``.

    ``seen`` has a row for each sighting. Days come from a sequence on the
    entity's row, so nothing but sightings is shuffled.
    """
    days = seen.groupBy(entity).agg(F.collect_set(day).alias("days"))
    grid = days.select(entity, "days", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("obs_date"))
    return grid.select(entity, "obs_date", F.array_contains("days", F.col("obs_date")).alias("is_present"))


def survival_labels(panel: DataFrame, censor: datetime.date | Column, entity: str = "listing_id") -> DataFrame:
    """(entity, first_seen, duration_days, event_observed, left_truncated) of each entity ever present.

    An entity is gone at its first absence that the next row also shows; its
    duration runs from its first presence to then, or to ``censor``. One sort
    for the look ahead and one aggregation on the same keys: a single shuffle.
    """
    after = Window.partitionBy(entity).orderBy("obs_date")
    twice = ~F.col("is_present") & ~F.coalesce(F.lead("is_present").over(after), F.lit(True))
    ends = panel.withColumn("twice", twice).groupBy(entity).agg(
        F.min(F.when(F.col("is_present"), F.col("obs_date"))).alias("first_seen"), F.min(F.when(F.col("twice"), F.col("obs_date"))).alias("gone_date")
    )
    return _labels(ends, censor, entity)


def survival_labels_calendar(panel: DataFrame, censor: datetime.date | Column, entity: str = "listing_id") -> DataFrame:
    """As ``survival_labels``, but only absences after the first presence count, on adjacent days.

    So durations are never negative and gaps in observation are not absence. An
    entity that is present again later is not gone.
    """
    rows = Window.partitionBy(entity).orderBy("obs_date")
    whole = Window.partitionBy(entity)
    present_day = F.when(F.col("is_present"), F.col("obs_date"))
    marked = panel.select(
        entity, "obs_date", "is_present",
        F.min(present_day).over(whole).alias("first"), F.max(present_day).over(whole).alias("last"),
        F.lead("is_present").over(rows).alias("next"), F.lead("obs_date").over(rows).alias("next_day"),
    )
    twice = ~F.col("is_present") & ~F.coalesce(F.col("next"), F.lit(True)) & (F.datediff("next_day", "obs_date") == 1) & (F.col("obs_date") > F.col("last"))
    ends = marked.groupBy(entity).agg(F.min("first").alias("first_seen"), F.min(F.when(twice, F.col("obs_date"))).alias("gone_date"))
    return _labels(ends, censor, entity)


def _labels(ends: DataFrame, censor: datetime.date | Column, entity: str) -> DataFrame:
    until = censor if isinstance(censor, Column) else F.lit(censor)
    return ends.where("first_seen is not null").select(
        entity,
        "first_seen",
        F.datediff(F.coalesce("gone_date", until), F.col("first_seen")).alias("duration_days"),
        F.col("gone_date").isNotNull().alias("event_observed"),
        F.lit(True).alias("left_truncated"),
    )


def cluster_panel(panel: DataFrame, members: DataFrame, entity: str = "listing_id", cluster: str = "canonical_id") -> DataFrame:
    """(cluster, obs_date, is_present): a cluster is present while any member is.

    Members that are few are sent to the panel's tasks. Labels of this panel make a cluster's event its last member's end. Members
    without a cluster stand for themselves.
    """
    joined = join_dimension(panel, members.select(entity, cluster), entity).withColumn(cluster, F.coalesce(cluster, entity))
    return joined.groupBy(cluster, "obs_date").agg(F.bool_or("is_present").alias("is_present"))


def enriched_panel(panel: DataFrame, entity: str, price: str) -> DataFrame:
    """The panel with days since first seen, the last day seen and whether the price changed since the row before."""
    whole, rows = Window.partitionBy(entity), Window.partitionBy(entity).orderBy("obs_date")
    present_day = F.when(F.col("is_present"), F.col("obs_date"))
    return panel.select(
        "*",
        F.datediff("obs_date", F.min(present_day).over(whole)).alias("days_since_first_seen"),
        F.max(present_day).over(whole).alias("last_seen"),
        F.coalesce(F.col(price) != F.lag(price).over(rows), F.lit(False)).alias("price_changed"),
    )


def transient_absences(panel: DataFrame, entity: str) -> DataFrame:
    """(entity, absences): single absences between two presences."""
    rows = Window.partitionBy(entity).orderBy("obs_date")
    alone = ~F.col("is_present") & F.lag("is_present").over(rows) & F.lead("is_present").over(rows)
    return panel.select(entity, alone.alias("alone")).groupBy(entity).agg(F.count_if("alone").alias("absences"))


def event_rate(labels: DataFrame, *by: str) -> DataFrame:
    """Entities, events and their share, by the given columns."""
    return labels.groupBy(*by).agg(
        F.count("*").alias("entities"), F.count_if("event_observed").alias("events"), F.round(F.avg(F.col("event_observed").cast("int")), 6).alias("event_rate")
    )


def kaplan_meier(labels: DataFrame) -> DataFrame:
    """(duration_days, at_risk, events, survival): the product-limit curve.

    Durations are counted first, so the running sums see a row for each distinct
    duration only.
    """
    counts = labels.groupBy("duration_days").agg(F.count("*").alias("n"), F.count_if("event_observed").alias("events"))
    up, down = Window.orderBy("duration_days"), Window.orderBy(F.desc("duration_days"))
    counts = counts.withColumn("at_risk", F.sum("n").over(down))
    alive = F.when(F.col("events") < F.col("at_risk"), F.log(1 - F.col("events") / F.col("at_risk")))
    dead = F.max((F.col("events") == F.col("at_risk")).cast("int")).over(up) == 1
    survival = F.when(dead, 0.0).otherwise(F.exp(F.coalesce(F.sum(alive).over(up), F.lit(0.0))))
    return counts.select("duration_days", "at_risk", "events", F.round(survival, 6).alias("survival"))

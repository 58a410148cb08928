"""Splits, baselines, errors, price gaps, rankings and recommendations."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from heddle.plans import ranks
from heddle.plans.durable import Scratch
from heddle.plans.joins import sent_if_small


def temporal_split(df: DataFrame, day: str, cutoff: str, cluster: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test) before and from ``cutoff`` on.

    With ``cluster``, test rows whose cluster has a row in train are left out.
    """
    train, test = df.where(F.col(day) < F.lit(cutoff)), df.where(F.col(day) >= F.lit(cutoff))
    if cluster:
        test = test.join(train.select(cluster).distinct(), cluster, "left_anti")
    return train, test


def median_baseline(df: DataFrame, by: str, area: str, price: str, train: DataFrame | None = None) -> DataFrame:
    """``df`` with ``predicted``: the exact median price per area of its group, in ``df`` or in ``train``, times the area."""
    rates = (df if train is None else train).withColumn("_rate", F.try_divide(F.col(price), F.col(area)))
    found = ranks.quantile_bounds(rates, "_rate", [0.5], by).select(by, F.col("bounds")[0].alias("_median"))
    return df.join(sent_if_small(found), by).withColumn("predicted", F.col("_median") * F.col(area)).drop("_median")


def errors(df: DataFrame, actual: str, predicted: str, *by: str) -> DataFrame:
    """Rows, MAPE, RMSE and R² by group; rows without an actual value above zero are left out."""
    a, p = F.col(actual), F.col(predicted)
    used = df.where((a > 0) & p.isNotNull())
    spread = F.var_pop(a)
    return used.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.round(F.avg(F.abs(a - p) / a), 6).alias("mape"),
        F.round(F.sqrt(F.avg((a - p) * (a - p))), 4).alias("rmse"),
        F.round(F.when(spread > 0, 1 - F.avg((a - p) * (a - p)) / spread), 6).alias("r2"),
    )


def price_gap(asking: Column, fair: Column) -> Column:
    """(asking - fair) / fair, null where the fair price is null or zero."""
    return F.try_divide(asking - fair, fair)


def bargains(df: DataFrame, gap: str, key: str, n: int = 100) -> DataFrame:
    """The ``n`` rows with the most negative gaps, ties by key."""
    return df.where(F.col(gap) < 0).orderBy(gap, key).limit(n)


def quantile_groups(df: DataFrame, value: str, groups: int = 10, by: str | None = None) -> DataFrame:
    """``df`` with ``quantile`` 1 to ``groups`` by ``value``; null without a value.

    Bounds are exact quantiles, joined back: no task sees all values. Equal
    values are in one group; for groups of equal size see ``ranks.ntile``.
    """
    df = Scratch(df.sparkSession, "quantiles").keep(df, "rows")  # read three times
    bounds = ranks.quantile_bounds(df, value, [i / groups for i in range(1, groups)], by)
    joined = df.join(sent_if_small(bounds), by) if by else df.join(F.broadcast(bounds))
    place = F.lit(1)
    for i in range(groups - 1):
        place = place + F.coalesce((F.get("bounds", F.lit(i)) < F.col(value)).cast("int"), F.lit(0))
    place = F.when(F.col(value).isNotNull(), place)
    return joined.withColumn("quantile", place).drop("bounds")


#: Distinct risks in a range: rows that a task orders at once.
RISKS_IN_RANGE = 4096


def concordance_index(df: DataFrame, duration: str, event: str, risk: str, in_range: int = RISKS_IN_RANGE) -> DataFrame:
    """One row: comparable pairs, concordant ones, ties and the C-index.

    A pair is comparable if the shorter duration ended in an event. Rows without a
    duration or a risk take no part; a null event is none.

    Pairs are never built. Distinct durations are numbered, and a pair's durations
    part at one binary digit of their numbers: above it they agree, there the
    shorter has 0 and the longer 1. So each row is counted once for each digit,
    n log n rows in all, in the node of the digits above; rows of a node that agree
    in risk collapse before they are shuffled. Within a node, numbered risks are cut
    into ranges; what lies below a row is what the ranges before it hold, a running
    sum over one row for each, and what its own range holds before it.
    """
    scratch = Scratch(df.sparkSession, "concordance")
    rows = df.select(F.col(duration).alias("t"), F.col(risk).alias("r"), F.coalesce(F.col(event), F.lit(False)).alias("event")).where("t is not null and r is not null")
    counts = scratch.keep(rows.groupBy("t", "r").agg(F.count("*").alias("n"), F.count_if("event").alias("e")), "counts")
    times = ranks.numbered(counts.select("t").distinct(), ["t"], "time")
    risks = ranks.numbered(counts.select("r").distinct(), ["r"], "place")
    placed = counts.join(sent_if_small(times), "t").join(sent_if_small(risks), "r")
    digits = (counts.agg(F.count_distinct("t")).first()[0] - 1).bit_length() if counts.take(1) else 0
    levels = F.explode(F.array(*(F.lit(d) for d in range(digits))).cast("array<int>"))
    dealt = placed.select("time", "place", "n", "e", levels.alias("digit"))
    # a row of the lower half counts by its events, one of the upper half by its rows
    upper = F.expr("shiftright(time, digit) & 1") == 1
    node = F.expr("shiftright(time, digit + 1)")
    sides = dealt.where(upper | (F.col("e") > 0)).groupBy("digit", node.alias("node"), "place")
    sides = sides.agg(F.sum(F.when(upper, 0).otherwise(F.col("e"))).alias("e"), F.sum(F.when(upper, F.col("n")).otherwise(0)).alias("n"))
    sides = scratch.keep(sides.withColumn("part", F.floor(F.col("place") / in_range)), "sides")
    totals = sides.groupBy("digit", "node", "part").agg(F.sum("n").alias("n"))
    over = Window.partitionBy("digit", "node")
    before = F.coalesce(F.sum("n").over(over.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    told = totals.select("digit", "node", "part", before.alias("before"), F.sum("n").over(over).alias("later"))
    inside = F.sum("n").over(Window.partitionBy("digit", "node", "part").orderBy("place")) - F.col("n")
    sums = sides.withColumn("inside", inside).where("e > 0").join(told, ["digit", "node", "part"])
    pairs = sums.agg(
        F.coalesce(F.sum(F.col("e") * F.col("later")), F.lit(0)).alias("comparable"),
        F.coalesce(F.sum(F.col("e") * (F.col("before") + F.col("inside"))), F.lit(0)).alias("concordant"),
        F.coalesce(F.sum(F.col("e") * F.col("n")), F.lit(0)).alias("tied"),
    )
    return pairs.withColumn("c_index", F.round(F.try_divide(F.col("concordant") + F.col("tied") / 2, F.col("comparable")), 6))


def pick_optimal(curve: DataFrame, horizon_days: int, *by: str) -> DataFrame:
    """The rent with the most revenue, rent * (horizon - days) / 30, of each curve; ties to the lower rent."""
    revenue = F.col("rent") * (F.lit(horizon_days) - F.col("expected_days")) / 30
    best = F.max_by(F.struct("rent", "expected_days", revenue.alias("revenue")), F.struct(revenue, -F.col("rent"))).alias("best")
    return curve.groupBy(*by).agg(best).select(*by, "best.*")


def missing_shares(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """The share of nulls of each column, by group."""
    return df.groupBy(by).agg(F.count("*").alias("rows"), *(F.round(F.count_if(F.col(c).isNull()) / F.count("*"), 6).alias(f"null_{c}") for c in columns))


def gap_quartiles(df: DataFrame, gap: str) -> DataFrame:
    """``df`` with ``gap_quartile`` by rank, ties by value order only within a window of the whole table's quantiles."""
    return quantile_groups(df, gap, 4).withColumnRenamed("quantile", "gap_quartile")


def latest(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")

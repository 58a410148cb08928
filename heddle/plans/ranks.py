"""Exact ranks of a whole table without a task that sees all of it.

For running numbers and groups of equal size, rows are dealt to ranges of the
value; counts of the ranges, a row for each, say how many rows lie before one, and
ranks inside a range come from a window over it. Quantiles need no order of all
rows: a sketch narrows them down first.
"""

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from heddle.plans.durable import Scratch
from heddle.plans.joins import sent_if_small


def _dealt(df: DataFrame, keys: list[str], order: list, scratch: Scratch, weight: Column | None = None) -> DataFrame:
    """``df`` with ``before``, the rows of its key in earlier ranges, ``whole``, those of its key, and ``part``.

    With ``weight`` a row counts as so many.
    """
    rows = scratch.keep(df.repartitionByRange(*keys, *order).withColumn("part", F.spark_partition_id()), "ranges")
    totals = rows.groupBy(*keys, "part").agg((F.count("*") if weight is None else F.sum(weight)).alias("here"))
    one = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    earlier = F.sum("here").over(one.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select(*keys, "part", F.coalesce(earlier, F.lit(0)).alias("before"), F.sum("here").over(one).alias("whole"))
    on = F.lit(True)
    told = totals.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("part").alias("_part"), "before", "whole")
    for name in (*keys, "part"):
        on = on & rows[name].eqNullSafe(told[f"_{name}"])
    return rows.join(told, on).drop(*(f"_{k}" for k in keys), "_part")


def quantile_bounds(df: DataFrame, value: str, shares: list[float], by: str | None = None, accuracy: int = 10_000) -> DataFrame:
    """(by, bounds): the quantiles of ``value`` at ``shares``, interpolated between the two nearest rows.

    Nulls don't count. Without ``by`` there is one row, of nulls if there are no
    values. Exact: a sketch gives a narrow interval that must hold each quantile,
    and one more pass counts the rows between intervals and, by value, those
    inside, so only some ``6 / accuracy`` of the values are ordered for each share,
    in ranges of which a task orders one.
    """
    keys = [by] if by else []
    some = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("value"))
    low, high = [max(0.0, s - 3 / accuracy) for s in shares], [min(1.0, s + 3 / accuracy) for s in shares]
    sketch = some.groupBy(*keys).agg(F.percentile_approx("value", [*low, *high], accuracy).alias("cuts"), F.count("*").alias("whole"))
    scratch = Scratch(df.sparkSession, "quantiles")
    sketch = scratch.keep(sketch, "sketch")
    names = [f"_cut{j}" for j in range(2 * len(shares))]
    told = sketch.select(*(F.col(k).alias(f"_{k}") for k in keys), *(F.get("cuts", F.lit(j)).alias(name) for j, name in enumerate(names)))
    joined = some.join(sent_if_small(told), some[by].eqNullSafe(told[f"_{by}"])) if by else some.join(F.broadcast(told))
    value = F.col("value")
    inside = reduce(or_, (value.between(F.col(low), F.col(high)) for low, high in zip(names, names[len(shares) :])))
    # rows outside of the intervals are one count between two cuts, ahead of the values at the cut behind
    place = reduce(add, ((F.col(name) < value).cast("int") for name in names))
    counts = joined.select(*keys, place.alias("place"), F.when(inside, value).alias("value")).groupBy(*keys, "place", "value").agg(F.count("*").alias("n"))
    # the intervals' values are dealt to ranges too, whose counts say how many rows lie before one
    rows = _dealt(counts, keys, ["place", F.asc_nulls_first("value")], scratch, F.col("n"))
    end = F.col("before") + F.sum("n").over(Window.partitionBy(*keys, "part").orderBy("place", F.asc_nulls_first("value")).rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.select(*keys, "value", end.alias("end"), (end - F.col("n")).alias("begin"), "whole")

    def at(rank):
        return F.max(F.when((F.col("begin") <= rank) & (rank < F.col("end")), F.col("value")))

    ranks = [F.lit(share) * (F.col("whole") - 1) for share in shares]
    found = rows.groupBy(*keys).agg(
        *(at(F.floor(r)).alias(f"low{i}") for i, r in enumerate(ranks)), *(at(F.ceil(r)).alias(f"high{i}") for i, r in enumerate(ranks)), F.max("whole").alias("whole")
    )
    missed = F.raise_error(F.lit("quantile_bounds: the sketch's interval misses a quantile")).cast("double")

    def bound(i: int, r):
        between = F.col(f"low{i}") + (F.col(f"high{i}") - F.col(f"low{i}")) * (r - F.floor(r))
        return F.when(F.col("whole").isNotNull() & between.isNull(), missed).otherwise(between.cast("double"))

    return found.select(*keys, F.array(*(bound(i, r) for i, r in enumerate(ranks))).alias("bounds"))


def ntile(df: DataFrame, groups: int, order: list[str], by: str | None = None, name: str = "tile") -> DataFrame:
    """``df`` with groups 1 to ``groups`` of equal size, the first ones a row larger, in the order of ``order``."""
    scratch, keys = Scratch(df.sparkSession, "ntile"), [by] if by else []
    rows = _dealt(df, keys, order, scratch)
    place = F.col("before") + F.row_number().over(Window.partitionBy(*keys, "part").orderBy(*order)) - 1
    least, more = F.floor(F.col("whole") / groups), F.col("whole") % groups
    tile = F.when(place < more * (least + 1), F.floor(place / (least + 1))).otherwise(more + F.floor((place - more * (least + 1)) / F.greatest(least, F.lit(1))))
    return rows.withColumn(name, (tile + 1).cast("int")).drop("part", "before", "whole")


def numbered(df: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """``df`` with a running number from 0 in the order of ``order``."""
    rows = _dealt(df, [], order, Scratch(df.sparkSession, "numbered"))
    place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return rows.withColumn(name, place.cast("long")).drop("part", "before", "whole")

"""Distributions as mergeable sketches: stored once for each day and source, merged over any span.

A profile row holds exact counts and extremes, and a sketch for each question that
needs all values: quantiles (KLL), distinct values (HyperLogLog) and frequent
values. Sketches of parts merge into that of the whole within the same error, so a
month is answered from its days' rows and no listing is read again.
"""

from pyspark.sql import Column, DataFrame, functions as F

#: Sizes of the sketches: KLL's k, HyperLogLog's bits, and frequent values tracked.
KLL_K = 1024
HLL_BITS = 14
TRACKED = 1000


def rank_error(k: int = KLL_K) -> float:
    """The share of rows by which a quantile's rank may be off, with a confidence of 99 percent."""
    return 2.296 / k**0.9021


def distinct_error(bits: int = HLL_BITS) -> float:
    """The share by which a number of distinct values may be off: three standard errors."""
    return 3 * 1.04 / 2 ** (bits / 2)


def profile(df: DataFrame, by: list[str], numbers: list[str], words: list[str]) -> DataFrame:
    """A row for each group: ``rows`` and, for each column, ``nulls_``, and the sketches and extremes of what isn't null.

    Numbers get ``least_``, ``most_`` and ``kll_``; words ``hll_`` and ``top_``. A
    group without any value of a column has nulls there. All aggregates combine on
    the map side, so one row for each group and task is shuffled.
    """
    made = [F.count("*").alias("rows")]
    for c in (*numbers, *words):
        made.append(F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"))
    for c in numbers:
        value = F.col(c).cast("double")
        made += [F.min(value).alias(f"least_{c}"), F.max(value).alias(f"most_{c}"), F.when(F.count(value) > 0, F.kll_sketch_agg_double(value, KLL_K)).alias(f"kll_{c}")]
    for c in words:
        word = F.col(c).cast("string")
        made += [F.when(F.count(word) > 0, F.hll_sketch_agg(word, HLL_BITS)).alias(f"hll_{c}"), F.call_function("approx_top_k_accumulate", word, F.lit(TRACKED)).alias(f"top_{c}")]
    return df.groupBy(*by).agg(*made)


def merged(profiles: DataFrame, *by: str) -> DataFrame:
    """The profile of all of a group's rows, as ``profile`` of their union would give within the sketches' errors."""
    made = []
    for c in profiles.columns:
        kind, _, _ = c.partition("_")
        if c == "rows" or kind == "nulls":
            made.append(F.sum(c).alias(c))
        elif kind in ("least", "most"):
            made.append((F.min if kind == "least" else F.max)(c).alias(c))
        elif kind == "kll":
            made.append(F.when(F.count(c) > 0, F.kll_merge_agg_double(c)).alias(c))
        elif kind == "hll":
            made.append(F.when(F.count(c) > 0, F.hll_union_agg(c)).alias(c))
        elif kind == "top":
            made.append(F.call_function("approx_top_k_combine", F.col(c), F.lit(TRACKED)).alias(c))
    return profiles.groupBy(*by).agg(*made)


def quantiles(sketch: Column, shares: list[float]) -> Column:
    """Values at ``shares``, null for no sketch."""
    return F.when(sketch.isNotNull(), F.kll_sketch_get_quantile_double(sketch, F.array(*map(F.lit, shares))))


def distinct(sketch: Column) -> Column:
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0).cast("long"))


def frequent(sketch: Column, n: int) -> Column:
    """(item, count) of the ``n`` most frequent values; exact while no more than are tracked occur.

    Beyond that only values whose count is surely above the sketch's error are named,
    so the list is short or empty where no value stands out. Nulls are tracked like a
    value and left out here.
    """
    return F.slice(F.filter(F.call_function("approx_top_k_estimate", sketch, F.lit(n + 1)), lambda t: t["item"].isNotNull()), 1, n)

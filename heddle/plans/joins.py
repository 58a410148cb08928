"""Joins with a side whose size decides how they run."""

from pyspark.sql import DataFrame, functions as F

#: Rows of a side that is sent to every task; a larger side is joined by a shuffle.
SENT_ROWS = 500_000


def sent_if_small(side: DataFrame, most: int = SENT_ROWS) -> DataFrame:
    """``side`` with a broadcast hint if it has at most ``most`` rows, as counted now; else as it is."""
    return F.broadcast(side) if side.limit(most + 1).count() <= most else side


def join_dimension(facts: DataFrame, dimension: DataFrame, key: str, how: str = "left", most: int = SENT_ROWS) -> DataFrame:
    """``facts`` with the columns of ``dimension`` by ``key``, without a shuffle of the facts while the dimension is small."""
    return facts.join(sent_if_small(dimension, most), key, how)

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from heddle.operators import evaluation
from heddle.plans import ranks


def by_hand(t, e, r):
    comparable = (t[:, None] < t[None, :]) & e[:, None]
    return int(comparable.sum()), int((comparable & (r[None, :] < r[:, None])).sum()), int((comparable & (r[None, :] == r[:, None])).sum())


def made(spark, t, e, r):
    return spark.createDataFrame([(None if x is None else float(x), None if y is None else bool(y), None if z is None else float(z)) for x, y, z in zip(t, e, r)], "t double, e boolean, r double")


@pytest.mark.parametrize("in_range", [evaluation.RISKS_IN_RANGE, 7])
@pytest.mark.parametrize("steps", [None, 5])
def test_against_all_pairs(spark, in_range, steps):
    """Continuous durations and risks, and few values of each, so that ties abound."""
    chance = np.random.default_rng(3)
    t, e = chance.exponential(30, 1500), chance.random(1500) < 0.6
    r = -t + chance.normal(0, 30, 1500)
    if steps:
        t, r = np.floor(t / steps), np.floor(r / steps)
    found = evaluation.concordance_index(made(spark, t, e, r), "t", "e", "r", in_range).collect()
    wanted = by_hand(t, e, r)
    assert [tuple(x)[:3] for x in found] == [wanted]
    assert math.isclose(found[0]["c_index"], (wanted[1] + wanted[2] / 2) / wanted[0], abs_tol=1e-6)


def test_rows_handled_are_n_log_n_and_no_window_holds_a_node(spark, monkeypatch):
    """Rows dealt are at most one for each digit, and a range of a node holds few of them."""
    kept = {}
    keep = evaluation.Scratch.keep

    def noted(self, df, name="t"):
        kept[name] = keep(self, df, name)
        return kept[name]

    monkeypatch.setattr(evaluation.Scratch, "keep", noted)
    n = 1000
    chance = np.random.default_rng(4)
    evaluation.concordance_index(made(spark, chance.random(n), np.ones(n), chance.random(n)), "t", "e", "r", 16).collect()
    sides = kept["sides"]
    assert sides.count() <= n * math.ceil(math.log2(n))
    assert sides.groupBy("digit", "node", "part").count().agg(F.max("count")).first()[0] <= 16


def test_nulls_empty_and_one_duration(spark):
    t, e, r = [1, 2, None, 4, 3, 9], [True, None, True, False, True, True], [5, 1, 1, None, 2, 5]
    assert tuple(evaluation.concordance_index(made(spark, t, e, r), "t", "e", "r").first()) == (4, 2, 1, 0.625)
    assert tuple(evaluation.concordance_index(made(spark, [], [], []), "t", "e", "r").first()) == (0, 0, 0, None)
    assert tuple(evaluation.concordance_index(made(spark, [3, 3], [True, True], [1, 2]), "t", "e", "r").first()) == (0, 0, 0, None)


@pytest.mark.parametrize("by", [None, "k"])
def test_quantiles_of_many_values_and_of_one(spark, by):
    """The sketch's intervals hold many values here; a value that most rows have is one of them."""
    chance = np.random.default_rng(5)
    values = np.concatenate((chance.normal(size=4000), np.full(5000, 0.25), chance.normal(size=1000)))
    df = spark.createDataFrame([(float(v), i % 2) for i, v in enumerate(values)], "v double, k int")
    shares = [0.0, 0.1, 0.5, 0.9, 1.0]
    found = ranks.quantile_bounds(df, "v", shares, by, accuracy=50).collect()
    for row in found:
        own = values if by is None else values[row["k"] :: 2]
        assert np.allclose(row["bounds"], np.quantile(own, shares))
    plan = ranks.quantile_bounds(df, "v", shares, by, accuracy=50)._jdf.queryExecution().optimizedPlan().toString()
    ordered = [line for line in plan.split("\n") if "Window [" in line and "value" in line]
    assert ordered and all("part#" in line for line in ordered)

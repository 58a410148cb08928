import random
import warnings

import pytest
from pyspark.sql import functions as F

from heddle.llm import mixing
from heddle.plans.durable import Scratch


def test_no_document_shrinks_without_a_budget(spark):
    chance = random.Random(1)
    rows = []
    for i in range(3000):
        # the first domain binds; the others' documents are partly its own
        p = 0.999 if i % 3 else chance.uniform(0.05, 0.4)
        rows.append((i, i, 1, 100, p, 1 - p))
    members = spark.createDataFrame(rows, "doc_id long, text_hash long, copies long, tokens long, p0 double, p1 double")
    rates = mixing.fit_rates(members, [0.5, 0.5], None, Scratch(spark, "test")).select("doc_id", "rate").collect()
    assert min(r["rate"] for r in rates) >= 1.0 and max(r["rate"] for r in rates) > 1.2
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(3000)], "doc_id long, text string")
    named = spark.createDataFrame(rates).join(docs.select("doc_id", F.xxhash64("text").alias("text_hash")), "doc_id")
    assert mixing.apply_rates(docs, named).select("doc_id").distinct().count() == 3000
    # with a budget of its own, rates may fall
    given = mixing.fit_rates(members, [0.5, 0.5], 300_000.0, Scratch(spark, "test"))
    assert given.agg(F.min("rate")).first()[0] < 1.0


def test_missed_targets_are_told(spark):
    rows = [(i, i, 1, 100, 0.9 if i % 2 else 0.1, 0.1 if i % 2 else 0.9) for i in range(100)]
    schema = "doc_id long, text_hash long, copies long, tokens long, p0 double, p1 double"
    members, none = spark.createDataFrame(rows, schema), spark.createDataFrame([(1, 1, 1, 100, 1.0, 0.0)], schema)
    with pytest.warns(RuntimeWarning, match="off their targets by 0.*, 0.5 of the budget after 40 steps"):
        mixing.fit_rates(none, [0.5, 0.5], 100.0, Scratch(spark, "test"))
    with pytest.warns(RuntimeWarning, match="after 1 steps"):
        mixing.fit_rates(members, [0.7, 0.3], 10_000.0, Scratch(spark, "test"), steps=1)
    with warnings.catch_warnings():
        warnings.simplefilter("error", RuntimeWarning)
        mixing.fit_rates(members, [0.6, 0.4], 10_000.0, Scratch(spark, "test"))

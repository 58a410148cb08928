import numpy as np
from pyspark.sql import functions as F

from heddle.operators import distributions as d, panel
from heddle.queries import markets, panels
from heddle.sources import bronze, bucketed

N = 60_000


def listings(spark):
    chance = np.random.default_rng(2)
    price, kind = chance.lognormal(15, 1, N), (chance.zipf(1.7, N) % 5000)
    rows = spark.range(N).select("id", F.concat(F.lit("2026-01-0"), (F.col("id") % 5 + 1).cast("string")).alias("dt"), (F.col("id") % 3).cast("string").alias("source"))
    values = spark.createDataFrame(zip(range(N), price.tolist(), map(str, kind.tolist())), "id long, price double, district string")
    joined = rows.join(values, "id").withColumn("price", F.when(F.col("id") % 100 != 0, F.col("price"))).withColumn("empty", F.lit(None).cast("double"))
    return joined, price, kind


def test_merged_sketches_answer_as_one_pass_does(spark, tmp_path):
    """Profiles of days, stored and read back, against exact answers and against one profile of all rows."""
    rows, price, kind = listings(spark)
    bronze.write_partitioned(d.profile(rows, ["dt", "source"], ["price", "empty"], ["district"]), str(tmp_path / "profiles"), "dt")
    stored = spark.read.parquet(str(tmp_path / "profiles")).withColumn("dt", F.col("dt").cast("string"))
    assert stored.count() == 15 and all("dt" in p.name for p in (tmp_path / "profiles").glob("dt=*"))
    span = ["2026-01-02", "2026-01-03", "2026-01-04"]
    ids = np.arange(N)
    inside = np.isin(ids % 5, [1, 2, 3])
    for some, profile in ((inside, d.merged(stored.where(F.col("dt").isin(span)))), (inside, d.profile(rows.where(F.col("dt").isin(span)), [], ["price", "empty"], ["district"]))):
        shares = [0.0, 0.05, 0.25, 0.5, 0.75, 0.99, 1.0]
        told = profile.select("*", d.quantiles(F.col("kll_price"), shares).alias("q"), d.quantiles(F.col("kll_empty"), shares).alias("none"), d.distinct(F.col("hll_district")).alias("n"), d.frequent(F.col("top_district"), 3).alias("top")).first()
        known = np.sort(price[some & (ids % 100 != 0)])
        assert (told["rows"], told["nulls_price"], told["nulls_empty"]) == (some.sum(), (some & (ids % 100 == 0)).sum(), some.sum())
        assert (told["least_price"], told["most_price"]) == (known[0], known[-1]) and told["none"] is None and told["least_empty"] is None
        for share, q in zip(shares, told["q"]):
            assert np.searchsorted(known, q) / len(known) <= share + d.rank_error() and np.searchsorted(known, q, side="right") / len(known) >= share - d.rank_error()
        words, counts = np.unique(kind[some], return_counts=True)
        assert abs(told["n"] - len(words)) <= d.distinct_error() * len(words)
        best = sorted(zip(-counts, words.astype(str)))[:3]
        assert [t["item"] for t in told["top"]] == [w for _, w in best] and all(abs(t["count"] + c) <= 3.5 / d.TRACKED * some.sum() for t, (c, _) in zip(told["top"], best))


def test_no_supplier_stands_out_and_groups_without_values(spark, tmp_path):
    """More suppliers than are tracked, all as frequent: the sketch names none. A null flag, and flags without prices or suppliers."""
    kind = F.when(F.col("id") < 40_000, "N").when(F.col("id") < 40_010, "P").when(F.col("id") < 40_020, "S")
    rows = spark.range(40_030).select(
        F.timestamp_seconds(F.col("id") * 400).alias("l_shipdate"), kind.alias("l_returnflag"), F.when(~kind.eqNullSafe("P"), F.col("id") * 1.0).alias("l_extendedprice"), F.when(~kind.eqNullSafe("S"), F.col("id") % 5000).alias("l_suppkey")
    )
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    found = {r["source"]: tuple(r)[1:] for r in markets.price_distributions(spark, str(tmp_path)).collect()}
    assert found == {
        "N": (40_000, 0, 0.0, 39_999.0, True, True, True), "P": (10, 10, None, None, True, True, True),
        "S": (10, 0, 40_010.0, 40_019.0, True, True, True), None: (10, 0, 40_020.0, 40_029.0, True, True, True),
    }


def test_profiles_of_nothing(spark):
    none = spark.createDataFrame([], "dt string, price double, district string")
    assert d.profile(none, ["dt"], ["price"], ["district"]).count() == 0
    assert d.merged(d.profile(none, ["dt"], ["price"], ["district"]), "dt").count() == 0


def test_labels_of_a_bucketed_panel_need_no_shuffle_and_no_sort(spark, tmp_path):
    labels = panels.survival_bucketed(spark, "/root/testdata/sf0.01")
    plan = labels._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Bucketed: true" in plan
    wanted = sorted(map(tuple, panels.survival_labels(spark, "/root/testdata/sf0.01").collect()))
    assert sorted(map(tuple, labels.collect())) == wanted
    # rows appended later: sorted again, but nothing is shuffled, and the labels are those of all rows
    rows = panels.user_panel(spark, "/root/testdata/sf0.01")
    early, last = rows.where("user_id % 2 = 0"), rows.where("user_id % 2 = 1")
    bucketed.save_bucketed(early, "grown_panel", "user_id", ["obs_date"], 4, str(tmp_path / "grown"))
    last.write.bucketBy(4, "user_id").sortBy("user_id", "obs_date").mode("append").saveAsTable("grown_panel")
    grown = panel.survival_labels(bucketed.bucketed(spark, "grown_panel"), panels.last_day(spark, "/root/testdata/sf0.01"), "user_id")
    plan = grown._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" in plan
    assert sorted(map(tuple, grown.collect())) == wanted
    spark.sql("DROP TABLE grown_panel")


def test_buckets_are_powers_of_two():
    assert [bucketed.buckets_for(n, 10) for n in (0, 1, 10, 11, 20, 21, 1000)] == [1, 1, 1, 2, 2, 4, 128]

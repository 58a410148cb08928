"""The daily jobs and writers end to end, on small tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from heddle import cli
from heddle.functions import web
from heddle.operators import frontier, gates, models, pages
from heddle.plans import ranks
from heddle.plans.joins import join_dimension
from heddle.sources import bronze
from heddle.sources.silver import read_silver
from tests.test_pages import PORTAL_A, PORTAL_B, PORTAL_C, PORTAL_D, row

DAY = "2026-09-20"


def test_parse_then_cluster(spark, tmp_path):
    pages = [row("batdongsan", PORTAL_A), row("phongtro123", PORTAL_B), row("mogi", PORTAL_C), row("nhatot", PORTAL_D)]
    pages += [(f"mogi:{i}", *row("mogi", PORTAL_C)[1:]) for i in range(2, 30)]
    records = spark.createDataFrame([(*p[:4], p[4], *p[5:]) for p in pages], bronze.SCHEMA)
    bronze.write_bronze(records, str(tmp_path / "bronze"))
    metrics = cli.parse(spark, DAY, str(tmp_path / "bronze"), str(tmp_path / "silver"))
    assert (metrics["n_rows"], metrics["parsed"], metrics["repeated_keys"]) == (32, 32, 0)
    silver = spark.read.parquet(str(tmp_path / "silver"))
    assert silver.count() == 32 and {"province", "dt"} <= set(silver.columns)
    assert sorted(p.name for p in (tmp_path / "silver").glob("province=*")) == ["province=HCM", "province=HN"]
    cli.cluster(spark, str(tmp_path / "silver"), str(tmp_path / "dim"), DAY)
    dim = {r["listing_id"]: r for r in spark.read.parquet(str(tmp_path / "dim")).collect()}
    same = [r for r in dim.values() if r["listing_id"].startswith("mogi")]
    assert len(dim) == 32 and {r["canonical_id"] for r in same} == {"mogi:1"} and {r["cluster_size"] for r in same} == {29}
    assert [r["listing_id"] for r in same if r["is_canonical"]] == ["mogi:1"] and dim["nhatot:1"]["cluster_size"] == 1
    # of a day before there is nothing
    cli.cluster(spark, str(tmp_path / "silver"), str(tmp_path / "none"), "2026-09-19")
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0


def test_silver_is_read_by_schema_and_day(spark, tmp_path):
    """The schema is what the parse job writes; a day and a province are chosen by their folders."""
    made = pages.parse_bronze(spark.createDataFrame([row("mogi", PORTAL_C), row("batdongsan", PORTAL_A), row("phongtro123", PORTAL_B), row("nhatot", PORTAL_D)], bronze.SCHEMA), DAY)
    town = made.where("province = 'HCM'").count()
    assert 0 < town < 4
    kinds = lambda df: sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    path = str(tmp_path / "silver")
    for day in (DAY, "2026-09-21", "2026-09-22"):
        bronze.write_partitioned(made.withColumn("dt", F.lit(day)), path, "province", "dt")
    whole = read_silver(spark, path)
    assert kinds(whole) == kinds(made) and whole.count() == 12
    some = read_silver(spark, path, "2026-09-21", "2026-09-21", ["HCM"]).select("listing_id", "dt")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "ReadSchema: struct<listing_id:string>" in plan
    assert [r["dt"] for r in some.collect()] == ["2026-09-21"] * town
    read_nothing = read_silver(spark, path, last="2026-09-19")
    assert read_nothing.count() == 0


def test_parse_stops_at_a_gate(spark, tmp_path):
    bronze.write_bronze(spark.createDataFrame([row("mogi", "x", status=404)], bronze.SCHEMA), str(tmp_path / "bronze"))
    with pytest.raises(gates.GateError, match="parse_rate"):
        cli.parse(spark, DAY, str(tmp_path / "bronze"), str(tmp_path / "silver"))
    assert not (tmp_path / "silver").exists()


def test_probes_to_panel_and_labels(spark, tmp_path):
    days = [dt.date(2026, 9, 28) + dt.timedelta(days=i) for i in range(6)]
    rows = [("a", d, i < 2) for i, d in enumerate(days)] + [("b", d, True) for d in days]
    probes = spark.createDataFrame(rows, "listing_id string, obs_date date, is_present boolean")
    bronze.write_probes(probes, str(tmp_path / "probes"))
    assert len(list((tmp_path / "probes").glob("dt=*"))) == 6
    argv = ["panel", "--censor-date", "2026-10-03", "--input", str(tmp_path / "probes"), "--output", str(tmp_path / "panel"), "--output-survival", str(tmp_path / "labels")]
    cli.build_panel(spark, *argv[2::2])
    assert sorted(p.name for p in (tmp_path / "panel").glob("month=*")) == ["month=2026-09", "month=2026-10"]
    assert spark.read.parquet(str(tmp_path / "panel")).count() == 12
    labels = {r["listing_id"]: (r["duration_days"], r["event_observed"]) for r in spark.read.parquet(str(tmp_path / "labels")).collect()}
    assert labels == {"a": (2, True), "b": (5, False)}


def test_arguments():
    with pytest.raises(SystemExit):
        cli.main(["parse", "--date", DAY])
    with pytest.raises(SystemExit):
        cli.main(["crawl"])


def test_views_for_sql(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "region_id int, name string").write.parquet(str(tmp_path / "region.parquet"))
    bronze.register_views(spark, str(tmp_path), ["region"])
    assert spark.sql("SELECT count(*) AS n FROM region WHERE name = 'x'").first()["n"] == 1


def test_gone_and_today(spark):
    df = spark.createDataFrame([("a", None), ("b", dt.date(2026, 9, 1))], "url string, gone_date date")
    assert [r["url"] for r in df.where(frontier.is_gone(df)).collect()] == ["b"]
    assert frontier.today(dt.date(2026, 1, 2)) == dt.date(2026, 1, 2) and frontier.today() == dt.datetime.now(dt.timezone.utc).date()


def test_sitemap_tree(spark):
    index = lambda *urls: f"<sitemapindex>{''.join(f'<sitemap><loc>{u}</loc></sitemap>' for u in urls)}</sitemapindex>"
    pages = lambda *urls: f"<urlset>{''.join(f'<url><loc> {u} </loc></url>' for u in urls)}</urlset>"
    held = spark.createDataFrame([("r", index("s1", "s2", "lost")), ("s1", pages("/rent-1", "/buy-1")), ("s2", pages("/rent-1", "/rent-2")), ("other", pages("/rent-9")), ("bad", None)], "location string, xml string")
    roots = spark.createDataFrame([("r",)], "url string")
    assert sorted(r[0] for r in web.sitemap_tree(held, "location", "xml", roots, "/rent").collect()) == ["/rent-1", "/rent-2"]
    assert web.sitemap_tree(held, "location", "xml", roots, "/rent", levels=1).count() == 0


@pytest.mark.parametrize("by", [None, "kind"])
def test_ranks_against_sorting(spark, by):
    chance = random.Random(3)
    rows = [(i, "ab"[chance.random() < 0.2], None if i % 11 == 0 else float(chance.choice([0, 1, 1, 1, 2, chance.randrange(500)]))) for i in range(2003)]
    df = spark.createDataFrame(rows, "id int, kind string, v double").repartition(5)
    shares = [0.1, 0.25, 0.5, 1 / 3, 1.0]
    for kind in ("a", "b") if by else (None,):
        values = sorted(v for _, k, v in rows if v is not None and kind in (None, k))
        found = ranks.quantile_bounds(df, "v", shares, by)
        found = found.where(F.col(by) == kind) if by else found
        for share, bound in zip(shares, found.first()["bounds"]):
            at = share * (len(values) - 1)
            low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
            assert abs(bound - (low + (high - low) * (at - int(at)))) < 1e-9
        tiles = ranks.ntile(df, 7, ["v", "id"], by)
        tiles = tiles.where(F.col(by) == kind) if by else tiles
        mine = sorted(((v is not None, v or 0.0, i) for i, k, v in rows if kind in (None, k)))
        size, more = divmod(len(mine), 7)
        wanted = {i: (p // (size + 1) if p < more * (size + 1) else more + (p - more * (size + 1)) // size) + 1 for p, (_, _, i) in enumerate(mine)}
        assert {r["id"]: r["tile"] for r in tiles.collect()} == wanted
    numbers = ranks.numbered(df, ["id"])
    assert sorted((r["id"], r["number"]) for r in numbers.collect()) == [(i, i) for i in range(2003)]
    none = [r["bounds"] for r in ranks.quantile_bounds(df.limit(0), "v", shares, by).collect()]
    assert none == ([] if by else [[None] * 5]) and ranks.ntile(df.limit(0), 3, ["v"], by).count() == 0


def test_dimension_joins_alike_at_any_size(spark):
    facts = spark.createDataFrame([(i % 5, i) for i in range(50)], "k int, n int")
    dimension = spark.createDataFrame([(0, "a"), (1, "b"), (2, None)], "k int, name string")
    small, large = join_dimension(facts, dimension, "k"), join_dimension(facts, dimension, "k", most=2)
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, large.collect()), key=str) and small.count() == 50
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(small) and "broadcast" not in plan(large)


def test_price_gap_is_worth_something(spark):
    chance = random.Random(5)
    rows = []
    for i in range(600):
        gap, area = chance.uniform(-0.3, 0.3), chance.uniform(15, 60)
        rows.append((i, gap, area, float(max(1, round(20 * 2.718 ** (2.5 * gap + chance.gauss(0, 0.3))))), i % 5 != 0))
    df = spark.createDataFrame(rows, "id int, price_gap double, area double, duration_days double, event_observed boolean")
    found = models.concordance_ablation(df.where("id % 3 <> 0"), df.where("id % 3 = 0"), ["price_gap", "area"], "price_gap")
    assert found["all"] > 0.7 and found["all"] > found["without_price_gap"] + 0.1

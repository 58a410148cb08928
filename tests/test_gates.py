import datetime as dt

import pytest
from pyspark.sql import functions as F

from heddle.operators import gates
from heddle.sources import staged

DAY = dt.date(2026, 9, 20)
CLEAN = {
    "listing_id": "s:1", "source": "s", "url": "http://x/0901234567", "crawl_date": DAY, "title": "phòng", "asking_rent_vnd": 9_500_000, "area_sqm": 45.0,
    "province": "HCM", "furnishing": "full", "address": "quận 3", "ward": None, "is_active": True, "parse_ok": True, "dt": "2026-09-20",
}
KINDS = (
    "listing_id string, source string, url string, crawl_date date, title string, asking_rent_vnd long, area_sqm double, province string, furnishing string, "
    "address string, ward string, is_active boolean, parse_ok boolean, dt string"
)


def silver(spark, *changes, n=20):
    rows = [CLEAN | {"listing_id": f"s:{i}"} for i in range(n)]
    for i, change in enumerate(changes):
        rows[i] = rows[i] | change
    return spark.createDataFrame([tuple(r.values()) for r in rows], KINDS)


def test_clean_passes(spark):
    assert gates.quality_gate(silver(spark), DAY)["parsed"] == 20
    assert gates.pii_gate(silver(spark)) == 0


@pytest.mark.parametrize("column", ["title", "address", "ward"])
def test_phone_numbers_fail(spark, column):
    with pytest.raises(gates.GateError, match="1 rows contain phone numbers"):
        gates.pii_gate(silver(spark, {column: "gọi 090.123.4567"}))


def test_scanned_columns_follow_the_schema(spark):
    assert gates.pii_columns(silver(spark).withColumn("new_text", F.lit("x"))) == ["title", "province", "furnishing", "address", "ward", "new_text"]


@pytest.mark.parametrize(
    "rule, changes",
    [
        ("asking_rent_range", [{"asking_rent_vnd": 1_000}]), ("area_range", [{"area_sqm": 4000.0}]), ("province_known", [{"province": "Ho Chi Minh"}]), ("furnishing_enum", [{"furnishing": None}]),
        ("furnishing_enum", [{"furnishing": "some"}]), ("listing_id_unique", [{"listing_id": "s:19"}]), ("parse_rate", [{"parse_ok": False}] * 2), ("parse_rate", [{"is_active": False, "parse_ok": False}] * 20),
        ("core_fields_null", [{"title": None, "asking_rent_vnd": None, "area_sqm": None}] * 2),
    ],
)
def test_rules(spark, rule, changes):
    with pytest.raises(gates.GateError) as found:
        gates.quality_gate(silver(spark, *changes), DAY)
    assert found.value.rule == rule


def test_soft_rules_pass(spark):
    metrics = gates.quality_gate(silver(spark, {"province": None}, {"crawl_date": dt.date(2026, 9, 21)}, *[{"is_active": False, "parse_ok": False}] * 5, {"asking_rent_vnd": None}), DAY)
    assert (metrics["province_missing"], metrics["other_days"], metrics["not_fetched"], metrics["parsed"]) == (1, 1, 5, 15)


def test_no_rows_fail(spark):
    with pytest.raises(gates.GateError, match="row_count"):
        gates.quality_gate(silver(spark).limit(0), DAY)


def dealt(spark, path):
    return sorted(r["listing_id"] for r in spark.read.schema(KINDS).parquet(path).collect())


def test_gates_while_writing_are_one_pass(spark, tmp_path):
    """Each row is made once, and the metrics are those of the gates after the fact."""
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    rows = silver(spark, {"province": None}, {"is_active": False, "parse_ok": False})
    path = str(tmp_path / "silver")
    found = gates.write_gated(rows.mapInPandas(counted, rows.schema), path, DAY)
    assert made.value == 20 and found == gates.quality_gate(rows, DAY)
    assert dealt(spark, path) == dealt_ids(rows) and sorted(p.name for p in tmp_path.iterdir()) == ["silver"]
    assert sorted(p.parent.name + "/" + p.name for p in (tmp_path / "silver").glob("*/*")) == ["province=HCM/dt=2026-09-20", "province=__HIVE_DEFAULT_PARTITION__/dt=2026-09-20"]


def dealt_ids(df):
    return sorted(r["listing_id"] for r in df.collect())


@pytest.mark.parametrize("rule, change", [("pii", {"title": "gọi 090.123.4567"}), ("listing_id_unique", {"listing_id": "s:19"}), ("row_count", None)])
def test_a_gate_that_fails_leaves_the_table(spark, tmp_path, rule, change):
    path = str(tmp_path / "silver")
    gates.write_gated(silver(spark, n=5), path, DAY)
    before = {p: p.read_bytes() for p in (tmp_path / "silver").rglob("*.parquet")}
    worse = silver(spark, change) if change else silver(spark).limit(0)
    with pytest.raises(gates.GateError) as found:
        gates.write_gated(worse, path, DAY)
    assert found.value.rule == rule
    assert {p: p.read_bytes() for p in (tmp_path / "silver").rglob("*.parquet")} == before and sorted(p.name for p in tmp_path.iterdir()) == ["silver"]


def test_promotion_replaces_partitions_and_keeps_others(spark, tmp_path):
    path = str(tmp_path / "silver")
    gates.write_gated(silver(spark, *[{"province": "HN", "listing_id": "h"}], n=5), path, DAY)
    gates.write_gated(silver(spark, n=3), path, DAY)
    assert dealt(spark, path) == ["h", "s:0", "s:1", "s:2"]


def test_a_promotion_that_fails_midway_is_undone(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "silver")
    rows = silver(spark, {"province": "HN", "listing_id": "h"}, n=5)
    gates.write_gated(rows, path, DAY)
    with staged.Staged(spark, path, ("province", "dt")) as aside:
        aside.write(silver(spark, {"province": "HN", "listing_id": "new"}, n=2))
        real = aside.partitions()
        monkeypatch.setattr(aside, "partitions", lambda: [*real, "/province=none/dt=none"])
        with pytest.raises(Exception, match="none"):
            aside.promote()
    assert dealt(spark, path) == dealt_ids(rows) and sorted(p.name for p in tmp_path.iterdir()) == ["silver"]


def test_rows_observed_twice_are_counted_once(spark, tmp_path, monkeypatch):
    """As when a lost executor's tasks run again."""
    twice = {"n_rows": 40, "leaking_rows": 2}
    monkeypatch.setattr(gates.Observation, "get", property(lambda self: twice))
    assert gates.write_gated(silver(spark), str(tmp_path / "silver"), DAY)["n_rows"] == 20

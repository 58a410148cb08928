import pytest
from pyspark.sql import functions as F

from heddle.functions import text as ft, vocab


def values(spark, rows, kind, *columns):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], kind)
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


def test_prices(spark):
    cases = {
        "7tr5": 7_500_000, "7.5 triệu": 7_500_000, "7,5 triệu/tháng": 7_500_000, "12tr500": 12_500_000, "3 triệu": 3_000_000, "7,500,000": 7_500_000, "850 nghìn": 850_000,
        "500k": 500_000, "Thỏa thuận": None, "thoa thuan": None, "": None, None: None, "123456": None, "7 triệu 2 phòng": 7_200_000, "3.500 nghìn": 3_500, "3.500.000 nghìn": None,
    }
    assert values(spark, list(cases), "raw string", ft.parse_price(F.col("raw"))) == list(cases.values())


def test_areas(spark):
    cases = {"25 m2": 25.0, "25,5m²": 25.5, "không rõ": None, None: None, "": None}
    assert values(spark, list(cases), "raw string", ft.parse_area(F.col("raw"))) == list(cases.values())


@pytest.mark.parametrize("raw, code", [("Hồ Chí Minh", "HCM"), ("TP.HCM", "HCM"), ("Tp Hồ Chí Minh", "HCM"), ("TPHCM", "HCM"), ("Sài Gòn", "HCM"), ("Hà Nội", "HN"), ("Tỉnh Bình Dương", "BD"), ("Đà Nẵng", "DN"), ("Cần Thơ", "CT"), ("Đồng Nai", "DNA"), ("Huế", None), ("", None), (None, None)])
def test_provinces(spark, raw, code):
    assert values(spark, [(raw,)], "raw string", ft.normalise_province(F.col("raw"))) == [code]


def test_districts(spark):
    cases = {"Quận 3": "3", "Q.7": "7", "Bình Thạnh": "binh thanh", "Quận Gò Vấp": "go vap", "Huyện Nhà Bè": "nha be", "TP. Thủ Đức": "thu duc", "Quận Gò Vấp": "go vap", "Q.": None, "": None, None: None}
    assert values(spark, list(cases), "raw string", ft.normalise_district(F.col("raw"))) == list(cases.values())


def test_vocabularies(spark):
    rows = [("mogi", "Đầy đủ"), ("mogi", "  CƠ BẢN "), ("nhatot", "lạ"), ("phongtro123", "full"), ("batdongsan", None), ("batdongsan", "NONE"), ("zillow", "Đầy đủ")]
    assert values(spark, rows, "s string, r string", ft.normalise_furnishing(F.col("s"), F.col("r"))) == ["full", "basic", "unknown", "full", "unknown", "none", "unknown"]
    rows = [("mogi", "Căn hộ"), ("mogi", "biệt thự"), ("nhatot", "lạ"), ("nhatot", None)]
    assert values(spark, rows, "s string, r string", ft.normalise_property_type(F.col("s"), F.col("r"))) == ["apartment", "house", "other", "other"]
    assert {v for words in vocab.FURNISHING.values() for v in words.values()} <= set(vocab.FURNISHING_LEVELS)
    assert {v for words in vocab.PROPERTY_TYPE.values() for v in words.values()} <= set(vocab.PROPERTY_TYPES)


def test_personal_data(spark):
    text = "LH 090.123.4567 hoặc a.b@mail.vn, zalo: 0901234567 nhé"
    assert values(spark, [(text,), (None,)], "t string", ft.strip_pii(F.col("t"))) == ["LH <PHONE> hoặc <EMAIL>, <SOCIAL> nhé", ""]
    assert values(spark, [("٠٩ nhé ａ@b.c",)], "t string", ft.strip_pii(F.col("t"), unicode=True)) == ["٠٩ nhé <EMAIL>"]


def test_shingles_and_blocks(spark):
    assert values(spark, ["abcd", "ab", "", None, "é😀xy"], "t string", ft.char_shingles(F.col("t"))) == [["abc", "bcd"], [], [], [], ["é😀x", "😀xy"]]
    rows = [("HCM", "Q7", 25.4, 7_040_000), ("HCM", None, None, 7_050_000)]
    key = ft.block_key(F.col("p"), F.col("d"), F.col("a"), F.col("r"))
    assert values(spark, rows, "p string, d string, a double, r long", key) == ["HCM|Q7|25.0|7000000", "HCM||7100000"]


def test_dates_and_flags(spark):
    assert [str(v) for v in values(spark, ["2026-09-20T01:02:03Z", "2026-9-1", "2026-13-01", None], "t string", ft.iso_date(F.col("t")))] == ["2026-09-20", "None", "None", "None"]
    assert values(spark, ["2pn có Máy Lạnh"], "t string", *ft.amenity_flags(F.col("t"))[:2]) == [(1, 0)]
    assert values(spark, ["PT gần chợ, 2 wc"], "t string", ft.expand_abbreviations(F.col("t"))) == ["phòng trọ gần chợ, 2 nhà vệ sinh"]

import base64
import gzip
import json

import pytest
from pyspark.sql import functions as F

from heddle.operators.pages import page_fields, parse_bronze
from heddle.sources import bronze

A_LD = {
    "@type": "VacationRental", "identifier": "46260999", "name": "Căn hộ đẹp", "priceRange": "9.5 triệu/tháng", "additionalType": "Cho thuê căn hộ chung cư", "description": "Gọi 0901234567 nhé",
    "Latitude": "10.8", "Longitude": "106.7",
    "ContainsPlace": {"FloorSize": {"Value": "45", "UnitCode": "SQM"}, "numberOfBedrooms": "2", "numberOfBathroomsTotal": "x", "Address": {"@addressRegion": "Quận Bình Thạnh", "@streetAddress": "1 Lê Lợi"}, "amenityFeature": [{"Name": "Wifi"}, {"Name": "Furnished", "Value": "Đầy đủ"}]},
}
PORTAL_A = f"""<html><body><script type="application/ld+json">{{broken</script><script type="application/ld+json">{json.dumps(A_LD)}</script>
<div class="re__breadcrumb"><a level="2">Hồ Chí Minh</a><a level="3">Quận 1</a></div></body></html>"""
PORTAL_A_DOM = """<div id="product-detail-web" prid="77"></div><h1 class="re__pr-title"> Nhà &amp; đất </h1>
<div class="re__pr-short-info-item"><span class="title">Mức giá</span><span class="value">12 triệu</span></div>
<div class="re__pr-short-info-item"><span class="title">Diện tích</span><span class="value">30 m²</span></div><div class="re__detail-content">mô <b>tả</b></div><span class="re__address-line-1">ở đâu</span>"""
PORTAL_B = """<body data-id="712920"><script type="application/ld+json">{"@type": "House", "floorSize": {"value": "20"}, "address": {"addressLocality": "Hồ Chí Minh"}}</script>
<ol class="breadcrumb"><li class="breadcrumb-item">a<li class="breadcrumb-item">b<li class="breadcrumb-item">Quận Gò Vấp</ol><h1>Phòng NTCB 2PN</h1><span class="text-green fw-bold">3tr5</span>
<div><h2>Thông tin mô tả</h2><p>Có 1 wc<p>Zalo: 0901<br>234567<h2>Khác</h2><p>không</div><table><tr><td>Địa chỉ:</td><td>12 Phố</td></tr></table></body>"""
PORTAL_C = """<div class="title"><h1>Phòng trọ</h1></div><div class="price">5 triệu</div><div class="main-info"><div class="address">1 A, Phường 2, Quận 3, TPHCM</div></div>
<div class="info-attr"><span>Mã BĐS</span><span>22742913</span></div><div class="info-attr"><span>Diện tích sử dụng</span><span>18 m2</span></div><div class="info-attr"><span>Toilet</span><span>1</span></div>
<script>var catLv3 = 'Nhà trọ';</script><iframe data-src="https://maps/embed/v1?q=10.5,106.5"></iframe><div class="info-content-body">Mail a@b.vn</div>"""
AD = {"ad": {"list_id": 134122706, "subject": "Căn hộ", "price": 7000000, "size": 50, "region_name": "Hà Nội", "area_name": "Quận 7", "ward_name": "P. 1", "rooms": 2, "toilets": 1, "body": "090.123.4567", "latitude": 21.0, "longitude": 105.8, "category_name": "Nhà riêng"}, "ad_params": {"address": {"value": "x"}, "furnishing_sell": {"value": "Nội thất đầy đủ"}}}
PORTAL_D = f'<script id="__NEXT_DATA__">{json.dumps({"props": {"pageProps": {"initialState": {"adView": {"adInfo": AD}}}}})}</script>'


def row(source, html, status=200, packed=None, url="https://x/y-pr5.html"):
    data = html if isinstance(html, bytes) else html.encode()
    return (f"{source}:1", source, url, "2026-09-20T10:00:00Z", status, "sha256:0", base64.b64encode(gzip.compress(data)).decode() if packed is None else packed, 1.0, "panel")


def parsed(spark, *rows):
    return [r.asDict() for r in parse_bronze(spark.createDataFrame(list(rows), bronze.SCHEMA), "2026-09-20").collect()]


def test_four_portals(spark):
    a, b, c, d = parsed(spark, row("batdongsan", PORTAL_A), row("phongtro123", PORTAL_B), row("mogi", PORTAL_C), row("nhatot", PORTAL_D))
    assert all(r["parse_ok"] and r["is_active"] and r["amenities"] == [] and str(r["crawl_date"]) == "2026-09-20" for r in (a, b, c, d))
    keep = lambda r, *names: tuple(r[n] for n in names)
    main = ("asking_rent_vnd", "area_sqm", "province", "district", "furnishing", "property_type", "bedrooms", "bathrooms")
    assert keep(a, *main) == (9_500_000, 45.0, "HCM", "binh thanh", "full", "apartment", 2, None)
    assert keep(a, "title", "address", "latitude", "description_clean") == ("Căn hộ đẹp", "1 Lê Lợi", 10.8, "Gọi <PHONE> nhé")
    assert keep(b, *main) == (3_500_000, 20.0, "HCM", "go vap", "basic", "other", 2, 1)
    assert keep(b, "address", "description_clean") == ("12 Phố", "Có 1 wc\n<SOCIAL>")
    assert keep(c, *main) == (5_000_000, 18.0, "HCM", "3", "unknown", "room", None, 1) and keep(c, "latitude", "longitude", "description_clean") == (10.5, 106.5, "Mail <EMAIL>")
    assert keep(d, *main) == (7_000_000, 50.0, "HN", "7", "full", "house", 2, 1) and keep(d, "ward", "description_clean") == ("P. 1", "<PHONE>")


def test_fallbacks():
    found = page_fields("batdongsan", PORTAL_A_DOM, "https://x/pr9")
    assert (found["native_id"], found["title"], found["price_text"], found["area_text"], found["description"], found["address"]) == ("77", "Nhà & đất", "12 triệu", "30 m²", "mô tả", "ở đâu")
    assert page_fields("mogi", "<p>x", "https://m/x-id22")["native_id"] == "22"
    assert all(v is None for k, v in page_fields("nhatot", "<p>x", "u").items() if k != "description")


def test_each_row_in_is_one_row_out(spark):
    rows = [row("mogi", "<p>nothing here"), row("mogi", ""), row("mogi", "x", packed="not base64 at all"), row("mogi", b"\xff\xfe"), row("zillow", "x"), row("mogi", "x", status=404), row("mogi", "x", packed=""), row("mogi", "x", packed="AAAA"), row("nhatot", '<script id="__NEXT_DATA__">[</script>')]
    rows.append((*rows[0][:6], None, *rows[0][7:]))
    found = parsed(spark, *rows)
    assert [r["parse_error"] for r in found][1:] == ["ParserError: empty document", "decompress: Error", "decode: UnicodeDecodeError", "unknown source: zillow", "http_status: 404", "ParserError: empty document", "decompress: BadGzipFile", None, "decompress: TypeError"]
    assert found[0]["parse_ok"] and found[0]["title"] is None and found[0]["furnishing"] == "unknown"
    assert [r["is_active"] for r in found] == [True] * 5 + [False] + [True] * 4 and [r["parse_ok"] for r in found] == [True] + [False] * 7 + [True, False]


def test_a_parsers_exception_keeps_its_class(spark):
    broken = {"ad": {"list_id": 1}, "ad_params": {"address": {"value": ["x"]}}}
    page = f'<script id="__NEXT_DATA__">{json.dumps({"props": {"pageProps": {"initialState": {"adView": {"adInfo": broken}}}}})}</script>'
    deep = '<script type="application/ld+json">' + json.dumps({"@type": "VacationRental", "ContainsPlace": ["not an object"]}) + "</script>"
    found = parsed(spark, row("nhatot", page), row("batdongsan", deep))
    assert found[0]["parse_error"] is None and found[0]["address"] == "['x']"
    assert found[1]["parse_error"].startswith("AttributeError: ") and not found[1]["parse_ok"]


def test_no_rows_and_same_rows_twice(spark):
    empty = parse_bronze(spark.createDataFrame([], bronze.SCHEMA), "2026-09-20")
    assert empty.count() == 0 and len(empty.columns) == 27
    assert parsed(spark, row("mogi", PORTAL_C)) == parsed(spark, row("mogi", PORTAL_C))


@pytest.mark.parametrize("text", ["<div " * 2000, "<div>" * 20_000, "<!--" + "x" * 10_000, "&#xZZ; <p =>>"])
def test_tag_soup_does_not_crash(text):
    page_fields("mogi", text, "u")


def test_bronze_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([("https://x/a/pr1/", "<b>é</b>", 1), ("https://x/b", None, 2)], "url string, html string, n int")
    made = bronze.bronze_records(pages, F.lit("mogi"), F.lit(200), F.lit("2026-09-20T00:00:00Z"), F.col("n"), "panel")
    bronze.write_bronze(made, str(tmp_path / "bronze"))
    back = bronze.read_bronze(spark, str(tmp_path / "bronze"), "2026-09-20")
    assert sorted(r["listing_id"] for r in back.collect()) == ["mogi:b", "mogi:pr1"]
    assert gzip.decompress(base64.b64decode(back.where("listing_id = 'mogi:pr1'").first()["html_gz_b64"])).decode() == "<b>é</b>"
    assert [r["parse_ok"] for r in parse_bronze(back, "2026-09-20").orderBy("listing_id").collect()] == [False, True]
    lines = spark.createDataFrame([(json.dumps({"listing_id": "a", "http_status": 200}),), ("junk",)], "value string")
    assert [r["listing_id"] for r in bronze.bronze_from_lines(lines).collect()] == ["a", None]


def test_rerun_replaces_its_partitions_only(spark, tmp_path):
    out = str(tmp_path / "silver")
    for day, value in (("1", "old"), ("2", "old"), ("2", "new")):
        bronze.write_partitioned(spark.createDataFrame([(day, value)], "dt string, v string"), out, "dt")
    assert sorted((str(r["dt"]), r["v"]) for r in spark.read.parquet(out).collect()) == [("1", "old"), ("2", "new")]
    assert bronze.layer_path("/data/", "/silver/", "listings/") == "/data/silver/listings"


def test_json_pages_without_python(spark):
    """Variants give what a tree and a JSON parser gave, in a plan without Python; what isn't JSON, or no page, gives nulls."""
    from heddle.operators.pages import app_fields, linked_fields

    odd = ["", "<p>x", '<script id="__NEXT_DATA__">{broken</script>', '<script id="__NEXT_DATA__">[1]</script>', '<script type="application/ld+json">[{"@type": "House"}]</script>', None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([PORTAL_D, PORTAL_A, PORTAL_B, PORTAL_D.replace('<script id="', "<SCRIPT type='x' ID = '").replace('__">', "__' >"), *odd])], "i int, html string")
    told = rows.select("i", app_fields(F.col("html")).alias("app"), linked_fields(F.col("html")).alias("ld"))
    found = {r["i"]: r for r in told.collect()}
    keep = lambda r, *names: tuple(r[n] for n in names)
    assert keep(found[0]["app"], "native_id", "title", "price_number", "area_number", "province", "district", "ward", "bedrooms", "property_type") == ("134122706", "Căn hộ", "7000000", "50", "Hà Nội", "Quận 7", "P. 1", "2", AD["ad"]["category_name"])
    assert found[3]["app"] == found[0]["app"] and float(found[0]["app"]["latitude"]) == 21
    assert keep(found[1]["ld"], "native_id", "title", "price_text", "area_number", "district", "latitude", "bedrooms") == ("46260999", "Căn hộ đẹp", "9.5 triệu/tháng", "45", "Quận Bình Thạnh", "10.8", "2")
    assert keep(found[2]["ld"], "property_type", "area_number", "province") == ("House", "20", "Hồ Chí Minh")
    for i in range(4, 4 + len(odd)):
        assert not any(found[i]["app"]) and not any(found[i]["ld"])
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

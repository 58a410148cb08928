"""Listing pages of the four sources, written from the columns of ``part`` and parsed back."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from heddle.functions.text import normalise_district, normalise_province, parse_price, strip_pii
from heddle.operators.pages import app_fields, linked_fields, parse_bronze
from heddle.sources import table
from heddle.sources.bronze import bronze_records

DAY = "2026-01-02"
CRAWLED = f"{DAY}T03:04:05Z"

# Expressions that read alike in Spark and DuckDB: k numbers the rows, m cycles through variants.
_SOURCE = "CASE k % 4 WHEN 0 THEN 'batdongsan' WHEN 1 THEN 'phongtro123' WHEN 2 THEN 'mogi' ELSE 'nhatot' END"
_PLACE = "CASE m WHEN 0 THEN 'Hồ Chí Minh' WHEN 1 THEN 'Thành phố Hà Nội' ELSE 'Tỉnh Bình Dương' END"
_PART = "CASE m WHEN 0 THEN 'Quận Bình Thạnh' WHEN 1 THEN 'Huyện Nhà Bè' ELSE concat('Q.', {n}) END"
_N = "CAST(1 + k % 12 AS STRING)"
_AREA = "CAST(10 + k % 90 AS STRING)"
_SIZE = "CAST(p_size AS STRING)"
_BEDS, _BATHS = "CAST(k % 5 AS STRING)", "CAST(1 + k % 3 AS STRING)"
_SPOT = "concat({whole}, '.', CAST(10 + k % 90 AS STRING))"
_STORY = "concat('Gọi 0901234567 hoặc a.b@c.vn, Zalo: x', {k}, ' nhé')".format(k="CAST(k AS STRING)")
_STORED = "concat('Gọi <PHONE> hoặc <EMAIL>, <SOCIAL> nhé')"
_LEVEL = "CASE m WHEN 0 THEN 'Đầy đủ' WHEN 1 THEN 'Cơ bản' ELSE 'Nhà trống' END"


def _district() -> str:
    return _PART.format(n=_N)


_BATDONGSAN = f"""concat('<html><body><script type="application/ld+json">{{"@type": "Organization"}}</script><script type="application/ld+json">{{"@type": "VacationRental", "identifier": "', CAST(k AS STRING),
    '", "name": "Căn hộ ', p_name, '", "priceRange": "', {_SIZE}, ' triệu/tháng", "additionalType": "Cho thuê căn hộ chung cư", "description": "', {_STORY}, '", "Latitude": "', {_SPOT.format(whole="'10'")},
    '", "Longitude": "', {_SPOT.format(whole="'106'")}, '", "ContainsPlace": {{"FloorSize": {{"Value": "', {_AREA}, '", "UnitCode": "SQM"}}, "numberOfBedrooms": ', {_BEDS}, ', "numberOfBathroomsTotal": "', {_BATHS},
    '", "Address": {{"@addressRegion": "', {_district()}, '", "@streetAddress": "', CAST(k AS STRING), ' Lê Lợi"}}, "amenityFeature": [{{"Name": "Wifi"}}, {{"Name": "Furnished", "Value": "', {_LEVEL},
    '"}}]}}}}</script><div class="re__breadcrumb x"><a level="1">Cho thuê</a><a level="2">', {_PLACE}, '</a></div></body></html>')"""
_PHONGTRO = f"""concat('<body data-id="', CAST(k AS STRING), '"><script type="application/ld+json">{{"@type": "Apartment", "floorSize": {{"value": "', {_AREA}, '"}}, "address": {{"addressLocality": "', {_PLACE},
    '", "streetAddress": "', CAST(k AS STRING), ' Phố Huế"}}}}</script><ol class="breadcrumb"><li class="breadcrumb-item">a</li><li class="breadcrumb-item">b</li><li class="breadcrumb-item">', {_district()},
    '</li></ol><h1>Phòng ', p_name, CASE m WHEN 0 THEN ' NTĐB ' WHEN 1 THEN ' NTCB ' ELSE ' ' END, {_BEDS}, 'PN</h1><span class="text-green fw-bold">', {_SIZE},
    'tr5</span><div><h2>Thông tin mô tả</h2><p>', {_STORY}, '</p><p>Có ', {_BATHS}, ' wc</p><h2>Khác</h2><p>không</p></div></body>')"""
_MOGI = f"""concat('<div class="title"><h1>Nhà trọ ', p_name, '</h1></div><div class="price">', {_SIZE}, '00 nghìn</div><div class="main-info"><div class="address">', CAST(k AS STRING), ' A, Phường 2, ', {_district()}, ', ', {_PLACE},
    '</div></div><div class="info-attr"><span>Mã BĐS</span><span>', CAST(k AS STRING), '</span></div><div class="info-attr"><span>Diện tích sử dụng</span><span>', {_AREA}, ',5 m2</span></div><div class="info-attr"><span>Phòng ngủ</span><span>',
    {_BEDS}, '</span></div><div class="info-attr"><span>Toilet</span><span>', {_BATHS}, '</span></div><div class="info-attr"><span>Nội thất</span><span>', {_LEVEL}, '</span></div><script>var catLv3 = ''Nhà trọ'';</script><iframe data-src="https://maps/embed/v1?q=',
    {_SPOT.format(whole="'10'")}, ',', {_SPOT.format(whole="'106'")}, '"></iframe><div class="info-content-body">', {_STORY}, '</div>')"""
_NHATOT = f"""concat('<script id="__NEXT_DATA__">{{"props": {{"pageProps": {{"initialState": {{"adView": {{"adInfo": {{"ad": {{"list_id": ', CAST(k AS STRING), ', "subject": "Nhà ', p_name, '", "price": ', {_SIZE}, '00000, "size": ', {_AREA},
    ', "region_name": "', {_PLACE}, '", "area_name": "', {_district()}, '", "ward_name": "P. ', {_N}, '", "rooms": ', {_BEDS}, ', "toilets": ', {_BATHS}, ', "latitude": ', {_SPOT.format(whole="'21'")}, ', "longitude": ', {_SPOT.format(whole="'105'")},
    ', "category_name": "Nhà riêng", "body": "', {_STORY}, '"}}, "ad_params": {{"address": {{"value": "', CAST(k AS STRING), ' Tràng Tiền"}}, "furnishing_sell": {{"value": "', {_LEVEL}, '"}}}}}}}}}}}}}}}}</script>')"""
#: One page in 25 is empty, one in 10 was not found, and one in 30 is of a source that nobody parses.
_HTML = f"CASE WHEN k % 25 = 7 THEN ' ' WHEN k % 4 = 0 THEN {_BATDONGSAN} WHEN k % 4 = 1 THEN {_PHONGTRO} WHEN k % 4 = 2 THEN {_MOGI} ELSE {_NHATOT} END"
_FROM = f"""SELECT *, CASE WHEN k % 30 = 4 THEN 'zillow' ELSE {_SOURCE} END AS source, CASE WHEN k % 10 = 3 THEN 404 ELSE 200 END AS status, concat('https://x/tin-', CAST(k AS STRING)) AS url
    FROM (SELECT p_partkey AS k, CAST(floor(p_partkey / 4) AS BIGINT) % 3 AS m, p_name, p_size FROM part)"""


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, html, source, status): a listing page for each row of ``part``."""
    part = table(spark, sf_dir, "part").selectExpr("p_partkey AS k", "CAST(floor(p_partkey / 4) AS BIGINT) % 3 AS m", "p_name", "p_size")
    known = F.when(F.col("k") % 30 == 4, "zillow").otherwise(F.expr(_SOURCE))
    return part.select(F.expr("concat('https://x/tin-', CAST(k AS STRING))").alias("url"), F.expr(_HTML).alias("html"), known.alias("source"), F.when(F.col("k") % 10 == 3, 404).otherwise(200).alias("status"))


def parsed_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every silver field of a page for each row of ``part``, outcomes of unsound pages included."""
    pages = listing_pages(spark, sf_dir)
    bronze = bronze_records(pages, F.col("source"), F.col("status"), F.lit(CRAWLED), F.lit(1.0), "panel")
    return parse_bronze(bronze, DAY).withColumn("amenities", F.size("amenities"))


def listing_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a page for each row of ``part`` holds as JSON, of an application or as JSON-LD, by variant paths alone."""
    html = F.col("html")
    pages = listing_pages(spark, sf_dir).where(F.col("source").isin("batdongsan", "phongtro123", "nhatot"))
    told = pages.select("url", "source", F.when(F.col("source") == "nhatot", app_fields(html)).otherwise(linked_fields(html)).alias("f")).select("url", "source", "f.*")
    return told.select(
        "url", "source", "native_id", strip_pii(F.col("title")).alias("title"), F.coalesce(parse_price(F.col("price_text")), F.col("price_number").try_cast("double").cast("long")).alias("rent"),
        F.col("area_number").try_cast("double").alias("area"), normalise_province(F.col("province")).alias("province"), normalise_district(F.col("district")).alias("district"), "ward", "address",
        F.col("latitude").try_cast("double").alias("latitude"), F.col("longitude").try_cast("double").alias("longitude"), F.md5(strip_pii(F.col("description"))).alias("story_md5"),
        F.col("bedrooms").try_cast("int").alias("bedrooms"), F.col("bathrooms").try_cast("int").alias("bathrooms"),
    )


QUERIES = {"parsed_listings": parsed_listings, "listing_json": listing_json}

ORACLE_SQL = {
    "parsed_listings": f"""WITH p AS ({_FROM}), e AS (SELECT *, {_HTML} AS html,
            CASE WHEN status <> 200 THEN 'http_status: 404' WHEN source = 'zillow' THEN 'unknown source: zillow' WHEN k % 25 = 7 THEN 'ParserError: empty document' END AS parse_error FROM p),
        f AS (SELECT *, parse_error IS NULL AS parse_ok FROM e)
        SELECT source || ':tin-' || k AS listing_id, source, url, '{CRAWLED}' AS crawl_ts, DATE '{DAY}' AS crawl_date,
            CASE WHEN parse_ok THEN trim(CASE source WHEN 'batdongsan' THEN 'Căn hộ ' || p_name WHEN 'phongtro123' THEN 'Phòng ' || p_name || [' NTĐB ', ' NTCB ', ' '][m + 1] || (k % 5) || 'PN' WHEN 'mogi' THEN 'Nhà trọ ' || p_name ELSE 'Nhà ' || p_name END) END AS title,
            CASE WHEN parse_ok THEN CAST(p_size AS BIGINT) * CASE source WHEN 'batdongsan' THEN 1000000 WHEN 'phongtro123' THEN 1000000 ELSE 100000 END + CASE WHEN source = 'phongtro123' THEN 500000 ELSE 0 END END AS asking_rent_vnd,
            CASE WHEN parse_ok THEN CAST(10 + k % 90 AS DOUBLE) + CASE WHEN source = 'mogi' THEN 0.5 ELSE 0 END END AS area_sqm,
            CASE WHEN parse_ok THEN CAST(k % 5 AS INTEGER) END AS bedrooms, CASE WHEN parse_ok THEN CAST(1 + k % 3 AS INTEGER) END AS bathrooms,
            CASE WHEN parse_ok THEN CASE source WHEN 'batdongsan' THEN 'apartment' WHEN 'phongtro123' THEN 'apartment' WHEN 'mogi' THEN 'room' ELSE 'house' END END AS property_type,
            CASE WHEN parse_ok THEN ['HCM', 'HN', 'BD'][m + 1] END AS province,
            CASE WHEN parse_ok THEN CASE m WHEN 0 THEN 'binh thanh' WHEN 1 THEN 'nha be' ELSE CAST(1 + k % 12 AS VARCHAR) END END AS district,
            CASE WHEN parse_ok AND source = 'nhatot' THEN 'P. ' || (1 + k % 12) END AS ward,
            CASE WHEN parse_ok THEN CASE source WHEN 'batdongsan' THEN k || ' Lê Lợi' WHEN 'phongtro123' THEN k || ' Phố Huế' WHEN 'mogi' THEN k || ' A, Phường 2, ' || {_district()} || ', ' || {_PLACE} ELSE k || ' Tràng Tiền' END END AS address,
            CASE WHEN parse_ok THEN CASE source WHEN 'nhatot' THEN CAST('21.' || (10 + k % 90) AS DOUBLE) WHEN 'phongtro123' THEN NULL ELSE CAST('10.' || (10 + k % 90) AS DOUBLE) END END AS latitude,
            CASE WHEN parse_ok THEN CASE source WHEN 'nhatot' THEN CAST('105.' || (10 + k % 90) AS DOUBLE) WHEN 'phongtro123' THEN NULL ELSE CAST('106.' || (10 + k % 90) AS DOUBLE) END END AS longitude,
            CASE WHEN parse_ok AND NOT (source = 'phongtro123' AND m = 2) THEN ['full', 'basic', 'none'][m + 1] ELSE 'unknown' END AS furnishing, 0 AS amenities,
            CASE WHEN parse_ok THEN {_STORED} || CASE WHEN source = 'phongtro123' THEN chr(10) || 'Có ' || (1 + k % 3) || ' wc' ELSE '' END END AS description_clean,
            CAST(NULL AS DATE) AS posted_date, CAST(NULL AS INTEGER) AS image_count, 'sha256:' || sha256(html) AS content_hash, status = 200 AS is_active, parse_ok, parse_error, '{DAY}' AS dt FROM f""",
    "listing_json": f"""WITH p AS ({_FROM}), j AS (SELECT *, k % 25 <> 7 AS sound, source = 'batdongsan' AS a, source = 'phongtro123' AS b, source = 'nhatot' AS d FROM p WHERE source IN ('batdongsan', 'phongtro123', 'nhatot'))
        SELECT url, source, CASE WHEN sound AND NOT b THEN CAST(k AS VARCHAR) END AS native_id, CASE WHEN sound AND a THEN 'Căn hộ ' || p_name WHEN sound AND d THEN 'Nhà ' || p_name ELSE '' END AS title,
            CASE WHEN sound AND a THEN CAST(p_size AS BIGINT) * 1000000 WHEN sound AND d THEN CAST(p_size AS BIGINT) * 100000 END AS rent, CASE WHEN sound THEN CAST(10 + k % 90 AS DOUBLE) END AS area,
            CASE WHEN sound AND NOT a THEN ['HCM', 'HN', 'BD'][m + 1] END AS province,
            CASE WHEN sound AND NOT b THEN CASE m WHEN 0 THEN 'binh thanh' WHEN 1 THEN 'nha be' ELSE CAST(1 + k % 12 AS VARCHAR) END END AS district, CASE WHEN sound AND d THEN 'P. ' || (1 + k % 12) END AS ward,
            CASE WHEN sound THEN k || CASE WHEN a THEN ' Lê Lợi' WHEN b THEN ' Phố Huế' ELSE ' Tràng Tiền' END END AS address,
            CASE WHEN sound AND a THEN CAST('10.' || (10 + k % 90) AS DOUBLE) WHEN sound AND d THEN CAST('21.' || (10 + k % 90) AS DOUBLE) END AS latitude,
            CASE WHEN sound AND a THEN CAST('106.' || (10 + k % 90) AS DOUBLE) WHEN sound AND d THEN CAST('105.' || (10 + k % 90) AS DOUBLE) END AS longitude,
            md5(CASE WHEN sound AND NOT b THEN {_STORED} ELSE '' END) AS story_md5, CASE WHEN sound AND NOT b THEN CAST(k % 5 AS INTEGER) END AS bedrooms, CASE WHEN sound AND NOT b THEN CAST(1 + k % 3 AS INTEGER) END AS bathrooms FROM j""",
}

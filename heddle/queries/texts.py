"""Text, gate, page and duplicate queries."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heddle.functions import text as ft, vocab, web
from heddle.functions.composition import decomposed, nfc
from heddle.operators import dedupe, gates
from heddle.sources import table
from heddle.sources.bronze import bronze_records as to_bronze

# Raw words as listings write them, dealt to the rows of a table by key and filled with its numbers; each is one
# expression that is SQL for Spark and for DuckDB alike.
_MILLIONS, _THOUSANDS = "CAST(CAST(floor(p_retailprice / 100) AS BIGINT) AS STRING)", "CAST(CAST(floor(p_retailprice) AS BIGINT) AS STRING)"
_TENTHS = "CAST(CAST(floor(p_retailprice) AS BIGINT) % 10 AS STRING)"
PRICES = [
    f"concat({_MILLIONS}, 'tr', {_TENTHS})", f"concat({_MILLIONS}, '.', {_TENTHS}, ' triệu/tháng')", f"concat({_MILLIONS}, 'tr', {_THOUSANDS})", f"concat({_MILLIONS}, ',500,000 đ')", f"concat({_THOUSANDS}, ' nghìn')",
    "'Thỏa thuận'", "''", "CAST(NULL AS STRING)", f"concat({_MILLIONS}, ' triệu ', CAST(p_size AS STRING), ' phòng')", f"concat({_THOUSANDS}, ' ngàn')", f"concat({_THOUSANDS}, 'k')",
    f"concat('12', {_THOUSANDS})", f"concat({_MILLIONS}, '.234.567')", f"concat({_MILLIONS}, ' TRIỆU')", f"concat({_MILLIONS}, ',', {_TENTHS}, ' tr')",
]
_SIZE = "CAST(p_size AS STRING)"
AREAS = [f"concat({_SIZE}, ' m2')", f"concat({_SIZE}, ',5m²')", f"concat('dt ', {_SIZE}, '.25 M2 x')", "'không rõ'", "''", "CAST(NULL AS STRING)", f"concat({_SIZE}, '000m2 đất')", "p_name"]
_SPELLINGS = ["Hồ Chí Minh", "TP.HCM", "Tp. Hồ Chí Minh", "TPHCM", "Sài Gòn", "Hà Nội", "tp hà nội", "Đà Nẵng", "Tỉnh Bình Dương", "Đồng Nai", "Thành phố Cần Thơ", "Huế", ""]
PROVINCES = [*(f"'{name}'" for name in _SPELLINGS), "c_name", "CAST(NULL AS STRING)"]
_NUMBER, _WARDS = "CAST(c_nationkey AS STRING)", ["Q. Bình Thạnh", "Bình Thạnh", "Huyện Nhà Bè", "Thành phố Thủ Đức", "TP. Thủ Đức", "Thị xã Dĩ An", "Gò Vấp", "Quận Gò Vấp", "", "Quận "]
DISTRICTS = [f"concat('Quận ', {_NUMBER})", f"concat('Q.', {_NUMBER})", *(f"'{name}'" for name in _WARDS), "CAST(NULL AS STRING)"]


def _dealt(key: str, cases: list[str]) -> str:
    return f"CASE {key} % {len(cases)} " + " ".join(f"WHEN {i} THEN {case}" for i, case in enumerate(cases)) + " END"


def _raw(spark: SparkSession, sf_dir: str, name: str, key: str, cases: list[str]) -> DataFrame:
    return table(spark, sf_dir, name).select(key, F.expr(_dealt(key, cases)).alias("raw"))


def price_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts' prices written in fifteen ways and read."""
    return _raw(spark, sf_dir, "part", "p_partkey", PRICES).select("p_partkey", "raw", ft.parse_price(F.col("raw")).alias("vnd"))


def area_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "part", "p_partkey", AREAS).select("p_partkey", "raw", ft.parse_area(F.col("raw")).alias("sqm"))


def province_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "customer", "c_custkey", PROVINCES).select("c_custkey", "raw", ft.normalise_province(F.col("raw")).alias("province"))


def district_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "customer", "c_custkey", DISTRICTS).select("c_custkey", "raw", ft.normalise_district(F.col("raw")).alias("district"))


def _vocabulary(maps: dict) -> list[tuple]:
    known = [(s, k) for s, words in maps.items() for k in words]
    return known + [(s, f" {k.upper()} ") for s, k in known] + [(s, w) for s in maps for w in ("lạ", "", None, "full", "unknown")] + [("other", "Căn hộ")]


def _worded(spark: SparkSession, sf_dir: str, maps: dict) -> DataFrame:
    """Parts with a source's word each, dealt by key; a sixth of the words are replaced by the part's type."""
    cases = _vocabulary(maps)
    words = spark.createDataFrame([(i, *case) for i, case in enumerate(cases)], "n int, source string, word string")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", (F.col("p_partkey") % len(cases)).cast("int").alias("n"))
    raw = F.when(F.col("p_partkey") % 6 == 0, F.col("p_type")).otherwise(F.col("word"))
    return parts.join(F.broadcast(words), "n").select("p_partkey", "source", raw.alias("raw"))  # the fixed vocabulary


def furnishing_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _worded(spark, sf_dir, vocab.FURNISHING)
    return rows.select("p_partkey", "source", "raw", ft.normalise_furnishing(F.col("source"), F.col("raw")).alias("furnishing"))


def property_type_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _worded(spark, sf_dir, vocab.PROPERTY_TYPE)
    return rows.select("p_partkey", "source", "raw", ft.normalise_property_type(F.col("source"), F.col("raw")).alias("property_type"))


def unmapped_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _worded(spark, sf_dir, vocab.FURNISHING)
    return ft.unmapped(rows, "source", "raw", ft.normalise_furnishing(F.col("source"), F.col("raw")), "unknown")


def pii_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(ft.strip_pii(F.col("text"))).alias("clean_md5"))


def composed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts composed again after their letters were parted from their marks, and how many marks there were."""
    apart = decomposed(F.col("text"))
    rows = table(spark, sf_dir, "documents").select("doc_id", apart.alias("apart"), F.length("text").alias("chars"))
    return rows.select("doc_id", F.md5(nfc(F.col("apart"))).alias("nfc_md5"), (F.length("apart") - F.col("chars")).alias("marks"))


def pii_gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.pii_leaks(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def pii_email_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emails and phone numbers left, before and after stripping, by source."""
    docs = table(spark, sf_dir, "documents").select("source", "text", ft.strip_pii(F.col("text")).alias("clean"))
    return docs.groupBy("source").agg(
        F.count("*").alias("rows"), F.count_if(F.col("text").rlike(ft.EMAIL)).alias("emails"), F.count_if(F.col("text").rlike(ft.PHONE)).alias("phones"),
        F.count_if(F.col("clean").rlike(ft.EMAIL)).alias("emails_left"), F.count_if(F.col("clean").rlike(ft.PHONE)).alias("phones_left"),
    )


def quality_gate_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's metrics with orders and their lines as listings."""
    orders = table(spark, sf_dir, "orders")
    listing = orders.select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("title"),
        (F.col("o_totalprice") * 1000).cast("long").alias("asking_rent_vnd"), (F.col("o_custkey") % 1200).cast("double").alias("area_sqm"),
        F.element_at(F.array(*map(F.lit, ("HCM", "HN", None, "??"))), (F.col("o_orderkey") % 4 + 1).cast("int")).alias("province"),
        F.element_at(F.array(*map(F.lit, ("full", "basic", "odd", None))), (F.col("o_orderkey") % 4 + 1).cast("int")).alias("furnishing"),
        F.to_date("o_orderdate").alias("crawl_date"), (F.col("o_orderstatus") != "P").alias("is_active"), (F.col("o_orderstatus") == "O").alias("parse_ok"),
    )
    from datetime import date

    return gates.gate_metrics(listing, date(1998, 10, 3))


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


def parse_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as fetched, those of quality 1 as parsed, by source."""
    joined = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    return joined.groupBy("source").agg(F.count("*").alias("fetched"), F.count_if(F.col("quality") == 1).alias("parsed"), F.round(F.try_divide(F.count_if(F.col("quality") == 1), F.count("*")), 6).alias("parse_rate"))


def missing_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heddle.operators.evaluation import missing_shares as shares

    joined = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return shares(joined, "source", ["quality", "toxic"])


def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id", web.first_match(html, r'<html[^>]*\slang="([^"]*)"').alias("lang"), web.tag_text(html, "title").alias("title"), web.tag_text(html, "h1").alias("h1"),
        F.md5(web.visible_text(html)).alias("text_md5"), F.length(web.visible_text(html)).alias("text_chars"),
    )


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(web.links(F.col("html"))).alias("place", "target"))


def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", web.url_host(url).alias("host"), web.url_path(url).alias("path"), web.url_param(url, "page").alias("page"), web.url_param(url, "utm_source").alias("utm_source"),
        web.last_segment(url).alias("last_segment"), web.first_match(url, r"/(\d+)").alias("number"),
    )


def sitemap_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urls as sitemaps by host and as an index of them, read back with a pattern."""
    pages = table(spark, sf_dir, "pages").select(web.url_host(F.col("url")).alias("host"), F.regexp_replace("url", "&", "&amp;").alias("url"))
    entry = F.concat(F.lit("<url><loc> "), F.col("url"), F.lit(" </loc></url>"))
    sets = pages.groupBy("host").agg(F.array_join(F.collect_list(entry), "").alias("body"))
    xml = F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.col("body"), F.lit("</urlset>"))
    index = F.concat(F.lit("<sitemapindex><sitemap><loc>https://"), F.col("host"), F.lit("/sitemap.xml</loc></sitemap></sitemapindex>"))
    return web.sitemap_urls(sets.select(F.explode(F.array(xml, index)).alias("xml")), "xml", "/en/")


def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"), F.get_json_object("props", "$.deep.none").alias("nothing"))


def bronze_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    made = to_bronze(pages, web.url_host(F.col("url")), F.lit(200), F.lit("2026-01-01T00:00:00Z"), F.col("page_id") / 2, "discovery")
    return made.drop("html_gz_b64")


def _probe_status() -> Column:
    return F.element_at(F.array(*map(F.lit, (200, 200, 404, 503))), (F.col("page_id") % 4 + 1).cast("int"))


def _probe_page() -> Column:
    return F.when(F.col("page_id") % 8 == 0, F.concat("html", F.lit("<b>Tin ĐÃ HẾT HẠN</b>"))).otherwise(F.col("html"))


def probe_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    present, reason = web.classify_probe(_probe_status(), _probe_page())
    return table(spark, sf_dir, "pages").select("page_id", present.alias("is_present"), reason.alias("reason"))


def silver_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parse job's ladder of outcomes over pages with made-up statuses and sources, counted."""
    from heddle.operators.pages import parse_bronze

    source = F.element_at(F.array(*map(F.lit, ("batdongsan", "mogi", "nhatot", "phongtro123", "zillow"))), (F.col("page_id") % 5 + 1).cast("int"))
    made = to_bronze(table(spark, sf_dir, "pages"), source, _probe_status(), F.lit("2026-01-02T03:04:05Z"), F.lit(1.0), "panel")
    return parse_bronze(made, "2026-01-02").groupBy("source", "is_active", "parse_ok", "parse_error", "crawl_date").agg(F.count("*").alias("rows"))


def block_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ft.block_key(F.nullif(F.col("p_brand"), F.lit("Brand#2")), F.col("p_type"), F.col("p_size") / 4, (F.col("p_retailprice") * 1000).cast("long"))
    return table(spark, sf_dir, "part").select("p_partkey", key.alias("block"))


def shingle_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    grams = ft.char_shingles(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(grams).alias("shingles"), F.size(F.array_distinct(grams)).alias("distinct_shingles"))


def blocked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents in blocks of one language and about one length."""
    block = F.concat_ws("|", F.coalesce("lang", F.lit("")), F.round(F.length("text"), -2).cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", "text", block.alias("block"))


def neardup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of distinct shingle sets of a block, by their least documents."""
    from heddle.plans.durable import Scratch

    scratch, docs = Scratch(spark, "pairs"), (blocked_documents(spark, sf_dir), "doc_id", "block", "text")
    _, sets = dedupe.set_summaries(*docs, scratch)
    pairs = dedupe.similar_texts(*docs, sets, scratch)
    return pairs.select(F.least("node_a", "node_b").alias("id_a"), F.greatest("node_a", "node_b").alias("id_b"), "shared", (F.col("size_a") + F.col("size_b") - F.col("shared")).alias("united"))


def dedupe_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.near_duplicate_clusters(blocked_documents(spark, sf_dir), "doc_id", "block", "text")


def duplicate_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.duplicate_rate(exact_dup_clusters(spark, sf_dir))


def exact_dup_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.exact_clusters(table(spark, sf_dir, "documents"), "doc_id", "text")


def duplicate_rate_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = table(spark, sf_dir, "documents").select("doc_id", "source")
    return dedupe.duplicate_rate(exact_dup_clusters(spark, sf_dir).join(sources, "doc_id"), "source")


def cluster_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty clusters of copies to look at."""
    return dedupe.cluster_sample(exact_dup_clusters(spark, sf_dir), 20)


def amenity_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source with each amenity's words in them."""
    flagged = table(spark, sf_dir, "documents").select("source", *ft.amenity_flags(F.col("text")))
    return flagged.groupBy("source").agg(F.count("*").alias("rows"), *(F.sum(f"has_{name}").alias(f"has_{name}") for name in vocab.AMENITIES))


def neardup_pairs_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate pairs of distinct shingle sets of a block of whole documents, by MinHash."""
    from heddle.plans.durable import Scratch

    _, sets = dedupe.shingle_sets(blocked_documents(spark, sf_dir), "doc_id", "block", "text")
    return dedupe.lsh_set_pairs(sets, Scratch(spark, "lsh"))


QUERIES = {
    "price_cases": price_cases, "area_cases": area_cases, "province_cases": province_cases, "district_cases": district_cases, "furnishing_cases": furnishing_cases,
    "property_type_cases": property_type_cases, "unmapped_words": unmapped_words, "pii_strip": pii_strip, "composed_documents": composed_documents, "pii_gate_report": pii_gate_report, "pii_email_audit": pii_email_audit,
    "quality_gate_metrics": quality_gate_metrics, "duplicate_keys": duplicate_keys, "parse_rate": parse_rate, "missing_shares": missing_shares, "page_fields": page_fields,
    "page_links": page_links, "url_parts": url_parts, "sitemap_urls": sitemap_urls, "event_props": event_props, "bronze_records": bronze_records, "probe_classify": probe_classify,
    "silver_status": silver_status, "block_keys": block_keys, "shingle_stats": shingle_stats, "neardup_pairs": neardup_pairs, "dedupe_clusters": dedupe_clusters,
    "duplicate_rate": duplicate_rate, "exact_dup_clusters": exact_dup_clusters, "duplicate_rate_by_source": duplicate_rate_by_source,
    "cluster_sample": cluster_sample, "amenity_flags": amenity_flags, "neardup_pairs_lsh": neardup_pairs_lsh,
}

def _raw_sql(name: str, key: str, cases: list[str]) -> str:
    return f"(SELECT {key}, {_dealt(key, cases)} AS raw FROM {name})"


_NORMAL = r"lower(trim(regexp_replace(coalesce(raw, ''), '\s+', ' ', 'g')))"
_FOLDED = f"replace(replace(strip_accents({_NORMAL}), 'đ', 'd'), 'Đ', 'd')"
_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in vocab.PROVINCES.items())
_EMAIL, _SOCIAL, _PHONE = ft.EMAIL, ft.SOCIAL, ft.PHONE
_CLEAN = f"regexp_replace(regexp_replace(regexp_replace(text, '{_EMAIL}', '<EMAIL>', 'g'), '{_SOCIAL}', '<SOCIAL>', 'gi'), '{_PHONE}', '<PHONE>', 'g')"


def _vocabulary_sql(maps: dict, name: str, default: str, levels: tuple = ()) -> str:
    q = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    dealt = _vocabulary(maps)
    cases = ", ".join(f"({i}, {q(s)}, {q(r)})" for i, (s, r) in enumerate(dealt))
    words = ", ".join(f"({q(s)}, {q(k)}, {q(v)}, {i})" for i, (s, k, v) in enumerate((s, k, v) for s, w in maps.items() for k, v in w.items()))
    inside = f"CASE WHEN lower(trim(c.raw)) IN ({', '.join(map(q, levels))}) THEN lower(trim(c.raw)) END, " if levels else ""
    return f"""WITH k AS (SELECT * FROM (VALUES {cases}) AS v(i, source, word)),
        c AS (SELECT p_partkey AS n, source, CASE WHEN p_partkey % 6 = 0 THEN p_type ELSE word END AS raw FROM part JOIN k ON i = p_partkey % {len(dealt)}), w AS (SELECT * FROM (VALUES {words}) AS v(s, k, v, i)),
        m AS (SELECT c.n, any_value(c.source) AS source, any_value(c.raw) AS raw, arg_min(w.v, w.i) FILTER (WHERE w.k = c.raw) AS own, arg_min(w.v, w.i) AS loose
            FROM c LEFT JOIN w ON w.s = c.source AND lower(trim(w.k)) = lower(trim(c.raw)) GROUP BY c.n)
        SELECT c.n AS p_partkey, c.source, c.raw, coalesce(own, loose, {inside}'{default}') AS {name} FROM m AS c"""


_FURNISHED = _vocabulary_sql(vocab.FURNISHING, "furnishing", "unknown", vocab.FURNISHING_LEVELS)
_STATUS = "CASE page_id % 4 WHEN 2 THEN 404 WHEN 3 THEN 503 ELSE 200 END"
_TAGLESS = r"regexp_replace({}, '(?s)<[^>]*>', '{}', 'g')"
_VISIBLE = r"trim(regexp_replace(" + _TAGLESS.format(r"regexp_replace(html, '(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>', ' ', 'g')", " ") + r", '\s+', ' ', 'g'))"
_BLOCK = "coalesce(lang, '') || '|' || CAST(CAST(round(length(text) / 100.0) * 100 AS INT) AS VARCHAR)"
_GRAMS = "list_transform(range(1, greatest(len(ch) - 1, 1)), lambda i: ch[i] || ch[i + 1] || ch[i + 2])"
_SETS = f"""d AS (SELECT doc_id, block, list_sort(list_distinct({_GRAMS})) AS g FROM (SELECT doc_id, {_BLOCK} AS block, string_split(text, '') AS ch FROM documents WHERE length(text) >= 3)),
    s AS (SELECT block, g, min(doc_id) AS node FROM d GROUP BY block, g),
    p AS (SELECT a.node AS a, b.node AS b, len(list_intersect(a.g, b.g)) AS shared, len(a.g) AS na, len(b.g) AS nb FROM s a JOIN s b ON a.block = b.block AND a.node < b.node
        AND len(a.g) * 100 >= len(b.g) * 80 AND len(b.g) * 100 >= len(a.g) * 80),
    pairs AS (SELECT a, b, shared, na + nb - shared AS united FROM p WHERE shared * 100 >= (na + nb - shared) * 80)"""
_EXACT = """keyed AS (SELECT doc_id, sha256(lower(trim(coalesce(text, '')))) AS k FROM documents),
    clusters AS (SELECT doc_id, min(doc_id) OVER w AS canonical_id, count(*) OVER w AS cluster_size, doc_id = min(doc_id) OVER w AS is_canonical FROM keyed WINDOW w AS (PARTITION BY k))"""


def _tag(tag: str) -> str:
    return r"trim(regexp_replace(" + _TAGLESS.format(rf"nullif(regexp_extract(html, '(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>', 1), '')", "") + r", '\s+', ' ', 'g'))"


ORACLE_SQL = {
    "price_cases": rf"""WITH t AS (SELECT p_partkey, raw, {_NORMAL} AS t FROM {_raw_sql('part', 'p_partkey', PRICES)}),
        m AS (SELECT p_partkey, raw, t, regexp_extract(t, '(\d+(?:[.,]\d+)?)\s*tr(?:iệu)?\s*(\d+)?', 1) AS w, regexp_extract(t, '(\d+(?:[.,]\d+)?)\s*tr(?:iệu)?\s*(\d+)?', 2) AS f,
            regexp_extract(t, '([\d.,]+)\s*(?:nghìn|ngàn|k)\b', 1) AS k, regexp_replace(regexp_extract(t, '[\d.,]{{7,}}'), '[.,]', '', 'g') AS b FROM t)
        SELECT p_partkey, raw, CASE WHEN contains(t, 'thỏa thuận') OR contains(t, 'thoa thuan') THEN NULL
            WHEN w <> '' AND (contains(w, '.') OR contains(w, ',') OR f = '') THEN CAST(floor(TRY_CAST(replace(w, ',', '.') AS DECIMAL(20, 6)) * 1000000) AS BIGINT)
            WHEN w <> '' THEN TRY_CAST(w AS BIGINT) * 1000000 + TRY_CAST(rpad(f[1:6], 6, '0') AS BIGINT)
            WHEN k <> '' THEN CAST(floor(TRY_CAST(replace(k, ',', '.') AS DECIMAL(20, 6)) * 1000) AS BIGINT) ELSE TRY_CAST(b AS BIGINT) END AS vnd FROM m""",
    "area_cases": rf"SELECT p_partkey, raw, TRY_CAST(replace(regexp_extract({_NORMAL}, '(\d+(?:[.,]\d+)?)\s*m(?:2|²)', 1), ',', '.') AS DOUBLE) AS sqm FROM {_raw_sql('part', 'p_partkey', AREAS)}",
    "province_cases": rf"SELECT c_custkey, raw, CASE trim(regexp_replace({_FOLDED}, '^(?:tp\.?|thanh pho|tinh)\s*', '')) {_CASE} END AS province FROM {_raw_sql('customer', 'c_custkey', PROVINCES)}",
    "district_cases": rf"SELECT c_custkey, raw, nullif(trim(regexp_replace({_FOLDED}, '^(?:quan|huyen|thanh pho|thi xa|tp|q)\s*[.\s]\s*', '')), '') AS district FROM {_raw_sql('customer', 'c_custkey', DISTRICTS)}",
    "furnishing_cases": _FURNISHED,
    "property_type_cases": _vocabulary_sql(vocab.PROPERTY_TYPE, "property_type", "other"),
    "unmapped_words": f"SELECT source, raw, count(*) AS rows FROM ({_FURNISHED}) WHERE raw IS NOT NULL AND trim(raw) <> '' AND furnishing = 'unknown' AND lower(trim(raw)) <> 'unknown' GROUP BY ALL",
    "pii_strip": f"SELECT doc_id, md5({_CLEAN}) AS clean_md5 FROM documents",
    # a letter of one mark becomes one letter without marks, and none of the texts' letters has two
    "composed_documents": "SELECT doc_id, md5(nfc_normalize(text)) AS nfc_md5, CAST(len(list_filter(string_split(nfc_normalize(text), ''), lambda c: strip_accents(c) <> c)) AS INTEGER) AS marks FROM documents",
    "pii_gate_report": f"""SELECT count(*) FILTER (WHERE regexp_matches(coalesce(text, ''), '{_PHONE}') OR regexp_matches(coalesce(lang, ''), '{_PHONE}')) AS leaking_rows,
        count(*) FILTER (WHERE regexp_matches(text, '{_PHONE}')) AS leaks_text, count(*) FILTER (WHERE regexp_matches(lang, '{_PHONE}')) AS leaks_lang FROM documents""",
    "pii_email_audit": f"""SELECT source, count(*) AS rows, count(*) FILTER (WHERE regexp_matches(text, '{_EMAIL}')) AS emails, count(*) FILTER (WHERE regexp_matches(text, '{_PHONE}')) AS phones,
        count(*) FILTER (WHERE regexp_matches({_CLEAN}, '{_EMAIL}')) AS emails_left, count(*) FILTER (WHERE regexp_matches({_CLEAN}, '{_PHONE}')) AS phones_left FROM documents GROUP BY 1""",
    "quality_gate_metrics": """WITH l AS (SELECT nullif(o_orderpriority, '5-LOW') AS title, CAST(trunc(o_totalprice * 1000) AS BIGINT) AS rent, CAST(o_custkey % 1200 AS DOUBLE) AS area, o_orderkey % 4 AS k,
            CAST(o_orderdate AS DATE) AS day, o_orderstatus <> 'P' AS act, o_orderstatus = 'O' AS ok FROM orders)
        SELECT count(*) AS n_rows, count(*) FILTER (WHERE rent NOT BETWEEN 300000 AND 500000000) AS rent_outside, count(*) FILTER (WHERE area NOT BETWEEN 5 AND 1000) AS area_outside,
            count(*) FILTER (WHERE k = 3) AS province_unknown, count(*) FILTER (WHERE k = 2) AS province_missing, count(*) FILTER (WHERE k >= 2) AS furnishing_unknown,
            count(*) FILTER (WHERE day <> DATE '1998-10-03') AS other_days, count(*) FILTER (WHERE act) AS fetched, count(*) FILTER (WHERE NOT act) AS not_fetched,
            count(*) FILTER (WHERE act AND ok) AS parsed, count(*) FILTER (WHERE ok AND title IS NULL AND rent IS NULL AND area IS NULL) AS parsed_empty FROM l""",
    "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "parse_rate": "SELECT source, count(*) AS fetched, count(*) FILTER (WHERE quality = 1) AS parsed, round(count(*) FILTER (WHERE quality = 1) / count(*), 6) AS parse_rate FROM labels JOIN documents USING (doc_id) GROUP BY 1",
    "missing_shares": "SELECT source, count(*) AS rows, round(count(*) FILTER (WHERE quality IS NULL) / count(*), 6) AS null_quality, round(count(*) FILTER (WHERE toxic IS NULL) / count(*), 6) AS null_toxic FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1",
    "page_fields": rf"""SELECT page_id, nullif(regexp_extract(html, '<html[^>]*\slang="([^"]*)"', 1), '') AS lang, {_tag("title")} AS title, {_tag("h1")} AS h1,
        md5({_VISIBLE}) AS text_md5, CAST(length({_VISIBLE}) AS INTEGER) AS text_chars FROM pages""",
    "page_links": rf"""WITH l AS (SELECT page_id, list_transform(regexp_extract_all(html, '{web.LINK.replace("'", "''")}', 1), lambda x: regexp_replace(x, '^["'']|["'']$', '', 'g')) AS t FROM pages)
        SELECT page_id, CAST(i AS INTEGER) AS place, t[i + 1] AS target FROM (SELECT page_id, t, unnest(range(0, len(t))) AS i FROM l)""",
    "url_parts": r"""SELECT page_id, nullif(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1), '') AS host, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path,
        nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm_source,
        string_split(regexp_replace(url, '/+$', ''), '/')[-1] AS last_segment, nullif(regexp_extract(url, '/(\d+)', 1), '') AS number FROM pages""",
    "sitemap_urls": "SELECT url FROM pages WHERE contains(url, '/en/') UNION ALL SELECT DISTINCT 'https://' || regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) || '/sitemap.xml' FROM pages",
    "event_props": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.deep.none') AS nothing FROM events",
    "bronze_records": r"""SELECT h || ':' || string_split(regexp_replace(url, '/+$', ''), '/')[-1] AS listing_id, h AS source, url, '2026-01-01T00:00:00Z' AS crawl_ts, CAST(200 AS INTEGER) AS http_status,
        'sha256:' || sha256(coalesce(html, '')) AS content_hash, CAST(page_id / 2 AS DOUBLE) AS fetch_ms, 'discovery' AS crawl_kind FROM (SELECT *, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS h FROM pages)""",
    "probe_classify": f"""WITH p AS (SELECT page_id, {_STATUS} AS st, CASE WHEN page_id % 8 = 0 THEN html || '<b>Tin ĐÃ HẾT HẠN</b>' ELSE html END AS h FROM pages),
        g AS (SELECT page_id, st, regexp_matches(coalesce(h, ''), '(?i){"|".join(vocab.REMOVAL_PHRASES)}') AS gone FROM p)
        SELECT page_id, st = 200 AND NOT gone AS is_present, CASE WHEN st <> 200 THEN 'http_status:' || st WHEN gone THEN 'soft_delete' END AS reason FROM g""",
    "silver_status": f"""WITH p AS (SELECT {_STATUS} AS st, ['batdongsan', 'mogi', 'nhatot', 'phongtro123', 'zillow'][page_id % 5 + 1] AS source FROM pages),
        e AS (SELECT source, st = 200 AS is_active, CASE WHEN st <> 200 THEN 'http_status: ' || st WHEN source = 'zillow' THEN 'unknown source: zillow' END AS parse_error FROM p)
        SELECT source, is_active, parse_error IS NULL AS parse_ok, parse_error, DATE '2026-01-02' AS crawl_date, count(*) AS rows FROM e GROUP BY ALL""",
    "block_keys": """SELECT p_partkey, concat_ws('|', coalesce(nullif(p_brand, 'Brand#2'), ''), coalesce(p_type, ''), CAST(CAST(round(p_size / 4) AS BIGINT) AS VARCHAR) || '.0',
        CAST(CAST(round(trunc(p_retailprice * 1000) / 100000) * 100000 AS BIGINT) AS VARCHAR)) AS block FROM part""",
    "shingle_stats": f"""WITH g AS (SELECT doc_id, {_GRAMS} AS g FROM (SELECT doc_id, string_split(text, '') AS ch FROM documents))
        SELECT doc_id, CAST(len(g) AS INTEGER) AS shingles, CAST(len(list_distinct(g)) AS INTEGER) AS distinct_shingles FROM g""",
    "neardup_pairs": f"WITH {_SETS} SELECT a AS id_a, b AS id_b, CAST(shared AS INTEGER) AS shared, CAST(united AS INTEGER) AS united FROM pairs",
    "dedupe_clusters": f"""WITH RECURSIVE {_SETS}, e AS (SELECT a AS x, b AS y FROM pairs UNION SELECT b, a FROM pairs),
        reach AS (SELECT node AS x, node AS y FROM s UNION SELECT r.x, e.y FROM reach r JOIN e ON e.x = r.y),
        root AS (SELECT x AS node, min(y) AS canonical_id FROM reach GROUP BY 1),
        l AS (SELECT q.doc_id, coalesce(root.canonical_id, q.doc_id) AS canonical_id FROM documents q LEFT JOIN d ON d.doc_id = q.doc_id LEFT JOIN s ON s.block = d.block AND s.g = d.g LEFT JOIN root USING (node))
        SELECT doc_id, canonical_id, count(*) OVER (PARTITION BY canonical_id) AS cluster_size, doc_id = canonical_id AS is_canonical FROM l""",
    "duplicate_rate": f"WITH {_EXACT} SELECT count(*) AS rows, count(*) FILTER (WHERE cluster_size > 1) AS duplicates, round(count(*) FILTER (WHERE cluster_size > 1) / count(*), 6) AS duplicate_rate FROM clusters",
    "exact_dup_clusters": f"WITH {_EXACT} SELECT * FROM clusters",
    "duplicate_rate_by_source": f"""WITH {_EXACT} SELECT source, count(*) AS rows, count(*) FILTER (WHERE cluster_size > 1) AS duplicates,
        round(count(*) FILTER (WHERE cluster_size > 1) / count(*), 6) AS duplicate_rate FROM clusters JOIN documents USING (doc_id) GROUP BY 1""",
    "cluster_sample": f"WITH {_EXACT} SELECT canonical_id, cluster_size FROM clusters WHERE cluster_size > 1 AND is_canonical ORDER BY sha256('look:' || canonical_id), canonical_id LIMIT 20",
    "amenity_flags": "SELECT source, count(*) AS rows, " + ", ".join(f"count(*) FILTER (WHERE regexp_matches(text, '(?i){words}')) AS has_{name}" for name, words in vocab.AMENITIES.items()) + " FROM documents GROUP BY 1",
}

"""Listing pages to fields: a small document tree, and a rule table for each source.

Pages that are JSON are read by variant paths. Trees need more than column
expressions, so other pages are parsed in Arrow batches by the standard library's
parser. What a source's pages hold is stated as data: for
each field the places to look, in order; the first that yields a value wins.
Prices, areas, places and vocabularies stay column expressions over the raw
strings, so that they are the same functions everywhere.
"""

import base64
import gzip
import html.parser
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from urllib.parse import parse_qs, urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from heddle.functions.composition import bound
from heddle.functions.text import iso_date, normalise_district, normalise_furnishing, normalise_property_type, normalise_province, parse_area, parse_price, strip_pii
from heddle.functions.web import json_text, linked_data, script_json

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements before which an open paragraph ends.
ENDS_PARAGRAPH = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())


class Node:
    """An element with its attributes, children and text pieces in order."""

    def __init__(self, tag: str, attributes: dict[str, str], parent: "Node | None"):
        self.tag, self.attributes, self.parent, self.content = tag, attributes, parent, []

    def walk(self) -> Iterator["Node"]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.content) if isinstance(c, Node)]

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                out.append(item)
            else:
                stack += reversed(item.content)
        return unicodedata.normalize("NFC", "".join(out)).strip()

    def is_a(self, step: str) -> bool:
        """Whether the element meets a step such as ``a.big#main[level=2][data-id]``."""
        tag, rest = re.fullmatch(r"([\w-]*)(.*)", step).groups()
        if tag and tag != self.tag:
            return False
        for mark, name, key, value in re.findall(r"([.#])([\w-]+)|\[([\w-]+)(?:=([^\]]*))?\]", rest):
            if mark == "." and name not in self.attributes.get("class", "").split():
                return False
            if mark == "#" and self.attributes.get("id") != name:
                return False
            if key and (key not in self.attributes or value and self.attributes[key] != value):
                return False
        return True

    def all(self, path: str) -> list["Node"]:
        """Elements that meet the path's last step, under ancestors that meet the steps before."""
        *above, last = path.split()
        found = []
        for node in self.walk():
            if node.is_a(last):
                steps, up = list(above), node.parent
                while steps and up is not None:
                    if up.is_a(steps[-1]):
                        steps.pop()
                    up = up.parent
                if not steps:
                    found.append(node)
        return found


class _Builder(html.parser.HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag in ENDS_PARAGRAPH and self.at.tag == "p" or tag == "li" and self.at.tag == "li":
            self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.content.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.content.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.content.append(data)


class ParserError(ValueError):
    """A page that holds no document."""


class Page:
    """A parsed page; every accessor gives None where there is nothing."""

    def __init__(self, text: str, url: str):
        _no_tree(text)
        builder = _Builder()
        builder.feed(text)
        builder.close()
        self.root, self.raw, self.url = builder.root, text, url or ""
        self._labels: dict[str, dict[str, str]] = {}

    def text(self, path: str, place: int = 0) -> str | None:
        found = self.root.all(path)
        return found[place].text() or None if len(found) > place else None

    def attribute(self, path: str, name: str) -> str | None:
        found = self.root.all(path)
        return found[0].attributes.get(name) or None if found else None

    def match(self, pattern: str, where: str | None = None) -> str | None:
        found = re.search(pattern, self.raw if where is None else where)
        return found[1] if found else None

    def linked_data(self, *types: str) -> dict:
        """The first JSON-LD object of one of the types, else an empty one."""
        for script in self.root.all("script[type=application/ld+json]"):
            try:
                data = json.loads(script.text())
            except ValueError:
                continue
            if isinstance(data, dict) and data.get("@type") in types:
                return data
        return {}

    def pairs(self, kind: str) -> dict[str, str]:
        """Label → value of a page's property rows, by how the site lays them out."""
        if kind not in self._labels:
            made: dict[str, str] = {}
            if kind == "cells":
                cells = [c.text() for c in self.root.all("td")]
                made = {a.rstrip(":"): b for a, b in zip(cells, cells[1:]) if a.rstrip(":")}
            else:
                path, label, value = {"spans": ("div.info-attr", "span", "span"), "titled": ("div.re__pr-short-info-item", "span.title", "span.value")}[kind]
                for row in self.root.all(path):
                    names, values = row.all(label), row.all(value)
                    if kind == "spans" and len(names) == 2:
                        made[names[0].text()] = names[1].text()
                    elif kind == "titled" and names and values:
                        made.setdefault(names[0].text().lower(), values[0].text())
            self._labels[kind] = made
        return self._labels[kind]

    def labelled(self, kind: str, label: str) -> str | None:
        """The value of the first label that contains ``label``."""
        return next((v or None for k, v in self.pairs(kind).items() if label in k), None)

    def after_heading(self, word: str) -> str:
        """The paragraphs that follow a second-level heading with ``word``, up to the next one."""
        for heading in self.root.all("h2"):
            if word in heading.text():
                beside = [c for c in heading.parent.content if isinstance(c, Node)]
                following = beside[next(i for i, c in enumerate(beside) if c is heading) + 1 :]
                stop = next((i for i, c in enumerate(following) if c.tag == "h2"), len(following))
                return "\n".join(c.text() for c in following[:stop] if c.tag == "p")
        return ""


def dig(data, *keys):
    """A value deep in JSON, None as soon as a step isn't there."""
    for key in keys:
        data = data.get(key) if isinstance(data, dict) else None
    return data


#: Raw fields of a page, all strings; the vocabularies and numbers follow as expressions.
FIELDS = (
    "native_id", "title", "price_text", "price_number", "area_text", "area_number", "province", "district", "ward", "address", "latitude", "longitude",
    "furnishing", "property_type", "description", "bedrooms", "bathrooms",
)

Rule = Callable[[Page, dict], object]

# Fixed values in the three functions below: the sites' own selectors, labels and JSON keys.


def _batdongsan(page: Page) -> dict:
    ld = page.linked_data("VacationRental")
    place = dig(ld, "ContainsPlace") or {}
    size = dig(place, "FloorSize") or {}
    features = place.get("amenityFeature") or []
    return {
        "native_id": [ld.get("identifier"), page.attribute("#product-detail-web", "prid"), page.match(r"(?i)pr(\d+)", page.url)],
        "title": [ld.get("name"), page.text("h1.re__pr-title")],
        "price_text": [ld.get("priceRange"), page.labelled("titled", "giá")],
        "area_number": [size.get("Value") if size.get("UnitCode") == "SQM" else None],
        "area_text": [page.labelled("titled", "diện tích")],
        "province": [page.text("div.re__breadcrumb a[level=2]")],
        "district": [dig(place, "Address", "@addressRegion"), page.text("div.re__breadcrumb a[level=3]")],
        "property_type": [ld.get("additionalType")],
        "description": [ld.get("description"), page.text("div.re__detail-content"), ""],
        "bedrooms": [place.get("numberOfBedrooms")],
        "bathrooms": [place.get("numberOfBathroomsTotal")],
        "latitude": [ld.get("Latitude")],
        "longitude": [ld.get("Longitude")],
        "furnishing": [f.get("Value") for f in features if isinstance(f, dict) and f.get("Name") == "Furnished"],
        "address": [dig(place, "Address", "@streetAddress"), page.text("span.re__address-line-1")],
    }


def _phongtro123(page: Page) -> dict:
    ld = page.linked_data("Apartment", "SingleFamilyResidence", "House", "Residence")
    title, story = page.text("h1"), page.after_heading("mô tả")
    area = dig(ld, "floorSize", "value")
    named = page.labelled("cells", "Quận huyện")
    level = {"NTĐB": "full", "NT ĐB": "full", "NTCB": "basic", "NT CB": "basic"}
    checked = any(d.all("i.green") and "Đầy đủ nội thất" in d.text() for d in page.root.all("div.text-body"))
    both = f"{title or ''} {story}"
    return {
        "native_id": [page.attribute("body", "data-id"), page.match(r"(?i)-pr(\d+)\.html", page.url)],
        "title": [title],
        "price_text": [page.text("span.text-green.fw-bold")],
        "area_text": [f"{area}m2" if area else None, title],
        "province": [dig(ld, "address", "addressLocality"), page.labelled("cells", "Tỉnh thành")],
        "district": [page.text("ol.breadcrumb li.breadcrumb-item", 2), named and re.sub(r"^Cho thuê \S+\s+", "", named)],
        "property_type": [ld.get("@type"), page.attribute("a.border-orange", "title")],
        "description": [story],
        "bedrooms": [page.match(r"(?i)(\d+)\s*(?:PN|phòng ngủ|p\.?\s*ngủ)", both)],
        "bathrooms": [page.match(r"(?i)(\d+)\s*(?:wc|toilet|phòng tắm|vệ sinh)", story)],
        "furnishing": [*(v for k, v in level.items() if k in (title or "").upper()), "full" if checked else None],
        "address": [dig(ld, "address", "streetAddress"), page.text("td[data-address]"), page.labelled("cells", "Địa chỉ")],
    }


def _mogi(page: Page) -> dict:
    own = page.pairs("spans").get
    address = page.text("div.main-info div.address")
    parts = [p.strip() for p in (address or "").split(",")]
    maps = [urlparse(f.attributes["data-src"]).query for f in page.root.all("iframe[data-src]") if "maps/embed" in f.attributes["data-src"]][:1]
    spot = (parse_qs(maps[0]).get("q", [""])[0] if maps else "").split(",")
    spot = spot if len(spot) == 2 else [None, None]
    return {
        "native_id": [own("Mã BĐS"), page.match(r"-id(\d+)$", page.url), page.match(r'"propertyId"\s*:\s*(\d+)')],
        "title": [page.text("div.title h1")],
        "price_text": [page.text("div.price")],
        "price_number": [page.match(r'"price"\s*:\s*([\d.]+)')],
        "area_text": [own("Diện tích sử dụng")],
        "address": [address],
        "province": [parts[-1]],
        "district": [parts[-2] if len(parts) > 1 else None],
        "property_type": [page.match(r"var\s+catLv3\s*=\s*'([^']+)'"), page.match(r'"postCategory3"\s*:\s*"([^"]+)"')],
        "description": [page.text("div.info-content-body")],
        "bedrooms": [own("Phòng ngủ")],
        "bathrooms": [own("Phòng tắm"), own("Toilet")],
        "latitude": [spot[0]],
        "longitude": [spot[1]],
        "furnishing": [own("Nội thất")],
    }


# The sites' JSON keys.
_AD = ("props", "pageProps", "initialState", "adView", "adInfo", "ad")
_PARAMS = (*_AD[:-1], "ad_params")
APP_PATHS = {
    "native_id": [(*_AD, "list_id")], "title": [(*_AD, "subject")], "price_number": [(*_AD, "price")], "area_number": [(*_AD, "size")], "province": [(*_AD, "region_name")],
    "district": [(*_AD, "area_name")], "ward": [(*_AD, "ward_name")], "address": [(*_PARAMS, "address", "value")], "latitude": [(*_AD, "latitude")], "longitude": [(*_AD, "longitude")],
    "property_type": [(*_PARAMS, "apartment_type", "value"), (*_AD, "category_name")], "description": [(*_AD, "body")], "bedrooms": [(*_AD, "rooms")], "bathrooms": [(*_AD, "toilets")],
    "furnishing": [(*_PARAMS, "furnishing_sell", "value")],
}
#: JSON-LD types of a page's object, and where its fields are.
LINKED_TYPES = ("VacationRental", "Apartment", "SingleFamilyResidence", "House", "Residence")
LINKED_PATHS = {
    "native_id": [("identifier",)], "title": [("name",)], "price_text": [("priceRange",)], "area_number": [("ContainsPlace", "FloorSize", "Value"), ("floorSize", "value")],
    "province": [("address", "addressLocality")], "district": [("ContainsPlace", "Address", "@addressRegion")],
    "address": [("ContainsPlace", "Address", "@streetAddress"), ("address", "streetAddress")], "latitude": [("Latitude",)], "longitude": [("Longitude",)],
    "property_type": [("additionalType",), ("@type",)], "description": [("description",)], "bedrooms": [("ContainsPlace", "numberOfBedrooms")], "bathrooms": [("ContainsPlace", "numberOfBathroomsTotal")],
}


def json_fields(data: Column, paths: dict[str, list[tuple]]) -> Column:
    """A struct of raw fields from a variant: each the first of its paths that has a text."""
    none = F.lit(None).cast("string")
    pick = lambda v, name: F.coalesce(*(json_text(v, *path) for path in paths.get(name, ())), none).alias(name)
    return bound(data, lambda v: F.struct(*(pick(v, name) for name in FIELDS)))


def app_fields(html: Column) -> Column:
    """Raw fields of a page that is one application's state as JSON: variants and paths, no document tree."""
    return json_fields(F.get(script_json(html, "id", "__NEXT_DATA__"), F.lit(0)), APP_PATHS)


def linked_fields(html: Column) -> Column:
    """Raw fields that a page states as JSON-LD, without a document tree."""
    return json_fields(linked_data(html, *LINKED_TYPES), LINKED_PATHS)


#: Sources whose pages are trees, and those whose pages are JSON.
SOURCES = {"batdongsan": _batdongsan, "phongtro123": _phongtro123, "mogi": _mogi}
APPS = ("nhatot",)


def page_fields(source: str, text: str, url: str) -> dict[str, str | None]:
    """The raw fields of a page's tree, each the first value that isn't empty; a page that is JSON has none."""
    page = Page(text, url) if source in SOURCES else _no_tree(text)
    found = SOURCES[source](page) if page else {}
    pick = lambda values: next((str(v) for v in values if v is not None and v != ""), None)
    return {name: pick(found.get(name, ())) for name in FIELDS}


def _no_tree(text: str) -> None:
    if not text or not text.strip():
        raise ParserError("empty document")


class Unreadable(Exception):
    """A payload that is no page; its text says at which step it failed and how."""


def unpack_page(packed: str | None) -> str:
    """The text of a base64, gzipped page."""
    try:
        data = gzip.decompress(base64.b64decode(packed))
    except Exception as error:  # whatever a crawler may have written
        raise Unreadable(f"decompress: {type(error).__name__}") from None
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError as error:
        raise Unreadable(f"decode: {type(error).__name__}") from None


def parse_bronze(bronze: DataFrame, day: str) -> DataFrame:
    """Silver rows: one for each bronze row, whatever is wrong with it.

    ``parse_error`` is ``http_status: N``, ``unknown source: S``, ``decompress:
    E``, ``decode: E`` or the parser's own exception, E or its class in front; pages
    without a single field parse. Trees are built in Python; what a page holds as JSON
    alone is read by variant paths.
    """
    names = ["listing_id", "source", "url", "crawl_ts", "content_hash", "http_status"]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for source, url, status, packed in zip(batch["source"], batch["url"], batch["http_status"], batch["html_gz_b64"]):
                fields, error, html = {}, None, None
                if status != 200:
                    error = f"http_status: {'None' if pd.isna(status) else int(status)}"
                elif source not in SOURCES and source not in APPS:
                    error = f"unknown source: {source}"
                else:
                    try:
                        text = unpack_page(packed)
                        fields = page_fields(source, text, url)
                        html = text if source in APPS else None
                    except Unreadable as problem:
                        error = str(problem)
                    except Exception as problem:  # a page that breaks its parser is a row, not a failed job
                        error = f"{type(problem).__name__}: {problem}"
                out.append([*(fields.get(name) for name in FIELDS), error, html])
            made = pd.DataFrame(out, columns=[*FIELDS, "parse_error", "html"], index=batch.index, dtype=object)
            yield pd.concat([batch[names], made], axis=1)

    kinds = "listing_id string, source string, url string, crawl_ts string, content_hash string, http_status int"
    raw = bronze.select(*names, "html_gz_b64").mapInPandas(rows, f"{kinds}, {', '.join(f'{n} string' for n in FIELDS)}, parse_error string, html string")
    # pages that are JSON are only unpacked there; their fields are expressions
    raw = raw.withColumn("app", F.when(F.col("html").isNotNull(), app_fields(F.col("html"))))
    raw = raw.select(*names, "parse_error", *(F.coalesce(name, f"app.{name}").alias(name) for name in FIELDS))
    ok = F.col("parse_error").isNull()
    return raw.select(
        "listing_id", "source", "url", "crawl_ts",
        iso_date(F.col("crawl_ts")).alias("crawl_date"),
        F.when(F.col("title").isNotNull(), strip_pii(F.col("title"), unicode=True)).alias("title"),
        F.coalesce(parse_price(F.col("price_text")), F.col("price_number").try_cast("double").cast("long")).alias("asking_rent_vnd"),
        F.coalesce(F.col("area_number").try_cast("double"), parse_area(F.col("area_text"))).alias("area_sqm"),
        F.col("bedrooms").try_cast("int").alias("bedrooms"), F.col("bathrooms").try_cast("int").alias("bathrooms"),
        F.when(ok, normalise_property_type(F.col("source"), F.col("property_type"))).alias("property_type"),
        normalise_province(F.col("province")).alias("province"), normalise_district(F.col("district")).alias("district"), "ward",
        F.when(F.col("address").isNotNull(), strip_pii(F.col("address"), unicode=True)).alias("address"),
        F.col("latitude").try_cast("double").alias("latitude"), F.col("longitude").try_cast("double").alias("longitude"),
        normalise_furnishing(F.col("source"), F.col("furnishing")).alias("furnishing"),
        F.array().cast("array<string>").alias("amenities"),
        F.when(F.col("description").isNotNull(), strip_pii(F.col("description"), unicode=True)).otherwise(F.when(ok & F.col("source").isin("batdongsan", "phongtro123", "nhatot"), "")).alias("description_clean"),
        F.lit(None).cast("date").alias("posted_date"), F.lit(None).cast("int").alias("image_count"),
        "content_hash", F.coalesce(F.col("http_status") == 200, F.lit(False)).alias("is_active"), ok.alias("parse_ok"), "parse_error", F.lit(day).alias("dt"),
    )

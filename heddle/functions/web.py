"""Expressions over URLs, raw pages and sitemaps."""

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from heddle.functions import vocab
from heddle.functions.composition import bound, nfc


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null without a match or with an empty group."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def tag_text(html: Column, tag: str) -> Column:
    """The first element's text without tags inside, blanks collapsed."""
    inner = first_match(html, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>")
    return F.trim(F.regexp_replace(F.regexp_replace(inner, r"(?s)<[^>]*>", ""), r"\s+", " "))


#: An anchor's target, with its quotes if it has any.
LINK = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def links(html: Column) -> Column:
    """The targets of all anchors, in order, repeats included."""
    return F.transform(F.regexp_extract_all(html, F.lit(LINK), F.lit(1)), lambda t: F.regexp_replace(t, "^[\"']|[\"']$", ""))


def visible_text(html: Column) -> Column:
    """Text outside of tags, scripts and styles, blanks collapsed."""
    bare = F.regexp_replace(html, r"(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"\s+", " "))


def script_json(html: Column, name: str, value: str) -> Column:
    """Variants, in order, of the scripts whose attribute ``name`` is ``value``; null where one holds no JSON.

    Keys that repeat in an object are no JSON.
    """
    tag = rf"""(?is)<script\b(?=[^>]*\s{name}\s*=\s*(?:"{value}"|'{value}'|{value}[\s>]))[^>]*>(.*?)</script\s*>"""
    return F.transform(F.regexp_extract_all(html, F.lit(tag), F.lit(1)), lambda s: F.try_parse_json(F.trim(nfc(s))))


def linked_data(html: Column, *types: str) -> Column:
    """The first JSON-LD object of one of the types, as a variant; null without one."""
    return F.get(F.filter(script_json(html, "type", re.escape("application/ld+json")), lambda v: json_text(v, "@type").isin(*types)), F.lit(0))


def json_text(data: Column, *keys: str) -> Column:
    """A value deep in a variant as text, null as soon as a step isn't there or the text is empty.

    A list or an object is its JSON, with single quotes as everywhere in silver.
    """
    path = "$" + "".join(f'["{key}"]' for key in keys)
    text = F.try_variant_get(data, path, "string")
    nested = text.rlike(r"^[\[{]") & F.schema_of_variant(F.try_variant_get(data, path, "variant")).rlike("^(?:ARRAY|OBJECT)")
    return F.nullif(F.when(nested, F.translate(text, '"', "'")).otherwise(text), F.lit(""))


def last_segment(url: Column) -> Column:
    """What follows the last slash, slashes at the end ignored."""
    return F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)


def url_host(url: Column) -> Column:
    return first_match(url, r"^[a-z]+://([^/?#]+)")


def url_path(url: Column) -> Column:
    return F.coalesce(first_match(url, r"^[a-z]+://[^/?#]+([^?#]*)"), F.lit(""))


def url_param(url: Column, name: str) -> Column:
    return first_match(url, rf"[?&]{name}=([^&#]*)")


def classify_probe(status: Column, html: Column, server_errors: str = "absent") -> tuple[Column, Column]:
    """(is_present, reason) of a probe.

    Any other status than 200 is absence, ``http_status:N``; a removal phrase is
    ``soft_delete``; else the listing is there, with an empty body too. With
    ``server_errors="inconclusive"`` a status of 500 or more is null instead.
    """
    phrase = "(?iu)" + "|".join(vocab.REMOVAL_PHRASES)
    gone = nfc(F.coalesce(html, F.lit(""))).rlike(phrase)
    bad = ~status.eqNullSafe(F.lit(200))
    reason = F.when(bad, F.concat(F.lit("http_status:"), F.coalesce(status.cast("string"), F.lit("none")))).when(gone, F.lit("soft_delete"))
    present = ~bad & ~gone
    if server_errors == "inconclusive":
        present = F.when(status < 500, present)
    return present, reason


def sitemap_urls(documents: DataFrame, xml: str, pattern: str = "") -> DataFrame:
    """(url) of sitemap documents: all of an index's sitemaps, those of a url set that hold ``pattern``."""
    text = F.col(xml)
    paths = (("sitemap", ""), ("url", pattern))
    found = [F.xpath(text, F.lit(f"//*[local-name()='{parent}']/*[local-name()='loc']/text()")) for parent, _ in paths]
    kept = [_holding(f, want) for f, (_, want) in zip(found, paths)]
    return documents.select(F.explode(reduce(F.concat, kept)).alias("url"))


def sitemap_tree(documents: DataFrame, location: str, xml: str, roots: DataFrame, pattern: str = "", levels: int = 2) -> DataFrame:
    """(url) of the pages under ``roots(url)``: indexes are followed to the sitemaps that they name.

    ``documents`` holds the sitemaps fetched, by ``location``; ``levels`` is how
    many there are below one another. A sitemap that isn't there gives nothing,
    and a page named twice is one row.
    """
    def named(parent: str) -> Column:
        return F.transform(F.xpath(F.col(xml), F.lit(f"//*[local-name()='{parent}']/*[local-name()='loc']/text()")), lambda u: F.trim(u))

    found, at = None, roots.select(F.col("url").alias("_at")).distinct()
    for _ in range(levels):
        held = documents.join(at, documents[location] == at["_at"], "left_semi")
        pages = held.select(F.explode(_holding(named("url"), pattern)).alias("url"))
        found = pages if found is None else found.unionByName(pages)
        at = held.select(F.explode(named("sitemap")).alias("_at")).distinct()
    return found.distinct()


def _holding(urls: Column, want: str) -> Column:
    return F.filter(F.transform(urls, lambda u: F.trim(u)), lambda u: F.contains(u, F.lit(want)))

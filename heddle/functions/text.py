"""Text expressions: personal data, folding, prices, areas, places, vocabularies.

All functions map columns to columns without UDFs. ``unicode=True`` gives ``\\d``,
``\\w`` and ``\\s`` their Unicode meaning; the default is ASCII, which other SQL
engines share.
"""

import unicodedata

from pyspark.sql import Column, DataFrame, functions as F

from heddle.functions import vocab
from heddle.functions.composition import bound, nfc

# Patterns of personal data. The patterns of prices, areas and place names in the functions below are fixed too.
EMAIL = r"[\w.+-]+@[\w-]+\.[\w.]+"
SOCIAL = r"(?:zalo|facebook|fb|viber)[\s:]*[\w./]+"
PHONE = r"(?:\+?84|0)[\s.\-]?\d{2,3}[\s.\-]?\d{3}[\s.\-]?\d{3,4}"


def _flags(pattern: str, unicode: bool, fold: bool = False) -> str:
    flags = ("U" if unicode else "") + ("i" if fold else "") + ("u" if fold and unicode else "")
    return f"(?{flags}){pattern}" if flags else pattern


def strip_pii(text: Column, unicode: bool = False) -> Column:
    """Emails, social handles and phone numbers replaced by marks, in this order; null is empty."""
    text = F.coalesce(text, F.lit(""))
    text = F.regexp_replace(text, _flags(EMAIL, unicode), "<EMAIL>")
    text = F.regexp_replace(text, _flags(SOCIAL, unicode, fold=True), "<SOCIAL>")
    return F.regexp_replace(text, _flags(PHONE, unicode), "<PHONE>")


def normalise_text(text: Column) -> Column:
    """Composed (NFC), lower case, blanks collapsed and trimmed; null is empty."""
    return F.lower(F.trim(F.regexp_replace(nfc(F.coalesce(text, F.lit(""))), r"(?U)\s+", " ")))


def _folding() -> tuple[str, str]:
    """Letters up to U+1EFF that are a plain ASCII letter under their marks, and those letters."""
    marked, plain = "đĐ", "dD"
    for code in range(0xC0, 0x1F00):
        base = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if not unicodedata.combining(c))
        if base != chr(code) and len(base) == 1 and base.isascii():
            marked, plain = marked + chr(code), plain + base
    return marked, plain


def strip_diacritics(text: Column) -> Column:
    """Letters without their marks, đ as d, whether the text is composed or not."""
    return F.translate(F.regexp_replace(text, r"\p{M}", ""), *_folding())


def parse_price(text: Column) -> Column:
    """A rent in VND as a long: millions, then thousands, then seven digits or more; null if none or by agreement."""
    return bound(normalise_text(text), _price)


def _price(t: Column) -> Column:
    million = r"(\d+(?:[.,]\d+)?)\s*tr(?:iệu)?\s*(\d+)?"
    whole, rest = F.regexp_extract(t, million, 1), F.regexp_extract(t, million, 2)
    as_decimal = F.replace(whole, F.lit(","), F.lit(".")).try_cast("decimal(20,6)")
    broken = whole.rlike("[.,]")
    # "7tr5" is 7.5 million: the digits behind are the next places
    places = F.rpad(F.substring(rest, 1, 6), 6, "0").try_cast("long")
    in_millions = F.when(broken | (rest == ""), F.floor(as_decimal * 1_000_000)).otherwise(whole.try_cast("long") * 1_000_000 + places)
    thousand = F.regexp_extract(t, r"([\d.,]+)\s*(?:nghìn|ngàn|k)(?!\w)", 1)
    in_thousands = F.floor(F.replace(thousand, F.lit(","), F.lit(".")).try_cast("decimal(20,6)") * 1_000)
    bare = F.regexp_replace(F.regexp_extract(t, r"([\d.,]{7,})", 1), "[.,]", "").try_cast("long")
    value = F.when(whole != "", in_millions).when(thousand != "", in_thousands).otherwise(bare)
    return F.when(~t.rlike("thỏa thuận|thoa thuan"), value).cast("long")


def parse_area(text: Column) -> Column:
    """The first area in square metres, as a double."""
    return F.replace(F.regexp_extract(normalise_text(text), r"(\d+(?:[.,]\d+)?)\s*m(?:2|²)", 1), F.lit(","), F.lit(".")).try_cast("double")


def place_key(text: Column, prefix: str) -> Column:
    return F.trim(F.regexp_replace(strip_diacritics(normalise_text(text)), prefix, ""))


def normalise_province(text: Column) -> Column:
    """The code of one of six provinces, else null."""
    return lookup(place_key(text, r"^(?:tp\.?|thanh pho|tinh)\s*"), vocab.PROVINCES)


def normalise_district(text: Column) -> Column:
    """A district's bare name without accents, null if nothing is left."""
    return F.nullif(place_key(text, r"^(?:quan|huyen|thanh pho|thi xa|tp|q)\s*[.\s]\s*"), F.lit(""))


def lookup(key: Column, values: dict[str, str]) -> Column:
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def _by_source(source: Column, raw: Column, maps: dict[str, dict[str, str]]) -> Column:
    """A source's words in its vocabulary, as written or else without regard to case and outer blanks."""
    exact = {f"{s}\n{k}": v for s, words in maps.items() for k, v in words.items()}
    loose: dict[str, str] = {}
    for s, words in maps.items():
        for k, v in words.items():
            loose.setdefault(f"{s}\n{k.lower().strip()}", v)
    own, folded = F.concat(source, F.lit("\n"), raw), F.concat(source, F.lit("\n"), F.trim(F.lower(raw)))
    return F.coalesce(lookup(own, exact), lookup(folded, loose))


def normalise_furnishing(source: Column, raw: Column) -> Column:
    """none, basic, full or unknown, never null."""
    level = F.trim(F.lower(raw))
    return F.coalesce(_by_source(source, raw, vocab.FURNISHING), F.when(level.isin(*vocab.FURNISHING_LEVELS), level), F.lit("unknown"))


def normalise_property_type(source: Column, raw: Column) -> Column:
    """A type of the vocabulary, other where the source's word is unknown or null."""
    return F.coalesce(_by_source(source, raw, vocab.PROPERTY_TYPE), F.lit("other"))


def unmapped(df: DataFrame, source: str, raw: str, mapped: Column, default: str) -> DataFrame:
    """Words without an entry, counted by source: what to add to a vocabulary."""
    missing = F.col(raw).isNotNull() & (F.trim(raw) != "") & (mapped == default) & (F.lower(F.trim(raw)) != default)
    return df.where(missing).groupBy(source, raw).agg(F.count("*").alias("rows"))


def expand_abbreviations(text: Column) -> Column:
    """Whole-word abbreviations of listings written out."""
    for short, long in vocab.ABBREVIATIONS.items():
        text = F.regexp_replace(text, rf"(?iu)(?<![\p{{L}}\p{{N}}]){short}(?![\p{{L}}\p{{N}}])", long)
    return text


def amenity_flags(text: Column) -> list[Column]:
    """A column of 0 or 1 for each amenity, its words composed or not."""
    either = {name: f"(?iu){words}|{unicodedata.normalize('NFD', words)}" for name, words in vocab.AMENITIES.items()}
    return [F.coalesce(text.rlike(pattern), F.lit(False)).cast("int").alias(f"has_{name}") for name, pattern in either.items()]


def char_shingles(text: Column, n: int = 3) -> Column:
    """All overlapping runs of ``n`` characters, with repeats; none for shorter or null texts.

    The array of characters is zipped with itself moved on, which is linear in
    the text; cutting substrings would walk the text anew for each.
    """
    letters = F.split(text, "")
    runs = letters
    for i in range(2, n + 1):
        runs = F.zip_with(runs, F.slice(letters, F.lit(i), F.greatest(F.size(letters), F.lit(1))), lambda run, letter: F.concat(run, letter))
    whole = F.slice(runs, F.lit(1), F.greatest(F.size(letters) - n + 1, F.lit(1)))
    return F.when(F.length(text) >= n, whole).otherwise(F.array().cast("array<string>"))


def block_key(province: Column, district: Column, area: Column, rent: Column) -> Column:
    """province|district|area|rent, area to whole metres and rent to 100,000; null numbers shorten the key."""
    return F.concat_ws("|", F.coalesce(province, F.lit("")), F.coalesce(district, F.lit("")), F.round(area, 0).cast("string"), F.round(rent, -5).cast("string"))


def iso_date(text: Column) -> Column:
    """The date of an ISO timestamp's first ten characters, null if it is none."""
    day = F.substring(text, 1, 10)
    return F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), day.try_cast("date"))

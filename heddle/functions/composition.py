"""Canonical composition (NFC) of letters and combining marks, as column expressions.

Spark has no normal forms. Texts without combining marks, nearly all, are left as
they are by one regular expression. In others only the runs of a character and its
marks are taken apart: the character into its letter and marks, all marks put in
the order of their classes, and letter and marks joined where a pair has a
character of its own. The tables come from the interpreter's Unicode data by rule.

This is NFC of any text whose combining marks are those of U+0300 to U+036F, that
is of Latin, Vietnamese, Greek and Cyrillic; marks of other blocks are left alone.
"""

import unicodedata
from functools import cache

from pyspark.sql import Column, functions as F

#: Code points that may be taken apart.
LAST = 0x3000


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _ranges(chars: str) -> str:
    """The inside of a regular expression's class of these characters, in ranges, which are few to test."""
    codes = sorted(map(ord, chars))
    firsts = [c for c in codes if c - 1 not in codes]
    lasts = [c for c in codes if c + 1 not in codes]
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(firsts, lasts))


@cache
def _marks() -> str:
    return "".join(chr(c) for c in range(0x300, 0x370) if unicodedata.combining(chr(c)))


@cache
def _singles() -> tuple[str, str]:
    """Characters that are always written as one other, and those."""
    pairs = [(chr(c), unicodedata.normalize("NFC", chr(c))) for c in range(0x80, LAST)]
    pairs = [(a, b) for a, b in pairs if a != b and len(b) == 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


@cache
def _parts() -> dict[str, str]:
    """Characters of a letter and marks → that letter and the marks in order."""
    apart = {chr(c): unicodedata.normalize("NFD", chr(c)) for c in range(0x80, LAST)}
    return {c: d for c, d in apart.items() if len(d) > 1 and all(m in _marks() for m in d[1:]) and unicodedata.normalize("NFC", c) == c}


@cache
def _joined() -> dict[str, tuple[str, str]]:
    """Mark → the characters that it joins, and what they become."""
    found: dict[str, tuple[str, str]] = {}
    for c, d in _parts().items():
        letter, mark = unicodedata.normalize("NFC", d[:-1]), d[-1]
        if len(letter) == 1:
            before = found.get(mark, ("", ""))
            found[mark] = before[0] + letter, before[1] + c
    return found


def _taken_apart(char: Column) -> tuple[Column, list[Column]]:
    """A character's letter, and its marks, empty where there are none."""
    parts, marks = _parts(), []
    for place in range(1, max(map(len, parts.values()))):
        some = {c: d[place] for c, d in parts.items() if len(d) > place}
        told = F.translate(char, "".join(some), "".join(some.values()))
        marks.append(F.when(told != char, told).otherwise(""))
    return F.translate(char, "".join(parts), "".join(d[0] for d in parts.values())), marks


def _together(char: Column, mark: Column) -> Column:
    """The character that a character and a mark make, else the character."""
    out = None
    for m, (some, made) in _joined().items():
        out = (F if out is None else out).when(mark == m, F.translate(char, some, made))
    return out.otherwise(char)


def _run(run: Column) -> Column:
    """NFC of a character, or none, and the marks behind it."""
    marks = _marks()
    letter, own = _taken_apart(F.regexp_extract(run, f"(?s)^[^{_ranges(marks)}]", 0))
    every = F.split(F.concat(*own, F.regexp_extract(run, f"[{_ranges(marks)}]+$", 0)), "")
    classes = "".join(chr(32 + unicodedata.combining(m)) for m in marks)
    ordered = F.sort_array(F.transform(every, lambda m, i: F.struct(F.translate(m, marks, classes).alias("kind"), i.alias("i"), m.alias("mark"))))
    start = F.struct(letter.alias("char"), F.lit("").alias("rest"), F.lit("").alias("last"))

    def step(state: Column, m: Column) -> Column:
        made = _together(state["char"], m["mark"])
        # a mark left over stands in the way of later ones of its class
        joins = (made != state["char"]) & (state["last"] < m["kind"])
        return F.struct(
            F.when(joins, made).otherwise(state["char"]).alias("char"),
            F.when(joins, state["rest"]).otherwise(F.concat(state["rest"], m["mark"])).alias("rest"),
            F.when(joins, state["last"]).otherwise(m["kind"]).alias("last"),
        )

    return F.aggregate(ordered, start, step, lambda s: F.concat(s["char"], s["rest"]))


def _each(text: Column, pattern: str, change) -> Column:
    """``text`` with its matches changed."""
    between, found = F.split(text, pattern, -1), F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), change)
    return F.array_join(F.zip_with(between, found, lambda b, f: F.concat(b, F.coalesce(f, F.lit("")))), "")


def nfc(text: Column) -> Column:
    """``text`` composed; null stays null."""
    old, new = _singles()
    marks, others = _ranges(_marks()), _ranges(old + "\u0344")
    # one character always becomes two marks
    plain = F.when(text.rlike(f"[{others}]"), F.replace(F.translate(text, old, new), F.lit("\u0344"), F.lit("\u0308\u0301"))).otherwise(text)
    return F.when(text.rlike(f"[{marks}{others}]"), bound(plain, lambda t: _each(t, f"(?s)[^{marks}]?[{marks}]+", _run))).otherwise(text)


def decomposed(text: Column) -> Column:
    """``text`` with each letter that has marks of its own followed by them instead."""

    def apart(char: Column) -> Column:
        letter, marks = _taken_apart(char)
        return F.concat(letter, *marks)

    return _each(text, f"[{_ranges(''.join(_parts()))}]", apart)

"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

All of it is SQL expressions on one row, so a scan is a single narrow stage. A
pattern's matches come from ``regexp_extract_all`` and their places from the
lengths of what ``split`` leaves between them. Quantifiers are possessive where
that changes no match: Java then loops instead of recursing, so no text is too
long. Cheap tests (an at sign, a plus sign, any digit) come first.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heddle.sources import table

#: Code points before and behind a span in which context words count, and what they add.
CONTEXT_CHARS = 50
CONTEXT_GAIN = 0.25
#: What a passed checksum adds; a failed one rejects the span.
CHECK_GAIN = 0.5
KEEP = 0.5


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``needs`` is the cheap test on the text, ``valid`` the test of a match and
    ``sure`` whether ``valid`` is a checksum. Base kinds are kept whenever valid.
    """

    name: str
    pattern: str
    needs: str
    prior: float
    context: str
    base: bool = False
    sure: bool = False


KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.8, r"mail|contact|write|reply", base=True),
    Kind("ip", r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++", "digit", 0.5, r"\bip\b|host|server|address|login", base=True),
    Kind("card", r"[0-9](?:[ -]?[0-9]){13,}+", "digit", 0.3, r"card|visa|credit|debit|payment", base=True, sure=True),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+", 0.6, r"phone|tel\b|call|fax|mobile|contact", base=True),
    Kind("iban", r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9_])", "digit", 0.3, r"iban|account|bank|konto|transfer", sure=True),
    Kind("ssn", r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])", "digit", 0.3, r"ssn|social security|taxpayer"),
    Kind("tel", r"(?<![A-Za-z0-9_])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![A-Za-z0-9_])", "digit", 0.3, r"phone|tel\b|call|fax|mobile|contact"),
)


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a sum of digits, every second doubled from the right, divisible by 10."""
    size = F.length(number)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(number, size - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN, its first four letters moved to the end and letters read as 10 to 35, leaves 1 modulo 97."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, F.lit(1), F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code < 58, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        # a part is at most 255 whatever zeros lead it
        return F.forall(F.split(match, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(digits(match)).between(14, 19) & luhn(digits(match))
    if kind == "phone":
        return F.length(digits(match)).between(10, 15)
    if kind == "iban":
        bare = F.replace(match, F.lit(" "), F.lit(""))
        return F.length(bare).between(15, 34) & mod97(bare)
    return F.lit(True)


def _needed(text: Column, need: str) -> Column:
    return text.rlike("[0-9]") if need == "digit" else F.contains(text, F.lit(need))


def _spans(text: Column, found: Column, order: int, kind: Kind) -> Column:
    """``found``, a kind's matches, with their places, reasons and scores; failing ones are gone."""
    gaps = F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(found))
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gaps"])
        end = start + F.length(pair["found"])
        span = F.struct(start.alias("start"), F.lit(order).alias("kind"), end.alias("end"), pair["found"].alias("match"))
        return F.struct(end.alias("at"), F.array_append(state["spans"], span).alias("spans"))

    placed = F.aggregate(
        F.arrays_zip(gaps.alias("gaps"), found.alias("found")),
        F.struct(F.lit(0).alias("at"), nothing.alias("spans")),
        step,
        lambda state: state["spans"],
    )

    def scored(span: Column) -> Column:
        before = F.substring(text, F.greatest(span["start"] - CONTEXT_CHARS + 1, F.lit(1)), F.least(span["start"], F.lit(CONTEXT_CHARS)))
        behind = F.substring(text, span["end"] + 1, F.lit(CONTEXT_CHARS))
        near = F.lower(before).rlike(kind.context) | F.lower(behind).rlike(kind.context)
        return F.struct(
            span["start"].alias("start"), span["kind"].alias("kind"), span["end"].alias("end"), F.lit(kind.name).alias("name"),
            (F.lit(kind.prior + CHECK_GAIN * kind.sure) + F.when(near, CONTEXT_GAIN).otherwise(0.0)).alias("score"),
        )

    kept = F.transform(F.filter(placed, lambda span: _valid(kind.name, span["match"])), scored)
    return kept if kind.base else F.filter(kept, lambda span: span["score"] >= KEEP)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans``: start, kind, end, name and score of each span found, in order.

    Starts and ends are code points, the end exclusive. Base kinds (email, ip,
    card, phone) are kept when valid, whatever their score; the others when
    their score reaches KEEP and they touch no base span. Null and empty texts
    have no spans; null ids stay null; repeated rows are searched each; other
    columns are not read; an empty table gives no rows.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    needs = {need: f"need{i}" for i, need in enumerate(dict.fromkeys(k.needs for k in KINDS))}
    read = read.withColumns({name: _needed(text, need) for need, name in needs.items()})
    empty = F.array().cast("array<string>")
    read = read.withColumns({k.name: F.when(F.col(needs[k.needs]), F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))).otherwise(empty) for k in KINDS})
    none = F.array().cast("array<struct<start:int,kind:int,end:int,name:string,score:double>>")
    read = read.withColumns({k.name: F.when(F.size(k.name) > 0, _spans(text, F.col(k.name), i, k)).otherwise(none) for i, k in enumerate(KINDS)})
    base = F.concat(*(F.col(k.name) for k in KINDS if k.base))
    more = F.concat(*(F.col(k.name) for k in KINDS if not k.base))
    read = read.select("doc_id", base.alias("base"), more.alias("more"))
    apart = F.filter("more", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return read.select("doc_id", F.sort_array(F.concat("base", apart)).alias("spans"))


def _written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")


def _count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole document, as counts and digests of spans, and the spans' scores in hundredths."""
    found = find_personal_data(table(spark, sf_dir, "documents"))
    bases = [i for i, k in enumerate(KINDS) if k.base]
    base = F.filter("spans", lambda s: s["kind"] <= max(bases))
    return found.select(
        "doc_id",
        *(_count(F.col("spans"), i).cast("long").alias(f"n_{KINDS[i].name}") for i in bases),
        F.sha2(_written(base).cast("binary"), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: F.round(s["score"] * 100).cast("int").cast("string")), ",").alias("scores"),
    )


#: The kinds' patterns as the SQL check's linear-time matcher takes them.
SQL_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[ -]?[0-9])+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "tel": r"\b[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}\b",
}
_DIGITS = "regexp_replace(match, '[^0-9]', '', 'g')"
SQL_VALID = {
    "email": "true",
    "ip": "len(list_filter(string_split(match, '.'), lambda p: CAST(p AS HUGEINT) > 255)) = 0",
    "card": f"length({_DIGITS}) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: "
    f"CASE WHEN i % 2 = 1 THEN CAST(substr(reverse({_DIGITS}), i, 1) AS INT) ELSE (CAST(substr(reverse({_DIGITS}), i, 1) AS INT) * 2) // 10"
    f" + (CAST(substr(reverse({_DIGITS}), i, 1) AS INT) * 2) % 10 END)) % 10 = 0",
    "phone": f"length({_DIGITS}) BETWEEN 10 AND 15",
    "iban": "length(replace(match, ' ', '')) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, list_transform(string_split(substr(replace(match, ' ', ''), 5) || substr(match, 1, 4), ''), lambda c: "
    "CASE WHEN ascii(c) < 58 THEN ascii(c) - 48 ELSE ascii(c) - 55 END)), lambda r, v: (CASE WHEN v > 9 THEN r * 100 ELSE r * 10 END + v) % 97) = 1",
    "ssn": "true",
    "tel": "true",
}


def _oracle() -> str:
    def found(i: int, kind: Kind) -> str:
        pattern = SQL_PATTERNS[kind.name].replace("'", "''")
        lengths = "coalesce(list_sum(list_transform({}, lambda p: length(p))), 0)"
        start = f"{lengths.format('gaps[1:i]')} + {lengths.format('found[1:i - 1]')}"
        keep = "" if kind.base else f" AND score >= {KEEP}"
        return f"""SELECT doc_id, {i} AS kind, '{kind.name}' AS name, start, start + length(match) AS finish, score FROM (SELECT *, {kind.prior + CHECK_GAIN * kind.sure}
                + CASE WHEN regexp_matches(before, '{kind.context}') OR regexp_matches(behind, '{kind.context}') THEN {CONTEXT_GAIN} ELSE 0 END AS score FROM (
            SELECT doc_id, match, start, lower(substr(t, CAST(greatest(start - {CONTEXT_CHARS} + 1, 1) AS BIGINT), CAST(least(start, {CONTEXT_CHARS}) AS BIGINT))) AS before,
              lower(substr(t, start + length(match) + 1, {CONTEXT_CHARS})) AS behind FROM (
              SELECT doc_id, t, found[i] AS match, CAST({start} AS BIGINT) AS start FROM (
                SELECT doc_id, t, found, gaps, unnest(range(1, len(found) + 1)) AS i FROM (
                  SELECT doc_id, t, regexp_extract_all(t, '{pattern}') AS found, string_split_regex(t, '{pattern}') AS gaps FROM d)))))
            WHERE {SQL_VALID[kind.name]}{keep}"""

    base = " UNION ALL ".join(found(i, k) for i, k in enumerate(KINDS) if k.base)
    more = " UNION ALL ".join(found(i, k) for i, k in enumerate(KINDS) if not k.base)
    written = "string_agg(name || ':' || start || ':' || finish, ',' ORDER BY start, kind)"
    counts = ", ".join(f"count(*) FILTER (WHERE name = '{k.name}') AS n_{k.name}" for k in KINDS if k.base)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        base AS ({base}), more AS ({more}),
        whole AS (SELECT * FROM base UNION ALL SELECT * FROM more m WHERE NOT EXISTS
            (SELECT 1 FROM base b WHERE b.doc_id = m.doc_id AND b.start < m.finish AND m.start < b.finish)),
        b AS (SELECT doc_id, {counts}, {written} AS said FROM base GROUP BY doc_id),
        w AS (SELECT doc_id, {written} AS said, string_agg(CAST(round(score * 100) AS INTEGER), ',' ORDER BY start, kind) AS scores FROM whole GROUP BY doc_id)
        SELECT d.doc_id, {", ".join(f"coalesce(b.n_{k.name}, 0) AS n_{k.name}" for k in KINDS if k.base)},
            sha256(coalesce(b.said, '')) AS base_sha256, coalesce(w.said, '') AS spans, coalesce(w.scores, '') AS scores
        FROM d LEFT JOIN b USING (doc_id) LEFT JOIN w USING (doc_id)"""


QUERIES = {"op4_personal_data": op4_personal_data}
ORACLE_SQL = {"op4_personal_data": _oracle()}

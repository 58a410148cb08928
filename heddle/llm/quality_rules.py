"""Quality rules as a ledger of bits: every rule is evaluated once, policies decide later.

A ledger row holds a document's measurements and ``failed``, a bit for each rule
it breaks. A policy is a version, a mask of rules and how many of them a kept
document may break, so a new policy reads the ledger and not the texts, and what
each rule costs (its ablation) comes from counts of distinct masks.

All of it is SQL expressions on one row. That no five-word window repeats is told
by distinct hashes; only windows whose hashes meet are compared as texts.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from heddle.sources import table

WINDOW = 5
BLANKS = r"\x20\x09-\x0D"
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """A rule's name and its test of the measurements, as SQL that holds where a document fails.

    Its place in ``RULES`` is its bit, so new rules are added at the end.
    """

    name: str
    fails: str


#: Integer tests alone, so that any engine agrees on them.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("many_words", "n_words > 100000"),
    Rule("word_length", "word_chars < 3 * n_words or word_chars > 10 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "n_dup_lines > 3 and 10 * n_dup_lines > 3 * n_lines"),
    Rule("few_letters", "n_words >= 30 and 100 * n_letter_words < 80 * n_words"),
    Rule("shouting", "2 * n_capitals > word_chars"),
    Rule("exclaiming", "2 * n_exclaims > n_words"),
    Rule("cut_off_lines", "n_cut_lines > 3 and 10 * n_cut_lines > 3 * n_lines"),
)
BITS = {rule.name: 1 << place for place, rule in enumerate(RULES)}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words", "n_capitals", "n_exclaims", "n_cut_lines")
BASE = BITS["few_words"] | BITS["repeated_words"]


@dataclass(frozen=True)
class Policy:
    """Documents are kept that break none of ``never`` and at most ``most`` of ``mask``."""

    version: int
    mask: int
    never: int = BASE
    most: int = 0

    def keeps(self, failed: Column) -> Column:
        broken = F.bit_count(failed.bitwiseAND(F.lit(self.mask)))
        return (failed.bitwiseAND(F.lit(self.never)) == 0) & (broken <= self.most)

    def without(self, bit: int) -> "Policy":
        return Policy(self.version, self.mask & ~bit, self.never & ~bit, self.most)


POLICIES = (
    Policy(1, BASE),
    Policy(2, (1 << len(RULES)) - 1, most=1),
    Policy(3, (1 << len(RULES)) - 1),
)
CURRENT = POLICIES[-1]


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _covered(places: Column, width: int) -> Column:
    """How many places lie in windows that begin at ``places``, which ascend."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda s, p: F.struct((p + width).alias("end"), (s["n"] + (p + width - F.greatest(p, s["end"]))).alias("n"))
    return F.aggregate(places, start, step, lambda s: s["n"])


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """How many of ``words`` lie in windows of ``width`` words that are found twice or more; the first one counts too."""

    def from_words(ws: Column) -> Column:
        n = F.size(ws) - width + 1
        hashes = F.slice(F.transform(ws, lambda w, i: F.xxhash64(w, *(F.get(ws, i + k) for k in range(1, width)))), F.lit(1), F.greatest(n, F.lit(0)))
        window = lambda p: F.slice(ws, p + 1, F.lit(width))
        place = lambda x: x.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")

        def repeats(rows: Column, key: Callable[[Column], Column]) -> Column:
            """The rows, in order, that a neighbour has the key of."""
            same = lambda x, i: F.coalesce(key(F.get(rows, i - 1)) == key(x), F.lit(False)) | F.coalesce(key(F.get(rows, i + 1)) == key(x), F.lit(False))
            return F.filter(rows, same)

        def from_alike(rows: Column) -> Column:
            """Places of windows whose half hashes meet, which are equal throughout unless some neighbours differ."""
            differ = F.exists(
                F.sequence(F.lit(1), F.size(rows) - 1),
                lambda i: (F.shiftright(F.get(rows, i), 31) == F.shiftright(F.get(rows, i - 1), 31)) & (window(place(F.get(rows, i))) != window(place(F.get(rows, i - 1)))),
            )
            texts = F.sort_array(F.transform(rows, lambda x: F.struct(window(place(x)).alias("w"), place(x).alias("p"))))
            exact = _bound(texts, lambda known: F.transform(repeats(known, lambda x: x["w"]), lambda x: x["p"]))
            return F.sort_array(F.when(differ, exact).otherwise(F.transform(rows, place)))

        def from_hashes(hs: Column) -> Column:
            # half of a hash and a place are one number, so that numbers are sorted
            coded = F.sort_array(F.transform(hs, lambda h, i: h.bitwiseAND(F.lit(-1 << 31)).bitwiseOR(i.cast("long"))))
            alike = _bound(coded, lambda rows: repeats(rows, lambda x: F.shiftright(x, 31)))
            covered = _bound(alike, lambda rows: F.when(F.size(rows) == 0, F.lit(0).cast("long")).otherwise(_covered(from_alike(rows), width)))
            return F.when(F.size(F.array_distinct(hs)) < F.size(hs), covered).otherwise(F.lit(0).cast("long"))

        return _bound(hashes, from_hashes)

    return _bound(words, from_words)


def measured(text: Column) -> list[Column]:
    """The measurements of a text, named as in ``MEASURES``; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{BLANKS}]+", -1))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(f"[^{BLANKS}]"))

    def by_word(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            repeated_words(ws).alias("n_repeat_words"),
            F.size(F.filter(ws, lambda w: w.rlike(r"\p{L}"))).cast("long").alias("n_letter_words"),
        )

    def by_line(ls: Column) -> Column:
        return F.struct(
            F.size(ls).cast("long").alias("n_lines"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(ls, lambda line: line.endswith("...") | line.endswith("…"))).cast("long").alias("n_cut_lines"),
        )

    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    return [
        _bound(words, by_word).alias("of_words"),
        _bound(lines, by_line).alias("of_lines"),
        F.struct(count(SYMBOLS).alias("n_symbols"), count(r"\p{Lu}").alias("n_capitals"), count("!").alias("n_exclaims")).alias("of_chars"),
    ]


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, the measurements, failed) for every row of ``docs``.

    ``failed`` has a rule's bit where the rule is broken. A null text is empty and
    breaks ``few_words``. Rows that repeat an id, or have none, have rows of their
    own; other columns are not read; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), *measured(F.col(text_col)))
    rows = rows.select("doc_id", "of_words.*", "of_lines.*", "of_chars.*").select("doc_id", *MEASURES)
    bits = [F.when(F.expr(rule.fails), F.lit(BITS[rule.name])).otherwise(F.lit(0)).cast("long") for rule in RULES]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return rows.withColumn("failed", failed)


def apply_policy(rows: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """A ledger with ``kept`` and the policy's ``version``."""
    return rows.withColumn("kept", policy.keeps(F.col("failed"))).withColumn("version", F.lit(policy.version))


def keep_passing(docs: DataFrame, policy: Policy = CURRENT, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the policy drops, their columns unchanged, whatever these are called."""
    numbered = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return apply_policy(ledger(numbered, "row", "text"), policy).where("kept").select("doc_id.*")


def ablations(rows: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """(version, rule, docs, breaking, dropped, dropped_without, words_back) of a ledger: what each rule does to each policy.

    Documents are counted by mask first, so all that follows handles at most as
    many rows as masks occur. ``breaking`` documents break the rule,
    ``dropped_without`` are dropped if the rule is taken out of the policy, and
    ``words_back`` are the words of those that it alone keeps out. A ledger
    without rows gives no rows.
    """
    masks = rows.groupBy("failed").agg(F.count("*").alias("n"), F.sum("n_words").alias("words"))
    failed, n = F.col("failed"), F.col("n")
    cases = []
    for policy in policies:
        for rule in RULES:
            bit = BITS[rule.name]
            if (policy.mask | policy.never) & bit:
                now, then = policy.keeps(failed), policy.without(bit).keeps(failed)
                cases.append(
                    F.struct(
                        F.lit(policy.version).alias("version"), F.lit(rule.name).alias("rule"), n.alias("docs"),
                        F.when(failed.bitwiseAND(F.lit(bit)) != 0, n).otherwise(0).alias("breaking"),
                        F.when(now, 0).otherwise(n).alias("dropped"),
                        F.when(then, 0).otherwise(n).alias("dropped_without"),
                        F.when(then & ~now, F.col("words")).otherwise(0).alias("words_back"),
                    )
                )
    told = masks.select(F.explode(F.array(*cases)).alias("c")).select("c.*")
    return told.groupBy("version", "rule").agg(*(F.sum(c).alias(c) for c in ("docs", "breaking", "dropped", "dropped_without", "words_back")))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, base verdict and the current policy's verdict of all documents."""
    rows = apply_policy(ledger(table(spark, sf_dir, "documents")))
    base = F.col("failed").bitwiseAND(F.lit(BASE)) != 0
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "failed", "version")


def quality_rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule does to each policy, over all documents."""
    return ablations(ledger(table(spark, sf_dir, "documents")))


_FAILED_SQL = " | ".join(f"(CASE WHEN {rule.fails} THEN {BITS[rule.name]} ELSE 0 END)" for rule in RULES)
_LEDGER_SQL = rf"""
numbered AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
split_up AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '[^{BLANKS}]+') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^{BLANKS}]')) AS lines
  FROM numbered
),
placed AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM split_up),
windows AS (
  SELECT rid, p, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS w
  FROM placed WINDOW o AS (PARTITION BY rid ORDER BY p)
),
twice AS (SELECT rid, unnest(list(p)) AS p FROM windows WHERE w IS NOT NULL GROUP BY rid, w HAVING count(*) > 1),
covered AS (SELECT rid, count(DISTINCT p + k) AS n FROM twice, range(0, {WINDOW}) AS r(k) GROUP BY rid),
measured AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '{SYMBOLS}')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(list_filter(words, lambda w: regexp_matches(w, '\p{{L}}'))) AS BIGINT) AS n_letter_words,
    CAST(len(regexp_extract_all(text, '\p{{Lu}}')) AS BIGINT) AS n_capitals,
    CAST(len(regexp_extract_all(text, '!')) AS BIGINT) AS n_exclaims,
    CAST(len(list_filter(lines, lambda l: l LIKE '%...' OR l LIKE '%…')) AS BIGINT) AS n_cut_lines
  FROM split_up LEFT JOIN covered USING (rid)
),
ledger AS (SELECT *, CAST({_FAILED_SQL} AS BIGINT) AS failed FROM measured)"""


def _keeps_sql(policy: Policy) -> str:
    return f"((failed & {policy.never}) = 0 AND bit_count(failed & {policy.mask}) <= {policy.most})"


def _ablation_sql() -> str:
    cases = [
        f"""SELECT CAST({p.version} AS INTEGER) AS version, '{r.name}' AS rule, count(*) AS docs, count(*) FILTER (failed & {BITS[r.name]} <> 0) AS breaking,
        count(*) FILTER (NOT {_keeps_sql(p)}) AS dropped, count(*) FILTER (NOT {_keeps_sql(p.without(BITS[r.name]))}) AS dropped_without,
        CAST(coalesce(sum(n_words) FILTER ({_keeps_sql(p.without(BITS[r.name]))} AND NOT {_keeps_sql(p)}), 0) AS BIGINT) AS words_back FROM ledger"""
        for p in POLICIES
        for r in RULES
        if (p.mask | p.never) & BITS[r.name]
    ]
    return f"WITH {_LEDGER_SQL} {' UNION ALL '.join(cases)}"


QUERIES = {"op11_quality_rules": op11_quality_rules, "quality_rule_ablations": quality_rule_ablations}
ORACLE_SQL = {
    "op11_quality_rules": f"""WITH {_LEDGER_SQL}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & {BASE}) <> 0 AS base_failed, {_keeps_sql(CURRENT)} AS kept, failed, CAST({CURRENT.version} AS INTEGER) AS version FROM ledger""",
    "quality_rule_ablations": _ablation_sql(),
}

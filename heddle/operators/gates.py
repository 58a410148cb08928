"""Quality gates: one pass of metrics over a table, or over its write, then rules on one row."""

import datetime
import logging

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import StringType

from heddle.functions.text import PHONE
from heddle.functions.vocab import FURNISHING_LEVELS, PROVINCE_CODES
from heddle.sources.staged import Staged

_log = logging.getLogger(__name__)

# Bounds of the gates.
RENT_RANGE = (300_000, 500_000_000)
AREA_RANGE = (5.0, 1000.0)
LEAST_PARSE_RATE = 0.95
MOST_EMPTY_RATE = 0.05
#: What names a silver row.
KEY = ("dt", "source", "listing_id")
#: Identifiers hold digits that aren't phone numbers.
PII_EXEMPT = ("listing_id", "source", "url", "content_hash", "crawl_ts", "dt")


class GateError(ValueError):
    """A gate that failed; ``rule`` names it."""

    def __init__(self, rule: str, message: str):
        super().__init__(f"{rule}: {message}")
        self.rule = rule


def pii_columns(df: DataFrame, exempt: tuple[str, ...] = PII_EXEMPT) -> list[str]:
    """The string columns that are scanned, taken from the schema so that new ones are too."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in exempt]


def pii_metrics(df: DataFrame, pattern: str = PHONE, exempt: tuple[str, ...] = PII_EXEMPT) -> list[Column]:
    """Aggregates: the rows with a match in any scanned column, and in each of them."""
    columns = pii_columns(df, exempt)
    hits = [F.coalesce(F.col(c).rlike(pattern), F.lit(False)) for c in columns]
    anywhere = F.exists(F.array(*hits), lambda h: h) if hits else F.lit(False)
    return [F.count_if(anywhere).alias("leaking_rows"), *(F.count_if(h).alias(f"leaks_{c}") for c, h in zip(columns, hits))]


def pii_leaks(df: DataFrame, pattern: str = PHONE, exempt: tuple[str, ...] = PII_EXEMPT) -> DataFrame:
    """One row of ``pii_metrics``."""
    return df.agg(*pii_metrics(df, pattern, exempt))


def check_pii(metrics: dict) -> None:
    """Raise if a phone number is left in any scanned column."""
    if metrics["leaking_rows"]:
        raise GateError("pii", f"PII gate failed: {metrics['leaking_rows']} rows contain phone numbers")


def pii_gate(df: DataFrame) -> int:
    """``check_pii`` of a table."""
    metrics = pii_leaks(df).first().asDict()
    check_pii(metrics)
    return metrics["leaking_rows"]


def quality_metrics(day: datetime.date) -> list[Column]:
    """Aggregates: every count that the rules need."""
    fetched = F.col("is_active")
    parsed = F.col("parse_ok")
    empty = F.col("title").isNull() & F.col("asking_rent_vnd").isNull() & F.col("area_sqm").isNull()
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col("asking_rent_vnd").between(*RENT_RANGE)).alias("rent_outside"),
        F.count_if(~F.col("area_sqm").between(*AREA_RANGE)).alias("area_outside"),
        F.count_if(~F.col("province").isin(*PROVINCE_CODES)).alias("province_unknown"),
        F.count_if(F.col("province").isNull()).alias("province_missing"),
        F.count_if(F.col("furnishing").isNull() | ~F.col("furnishing").isin(*FURNISHING_LEVELS)).alias("furnishing_unknown"),
        F.count_if(F.col("crawl_date") != F.lit(day)).alias("other_days"),
        F.count_if(fetched).alias("fetched"),
        F.count_if(~fetched).alias("not_fetched"),
        F.count_if(fetched & parsed).alias("parsed"),
        F.count_if(parsed & empty).alias("parsed_empty"),
    ]


def gate_metrics(silver: DataFrame, day: datetime.date) -> DataFrame:
    """One row of ``quality_metrics``, from a single scan."""
    return silver.agg(*quality_metrics(day))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that more than one row has, with the count."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def check_quality(m: dict, repeated: int) -> dict[str, int]:
    """The metrics of a day, with its ``repeated`` keys; raises at the first rule broken, warns of soft ones."""
    warn = lambda rule, n: n and _log.warning("%s: %d rows", rule, n)
    rules = [
        ("row_count", not m["n_rows"], "no rows"),
        ("asking_rent_range", m["rent_outside"], f"{m['rent_outside']} rents outside {RENT_RANGE}"),
        ("area_range", m["area_outside"], f"{m['area_outside']} areas outside {AREA_RANGE}"),
        ("province_known", m["province_unknown"], f"{m['province_unknown']} unknown provinces"),
        ("furnishing_enum", m["furnishing_unknown"], f"{m['furnishing_unknown']} unknown furnishings"),
        ("listing_id_unique", repeated, f"{repeated} repeated keys"),
        ("parse_rate", not m["fetched"], "nothing was fetched"),
        ("parse_rate", m["parsed"] < LEAST_PARSE_RATE * m["fetched"], f"{m['parsed']} of {m['fetched']} parsed"),
        ("core_fields_null", m["parsed_empty"] > MOST_EMPTY_RATE * m["parsed"], f"{m['parsed_empty']} of {m['parsed']} parsed without content"),
    ]
    for rule, broken, message in rules:
        if broken:
            raise GateError(rule, message)
    warn("province missing", m["province_missing"])
    warn("crawl_date differs from dt", m["other_days"])
    warn("status other than 200", m["not_fetched"])
    return m | {"repeated_keys": repeated}


def quality_gate(silver: DataFrame, day: datetime.date) -> dict[str, int]:
    """``check_quality`` of a table."""
    return check_quality(gate_metrics(silver, day).first().asDict(), duplicate_keys(silver, *KEY).count())


def write_gated(silver: DataFrame, path: str, day: datetime.date, by: tuple[str, ...] = ("province", "dt")) -> dict[str, int]:
    """Silver to ``path`` in folders by ``by``, behind both gates; gives the metrics.

    One pass: the metrics are observed on the rows as they are written to a folder
    beside ``path``, whose partitions take their places in ``path`` once both gates
    have passed. Only the key columns of what was written are read again, for keys
    that repeat. A gate that fails, or a write that does, leaves ``path`` as it was.
    A task that ran twice may be observed twice; then the metrics are taken from
    what was written.
    """
    seen = Observation("gates")
    measures = [*quality_metrics(day), *pii_metrics(silver)]
    with Staged(silver.sparkSession, path, by) as staged:
        staged.write(silver.observe(seen, *measures))
        written = staged.read(silver.schema)
        keys = written.groupBy(*KEY).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 1)).first()
        metrics = seen.get if keys[0] else {}
        if metrics.get("n_rows") != keys[0]:
            metrics = written.agg(*measures).first().asDict()
        leaks = {k: v for k, v in metrics.items() if k.startswith("leak")}
        found = check_quality({k: v for k, v in metrics.items() if k not in leaks}, keys[1])
        check_pii(leaks)
        staged.promote()
    return found

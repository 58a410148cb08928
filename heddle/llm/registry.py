"""Queries and SQL of the corpus operators, gathered from their modules."""

from heddle.llm import ann, hardneg, mixing, packing, pii, quality, quality_rules, secrets, simhash, vecdup, warc, whitening, wordpiece

MODULES = (mixing, simhash, packing, pii, quality, secrets, vecdup, ann, wordpiece, warc, quality_rules, whitening, hardneg)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE_SQL.items()}

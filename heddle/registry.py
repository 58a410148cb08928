"""The engine's queries by name, with the SQL that each is checked against."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from heddle.queries import listings, markets, panels, texts

Query = Callable[[SparkSession, str], DataFrame]
MODULES = (panels, texts, listings, markets)


def queries() -> dict[str, Query]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """Queries without SQL (models, approximate pairs) are checked by the tests."""
    return {name: sql for module in MODULES for name, sql in module.ORACLE_SQL.items()}

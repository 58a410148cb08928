"""Vocabularies kept in YAML files: source → the source's words → our words."""

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def load_config(path: str | Path) -> dict:
    """A YAML file as a dictionary; an absent file raises FileNotFoundError."""
    import yaml

    with open(path, encoding="utf-8") as file:
        return yaml.safe_load(file)


def lookup_table(spark: SparkSession, maps: dict[str, dict[str, str]]) -> DataFrame:
    """(source, raw, value) of a vocabulary, for joins instead of expressions."""
    rows = [(source, raw, value) for source, words in maps.items() for raw, value in words.items()]
    return spark.createDataFrame(rows, "source string, raw string, value string")

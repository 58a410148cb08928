"""Readers and writers."""

from heddle.sources.tables import table

__all__ = ["table"]

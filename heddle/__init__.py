"""Heddle: a PySpark-native engine for listing, panel and corpus analytics."""

"""Structured Streaming forms of the daily jobs."""

from heddle.streaming.bronze import failure_streaks, probe_stream, read_bronze_stream, silver_stream
from heddle.streaming.silence import silence_stream, silences

__all__ = ["failure_streaks", "probe_stream", "read_bronze_stream", "silence_stream", "silences", "silver_stream"]

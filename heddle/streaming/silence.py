"""Listings that fall silent: absences without a row that says so, from state with event-time timers."""

import datetime
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from heddle.operators.frontier import FAILURES

SILENCES = "listing_id string, last_seen date, gone_date date"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EPOCH, DAY_MS = datetime.date(1970, 1, 1), 86_400_000


def silences(seen: DataFrame, until: datetime.date, key: str = "listing_id", day: str = "day") -> DataFrame:
    """(key, last_seen, gone_date) of each run of two or more days without a row ``(key, day)``, as known at the end of ``until``.

    ``gone_date`` is the second silent day. A key comes once for each of its silences.
    """
    days = seen.where(F.col(key).isNotNull() & F.col(day).isNotNull()).select(key, F.col(day).cast("date").alias("last_seen")).distinct()
    after = F.lead("last_seen").over(Window.partitionBy(key).orderBy("last_seen"))
    gone = F.date_add("last_seen", FAILURES)
    rows = days.withColumn("_next", after).withColumn("gone_date", gone)
    return rows.where(F.coalesce(F.col("_next") > F.col("gone_date"), F.col("gone_date") <= F.lit(until))).drop("_next")


class Silence(StatefulProcessor):
    """By listing: the last day it was seen that the watermark has settled, and days seen since then, at most as many as the lateness has.

    A timer stands at the end of the second day after the last one. It fires
    without a row arriving, once the watermark says that none can. A listing that
    has been gone for ``forget`` days leaves no state behind.
    """

    def __init__(self, forget: int):
        self.forget = forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("seen", "last int, gone boolean, later array<int>")

    def close(self) -> None:
        pass

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, gone, later = self._read()
        days = {int(d) for batch in rows for d in batch["day"].dropna()}
        if last is None and days:
            # the first day seen is settled at once; an earlier one that comes late takes its place below
            last = min(days)
        if last is not None:
            later = set(later) | days
            early = min(later)
            if not gone and early < last:
                later, last = later | {last}, early
            yield from self._advance(key, last, gone, later, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, gone, later = self._read()
        if last is not None:
            yield from self._advance(key, last, gone, later, timerValues.getCurrentWatermarkInMs())

    def _read(self) -> tuple[int | None, bool, set[int]]:
        if not self.state.exists():
            return None, False, set()
        last, gone, later = self.state.get()
        return last, gone, set(later)

    def _advance(self, key: tuple, last: int, gone: bool, later: set[int], watermark: int) -> Iterator[pd.DataFrame]:
        """Settle what the watermark has passed, write the state and set the next timer."""
        found = []
        while True:
            # within reach of the last day the listing is still there; a day beyond is a return
            later = {d for d in later if d > (last + FAILURES if gone else last)}
            after = min(later, default=None)
            if gone:
                if after is None:
                    break
                last, gone = after, False
            elif self._due(last) > watermark:
                break
            elif after is not None and after <= last + FAILURES:
                last = after
            else:
                found.append((key[0], last, last + FAILURES))
                gone = True
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        due = self._due(last) + (self.forget * DAY_MS if gone else 0)
        if gone and due <= watermark:
            self.state.clear()
        else:
            self.state.update((last, gone, sorted(later)))
            self.handle.registerTimer(due)
        if found:
            rows = [(name, EPOCH + datetime.timedelta(days=a), EPOCH + datetime.timedelta(days=b)) for name, a, b in found]
            yield pd.DataFrame(rows, columns=["listing_id", "last_seen", "gone_date"])

    @staticmethod
    def _due(last: int) -> int:
        """When the second day after a day ends, in milliseconds."""
        return (last + FAILURES + 1) * DAY_MS


def silence_stream(probes: DataFrame, lateness: str = "2 days", forget: int = 30) -> DataFrame:
    """The same from a stream of probes ``(listing_id, ts, present)``, a row as soon as the watermark settles a silence.

    Absences that are reported count like those that aren't: only days seen matter.
    Rows later than ``lateness`` are dropped. The order of arrival within it
    doesn't matter. A null id, time or presence is no sighting.
    """
    # timers and their state need this store; a setting of the session, as there is none for a single stream
    probes.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    marked = probes.select("listing_id", F.col("ts").cast("timestamp").alias("ts"), "present").withWatermark("ts", lateness)
    # probes without a sighting still move the watermark
    seen = marked.where("listing_id is not null and present").select("listing_id", "ts", F.unix_date(F.to_date("ts")).alias("day"))
    return seen.groupBy("listing_id").transformWithStateInPandas(Silence(forget), SILENCES, "Append", "EventTime")

"""Stateful change detection over a stream of snapshots.

A stateful processor per stream id (``transformWithState``, RocksDB state). Polls may arrive in
any order within the watermark's delay: a poll waits in a list state until the watermark passes it, and
only then is it compared with the stream's previous poll, so the events are those of the batch detector
whatever the order of files. The polls of a stream that arrive in one micro-batch are appended to the list as
one element, without reading the list. One timer per
stream, at its oldest waiting poll, settles what the watermark has passed; without waiting polls the
timer is the idle limit, at which the stream's state goes. Polls later than the watermark's delay never
reach the processor: Spark drops them and counts them in the query progress, see :func:`dropped_rows`.

The state of a stream is its previous poll and the polls of one watermark delay (plus those of one
micro-batch). A poll leaves the state one watermark delay after its time; ``availableNow`` therefore ends
with the newest polls still waiting, and the next run continues from there.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta, timezone
from itertools import islice
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from livepulse.functions.constants import GAME_CHANGE, IDLE_HOURS, TITLE_CHANGE
from livepulse.schemas import LAST_POLL, TRANSITIONS, WAITING_POLLS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT_COLS = [f.name for f in TRANSITIONS.fields]
EVENT = Row(*OUT_COLS)
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
CHUNK = 10_000        # polls of one stream in an element of its list state at most


def _changes(key: str, last: tuple | None, polls: Iterable[tuple], idle_us: int, null_text: str | None) -> Iterator[Row]:
    """Events between neighbouring polls (sorted by time; ``last`` is the settled poll before them, the baseline)."""
    text = (lambda v: v) if null_text is None else (lambda v: null_text if v is None else v)
    for poll in polls:
        if last is not None and poll[0] - last[0] <= idle_us:
            for kind, at in ((GAME_CHANGE, 1), (TITLE_CHANGE, 2)):
                if poll[at] != last[at]:                                # None equals None
                    delta = None if poll[3] is None or last[3] is None else poll[3] - last[3]
                    yield EVENT(key, poll[4], kind, text(last[at]), text(poll[at]), EPOCH + timedelta(microseconds=poll[0]), delta)
        last = poll


def _arrays(us, game, title, viewers, user) -> tuple:
    """Polls as one element of the waiting list: a list per column."""
    return list(us), list(game), list(title), list(viewers), list(user)


def _events(key: str, polls: tuple, idle_us: int, null_text: str | None) -> pd.DataFrame:
    """Events of one stream's polls (``_arrays``, sorted by time; the first one is the baseline) as a frame, outside a stream."""
    return pd.DataFrame(list(_changes(key, None, zip(*polls), idle_us, null_text)), columns=OUT_COLS)


class ChangeDetector(StatefulProcessor):
    """Events of one stream id, in the order of its polls. Every call of the state is a message to the JVM and back, and
    a run makes them for each stream and micro-batch, so a state is read once and written only where it changes."""

    def __init__(self, idle_hours: float = IDLE_HOURS, null_text: str | None = None):
        self.idle_us, self.null_text = int(idle_hours * 3600 * 1_000_000), null_text

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", LAST_POLL)
        self.waiting = handle.getListState("waiting", WAITING_POLLS)
        self.timer = handle.getValueState("timer", "ms long")

    def _set_timer(self, ms: int) -> None:
        self.handle.registerTimer(ms)
        self.timer.update((ms,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        oldest = None
        while polls := [(r.us, r.game_name, r.title, r.viewer_count, r.user_name) for r in islice(rows, CHUNK)]:
            self.waiting.appendValue(_arrays(*zip(*polls)))
            first = min(p[0] for p in polls)
            oldest = first if oldest is None else min(first, oldest)
        if oldest is not None:
            due = max(-(-oldest // 1000), timerValues.getCurrentWatermarkInMs() + 1)
            timer = self.timer.get()
            if timer is None or due < timer[0]:
                if timer is not None:
                    self.handle.deleteTimer(timer[0])
                self._set_timer(due)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark_us = timerValues.getCurrentWatermarkInMs() * 1000
        last = self.last.get()
        polls = [poll for pack in self.waiting.get() for poll in zip(*pack)]
        polls.sort(key=itemgetter(0))                                   # the last settled poll is older than any waiting
        n = bisect_right(polls, mark_us, key=itemgetter(0))
        if n:
            yield from _changes(str(key[0]), last, polls[:n], self.idle_us, self.null_text)
            last = polls[n - 1][:4]
        if n < len(polls):
            if n:
                self.last.update(last)
                self.waiting.put([_arrays(*zip(*polls[i:i + CHUNK])) for i in range(n, len(polls), CHUNK)])
            due_us = polls[n][0]
        else:
            if n:
                self.waiting.clear()
            due_us = last[0] + self.idle_us if last is not None else 0
            if due_us <= mark_us:                                       # idle for too long: forgotten
                self.last.clear()
                self.timer.clear()
                return
            if n:
                self.last.update(last)
        self._set_timer(max(-(-due_us // 1000), mark_us // 1000 + 1))


def use_rocksdb(spark: SparkSession) -> None:
    """The state store the detector needs; a session setting that a query's first start writes to its checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def detect_transitions_stream(snapshots: DataFrame, watermark: str = "1 hour",
                              idle_hours: float = IDLE_HOURS, null_text: str | None = None) -> DataFrame:
    """Streaming change detection; snapshots need stream_id, user_name, game_name,
    title, viewer_count, ingestion_ts. Rows without a stream id or poll time cannot be
    ordered and are left out. ``watermark`` is how late a poll may arrive; a poll's events
    appear once the watermark has passed it."""
    use_rocksdb(snapshots.sparkSession)
    s = (snapshots.select("stream_id", "user_name", F.col("game_name").cast("string").alias("game_name"),
                          F.col("title").cast("string").alias("title"),
                          F.col("viewer_count").cast("long").alias("viewer_count"),
                          F.col("ingestion_ts").cast("timestamp").alias("ingestion_ts"))
         .where(F.col("stream_id").isNotNull() & F.col("ingestion_ts").isNotNull())
         .withColumn("us", F.unix_micros("ingestion_ts"))
         .withWatermark("ingestion_ts", watermark))
    return s.groupBy("stream_id").transformWithState(
        ChangeDetector(idle_hours, null_text), TRANSITIONS, "Append", "EventTime")


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that came later than the watermark's delay, summed over the progress the query
    still remembers (``spark.sql.streaming.numRecentProgressUpdates`` micro-batches)."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) if isinstance(op, dict) else int(op.numRowsDroppedByWatermark)
               for p in query.recentProgress for op in (p["stateOperators"] if isinstance(p, dict) else p.stateOperators))

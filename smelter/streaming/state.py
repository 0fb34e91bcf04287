"""Custom per-user state with ``transformWithState`` (needs the RocksDB state store).

All state of one user lives in one task. Before the shuffle, every Arrow batch of events is therefore
combined to one row per user (or the few latest events of each), without any state: however many events a
user has, now or later, the user's task gets one such row per batch. What is done per user goes over rows, as a
data frame per user costs far more than the state. The processors are built inside functions, so Spark sends
them to the executors by value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# The setting that chooses the state store, and the store to choose.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

COUNT_SCHEMA = "user_id bigint, n_events bigint, total_value double"
IDLE_SCHEMA = "user_id bigint, n_events bigint"
CLOSED_SCHEMA = "user_id bigint, first array<bigint>, last array<bigint>, n array<bigint>"
LATEST_SCHEMA = "user_id bigint, event_ids array<bigint>, times array<bigint>"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Start queries with the RocksDB state store, and leave the session as it was."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)


def _combined(events: DataFrame, columns: list[str], combine: Callable[[pd.DataFrame], pd.DataFrame],
              schema: str) -> DataFrame:
    """Every Arrow batch of events combined on its own; ids travel as strings, which NULL leaves exact."""
    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield combine(frame)

    sent = events.select(F.col("user_id").cast("string"), *columns)
    return sent.mapInPandas(each, f"user_id string, {schema}").withColumn("user_id", F.col("user_id").cast("bigint"))


def _track(combined: DataFrame, processor: StatefulProcessor, schema: str, time_mode: str = "None") -> DataFrame:
    return combined.groupBy("user_id").transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode="Update", timeMode=time_mode)


def event_counts(events: DataFrame) -> DataFrame:
    """Count and sum of each user's events so far."""

    class Counter(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self._totals = handle.getValueState("totals", "n bigint, total double")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            n, total = self._totals.get() or (0, 0.0)
            for row in rows:
                n += row.n
                total += row.total or 0.0
            self._totals.update((n, total))
            yield Row(user_id=key[0], n_events=n, total_value=total)

        def close(self) -> None:
            pass

    def combine(frame: pd.DataFrame) -> pd.DataFrame:
        users = frame.groupby("user_id", dropna=False, as_index=False)
        return users.agg(n=("value", "size"), total=("value", "sum"))

    return _track(_combined(events, ["value"], combine, "n bigint, total double"), Counter(), COUNT_SCHEMA)


def latest_events(events: DataFrame, keep: int) -> DataFrame:
    """Ids and times of each user's latest ``keep`` events, oldest first; events without a time are
    the first to go, and come last."""

    class Latest(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self._latest = handle.getValueState("latest", "micros array<bigint>, event_ids array<bigint>")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            known = list(zip(*(self._latest.get() or ())))
            for row in rows:
                known.append((row.micros, row.event_id))
                if len(known) > 100 * keep:
                    known = sorted(known, key=in_time)[-keep:]
            newest = sorted(known, key=in_time)[-keep:]
            times, ids = map(list, zip(*sorted(newest, key=lambda event: event[0] is None)))
            self._latest.update((times, ids))
            yield Row(user_id=key[0], event_ids=ids, times=times)

        def close(self) -> None:
            pass

    def in_time(event: tuple[int | None, int | None]) -> tuple:
        return tuple((v is not None, v or 0) for v in event)

    def combine(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.sort_values(["micros", "event_id"], na_position="first").groupby("user_id", dropna=False).tail(keep)

    timed = events.withColumn("micros", F.unix_micros("ts"))
    found = _track(_combined(timed, ["micros", "event_id"], combine, "micros bigint, event_id bigint"), Latest(), LATEST_SCHEMA)
    return found.withColumn("times", F.transform("times", F.timestamp_micros))


def idle_users(events: DataFrame, idle_ms: int) -> DataFrame:
    """A row per user who has had no event for ``idle_ms`` of processing time.

    Every batch with events of a user moves the user's one timer. A query with timers only
    ends when it is stopped.
    """

    class Idle(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self._handle = handle
            self._seen = handle.getValueState("seen", "n bigint, timer bigint")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            n, timer = self._seen.get() or (0, None)
            if timer is not None:
                self._handle.deleteTimer(timer)
            timer = timerValues.getCurrentProcessingTimeInMs() + idle_ms
            self._handle.registerTimer(timer)
            self._seen.update((n + sum(row.n for row in rows), timer))
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            n, _ = self._seen.get()
            self._seen.clear()
            yield Row(user_id=key[0], n_events=n)

        def close(self) -> None:
            pass

    def combine(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.groupby("user_id", dropna=False, as_index=False).agg(n=("event_id", "size"))

    return _track(_combined(events, ["event_id"], combine, "n bigint"), Idle(), IDLE_SCHEMA, "ProcessingTime")


def merged_spans(spans: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """Spans (first, last, count) in order, joined where one begins at most ``gap`` after the last ended."""
    out: list[tuple[int, int, int]] = []
    for first, last, n in sorted(spans):
        if out and first - out[-1][1] <= gap:
            before = out.pop()
            first, last, n = before[0], max(before[1], last), before[2] + n
        out.append((first, last, n))
    return out


def closed_activities(events: DataFrame, idle_ms: int) -> DataFrame:
    """A row per activity of a user, once no event has followed its last one for ``idle_ms`` of event time.

    ``events`` has a watermark on ``ts``, and event-time timers fire when it passes them. A user's open activities are one
    value of the state, in order, and the user has one timer, for the first of them to end; when it fires, all that the watermark has
    passed are closed at once, in one row, and the timer moves on to the next. Late events within the watermark's delay may still
    join two of them or come before them. Every Arrow batch is combined to spans of activity before the shuffle.
    A query over a finite source ends by itself, and leaves what the watermark has not passed in the state.
    """

    class Activities(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self._handle = handle
            self._open = handle.getValueState("open", "first array<bigint>, last array<bigint>, n array<bigint>")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            known = list(zip(*(self._open.get() or ())))
            spans = merged_spans(known + [(row.first, row.last, row.n) for row in rows], idle_ms)
            self._open.update(tuple(map(list, zip(*spans))))
            before, now = first_end(known), first_end(spans)
            if before != now:
                if before is not None:
                    self._handle.deleteTimer(before)
                self._handle.registerTimer(now)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            known = list(zip(*(self._open.get() or ())))
            upto = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
            still = [span for span in known if span[1] + idle_ms > upto]
            done = [span for span in known if span[1] + idle_ms <= upto]
            if still:
                self._open.update(tuple(map(list, zip(*still))))
                self._handle.registerTimer(first_end(still))
            else:
                self._open.clear()
            if done:
                first, last, n = map(list, zip(*done))
                yield Row(user_id=key[0], first=first, last=last, n=n)

        def close(self) -> None:
            pass

    def first_end(spans: list[tuple[int, int, int]]) -> int | None:
        return min((last + idle_ms for _, last, _ in spans), default=None)

    def combine(frame: pd.DataFrame) -> pd.DataFrame:
        # In order, a span begins where the user changes or the gap is too long.
        codes, users = pd.factorize(frame["user_id"], use_na_sentinel=False)
        ordered = frame.assign(code=codes).sort_values(["code", "at"])
        fresh = (ordered["code"] != ordered["code"].shift()) | (ordered["at"].diff() > idle_ms)
        spans = ordered.groupby(fresh.cumsum()).agg(
            code=("code", "first"), first=("at", "first"), last=("at", "last"), n=("at", "size"))
        return spans.assign(user_id=users.take(spans["code"])).drop(columns="code")

    timed = events.filter(F.col("ts").isNotNull()).withColumn("at", F.unix_millis("ts"))
    closed = _track(_combined(timed, ["at"], combine, "first bigint, last bigint, n bigint"), Activities(), CLOSED_SCHEMA, "EventTime")
    return closed.select("user_id", F.inline(F.arrays_zip("first", "last", "n"))).select(
        "user_id", F.timestamp_millis("first").alias("started_at"), F.timestamp_millis("last").alias("last_at"),
        F.col("n").alias("n_events"))

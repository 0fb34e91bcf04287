from __future__ import annotations

import datetime as dt
import time

import pytest
from conftest import SMALL
from pyspark.sql import Row
from pyspark.sql import functions as F

from smelter.operators.sessions import sessions
from smelter.sources.readers import table
from smelter.streaming import state
from smelter.streaming.sinks import (
    compact_upserted,
    read_split,
    read_totals,
    read_upserted,
    split_late_into,
    start_batches,
    start_files,
    totals_into,
    upsert_into,
)
from smelter.streaming.sources import bronze_stream, file_stream, parse_messages, with_event_time
from smelter.streaming.windows import drop_replays, session_windows, time_windows

SCHEMA = "event_id bigint, user_id bigint, ts timestamp, value double"


def at(hour, minute=0, day=1):
    return dt.datetime(2024, 1, day, hour, minute)


class Folder:
    """A source folder to drop files into, with places for results and checkpoints."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path
        self.source, self.out, self.state = str(path / "in"), str(path / "out"), str(path / "state")
        (path / "in").mkdir()
        self.dropped = 0

    def drop(self, rows):
        # A later modification time makes a later file: the source reads in that order.
        time.sleep(0.05)
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.source)

    def stream(self, **options):
        return file_stream(self.spark, self.source, SCHEMA, **options)

    def result(self):
        return self.spark.read.parquet(self.out)


@pytest.fixture
def folder(spark, tmp_path):
    return Folder(spark, tmp_path)


def test_second_run_reads_only_new_files(folder):
    folder.drop([(1, 1, at(1), 1.0)])

    def run():
        query = start_files(bronze_stream(folder.stream()), folder.out, folder.state)
        query.awaitTermination()
        return sum(p.numInputRows for p in query.recentProgress)

    assert run() == 1
    assert run() == 0
    folder.drop([(2, 1, at(2), 1.0), (3, 1, at(2), 1.0)])
    assert run() == 2
    assert folder.result().select("event_id").distinct().count() == folder.result().count() == 3
    assert folder.result().filter("_ingested_at IS NULL OR _source_file NOT LIKE '%.parquet'").count() == 0


def test_late_rows_are_dropped(folder):
    # The second batch closes the first hour's window; a row for it in the third is late.
    folder.drop([(1, 1, at(1), 1.0), (2, 1, at(5), 1.0)])
    folder.drop([(4, 1, at(5, 30), 1.0)])
    folder.drop([(3, 1, at(1, 30), 100.0), (5, 1, at(9), 1.0)])
    timed = folder.stream(files_per_trigger=1).withWatermark("ts", "10 minutes")
    query = start_files(time_windows(timed, "user_id", "value", "1 hour"), folder.out, folder.state)
    query.awaitTermination()
    found = {r.window_start.hour: (r.n_events, r.total_value) for r in folder.result().collect()}
    assert found == {1: (1, 1.0), 5: (2, 2.0)}
    assert sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators) == 1


@pytest.mark.parametrize("slide", [None, "30 minutes"])
def test_complete_mode_equals_batch(spark, folder, slide):
    rows = [(i, i % 3, at(i % 20, i * 7 % 60, 1 + i % 2), float(i)) for i in range(60)]
    folder.drop(rows[:30])
    folder.drop(rows[30:])
    totals = time_windows(folder.stream(files_per_trigger=1), "user_id", "value", "1 hour", slide)
    query = start_batches(totals, lambda batch, _: batch.write.mode("overwrite").parquet(folder.out),
                          folder.state, "complete")
    query.awaitTermination()
    batch = time_windows(spark.createDataFrame(rows, SCHEMA), "user_id", "value", "1 hour", slide)
    assert sorted(map(tuple, folder.result().collect())) == sorted(map(tuple, batch.collect()))


def test_update_mode_gives_changed_groups(folder):
    folder.drop([(1, 1, at(1), 1.0), (2, 2, at(1), 1.0)])
    folder.drop([(3, 2, at(1), 5.0)])
    changes = []
    totals = folder.stream(files_per_trigger=1).groupBy("user_id").agg(F.sum("value").alias("total"))
    start_batches(totals, lambda batch, n: changes.append((n, sorted(map(tuple, batch.collect())))),
                  folder.state, "update").awaitTermination()
    assert changes == [(0, [(1, 1.0), (2, 1.0)]), (1, [(2, 6.0)])]


def test_processing_time_trigger(folder):
    folder.drop([(1, 1, at(1), 1.0)])
    query = start_files(folder.stream(), folder.out, folder.state, trigger={"processingTime": "1 second"})
    try:
        query.processAllAvailable()
        folder.drop([(2, 1, at(2), 1.0)])
        query.processAllAvailable()
        assert folder.result().count() == 2
    finally:
        query.stop()


def test_replays_within_the_delay(folder):
    folder.drop([(1, 1, at(1), 1.0), (2, 1, at(1, 5), 1.0), (1, 1, at(1), 1.0)])
    folder.drop([(2, 1, at(1, 5), 1.0), (3, 1, at(1, 6), 1.0)])
    once = drop_replays(folder.stream(files_per_trigger=1), ["event_id"], "1 hour")
    start_files(once, folder.out, folder.state).awaitTermination()
    assert sorted(r.event_id for r in folder.result().collect()) == [1, 2, 3]


def test_upsert_writes_only_its_rows_and_can_repeat(spark, folder):
    keys, order = ["user_id"], [F.desc("ts"), F.desc("event_id")]
    write = upsert_into(folder.out, keys, order)
    write(spark.createDataFrame([(i, i, at(1), 1.0) for i in range(20)], SCHEMA), 0)
    files = {f: f.stat().st_mtime_ns for f in folder.path.glob("out/*/*.parquet")}
    later = spark.createDataFrame([(30, 3, at(2), 7.0), (31, 3, at(0), 9.0)], SCHEMA)
    write(later, 1)
    write(later, 1)
    assert all(f.stat().st_mtime_ns == t for f, t in files.items())
    assert spark.read.parquet(folder.out).filter("_batch_id = 1").count() == 1
    merged = read_upserted(spark, folder.out, keys, order)
    rows = {r.user_id: (r.event_id, r.value) for r in merged.collect()}
    assert len(rows) == merged.count() == 20
    assert rows[3] == (30, 7.0) and rows[4] == (4, 1.0)
    compact_upserted(spark, folder.out, f"{folder.path}/compact", keys, order)
    assert sorted(read_upserted(spark, f"{folder.path}/compact", keys, order).collect()) == sorted(merged.collect())


def test_a_failed_upsert_loses_nothing(spark, folder):
    keys, order = ["user_id"], [F.desc("ts"), F.desc("event_id")]
    write = upsert_into(folder.out, keys, order)
    write(spark.createDataFrame([(i, i, at(1), 1.0) for i in range(20)], SCHEMA), 0)
    later = spark.createDataFrame([(30, 3, at(2), 7.0), (32, 40, at(2), 8.0)], SCHEMA)
    broken = later.withColumn("value", F.when(F.col("user_id") == 40, F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        write(broken, 1)
    write(later, 1)
    rows = {r.user_id: r.value for r in read_upserted(spark, folder.out, keys, order).collect()}
    assert len(rows) == 21 and rows[3] == 7.0 and rows[40] == 8.0 and rows[4] == 1.0


def test_messages(spark):
    raw = spark.createDataFrame(
        [(b"k1", b'{"user_id": 4, "action": "buy"}', at(1)), (None, b"broken", at(2)), (b"k3", None, at(3))],
        "key binary, value binary, timestamp timestamp")
    rows = parse_messages(raw, "user_id bigint, action string").orderBy("_message_at").collect()
    assert [(r._key, r.user_id, r.action, r._dq_json_valid) for r in rows] == [
        ("k1", 4, "buy", True), (None, None, None, False), ("k3", None, None, False)]


def test_watermark_takes_the_events_table(spark):
    events = with_event_time(table(spark, SMALL, "events"))
    assert dict(events.dtypes)["ts"] == "timestamp"
    assert events.withWatermark("ts", "10 minutes").count() == 1000


def test_idle_users(spark, folder):
    folder.drop([(1, 1, at(1), 1.0), (2, 1, at(2), 1.0), (3, 2, at(1), 1.0)])
    with state.rocksdb_state(spark):
        idle = state.idle_users(folder.stream(), 1000)
        query = start_batches(idle, lambda batch, _: batch.write.mode("append").parquet(folder.out),
                              folder.state, "update", {"processingTime": "1 second"})
    try:
        deadline = time.monotonic() + 120
        rows = []
        while not rows and time.monotonic() < deadline:
            time.sleep(1)
            if any(folder.path.glob("out/_SUCCESS")):
                rows = folder.result().collect()
    finally:
        query.stop()
    assert sorted((r.user_id, r.n_events) for r in rows) == [(1, 2), (2, 1)]
    assert spark.conf.get(state.STATE_STORE) != state.ROCKSDB


def test_a_busy_user_is_never_idle(spark, folder):
    """Many events of one user in every batch, spread over all partitions; another user stops."""
    folder.drop([(1, 9, at(1), 1.0)])
    with state.rocksdb_state(spark):
        query = start_batches(state.idle_users(folder.stream(), 9000),
                              lambda batch, _: batch.write.mode("append").parquet(folder.out),
                              folder.state, "update", {"processingTime": "1 second"})
    try:
        deadline, number, users = time.monotonic() + 120, 100, set()
        while 9 not in users and time.monotonic() < deadline:
            folder.drop([(number + i, 2, at(2), 1.0) for i in range(50)])
            number += 50
            time.sleep(2)
            if any(folder.path.glob("out/_SUCCESS")):
                users = {r.user_id for r in folder.result().collect()}
    finally:
        query.stop()
    assert users == {9}


def test_session_windows_merge(spark, folder):
    rows = [(i, i % 2, at(1 + i // 3, i * 17 % 60), float(i)) for i in range(40)]
    folder.drop(rows[::2])
    folder.drop(rows[1::2] + [(99, 7, at(23, 59), 0.0)])
    grown = session_windows(folder.stream(files_per_trigger=1).withWatermark("ts", "1 day"), "user_id", "value", "30 minutes")
    start_batches(grown, totals_into(folder.out), folder.state, "complete").awaitTermination()
    batch = sessions(spark.createDataFrame(rows + [(99, 7, at(23, 59), 0.0)], SCHEMA), ["user_id"], "value", 1800)
    found = read_totals(spark, folder.out).select("user_id", "window_start", "window_end", "n_events", "total_value")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, batch.collect()))


def test_totals_are_read_whole_and_replayed(spark, folder):
    write = totals_into(folder.out)
    with pytest.raises(ValueError):
        read_totals(spark, folder.out)
    for n in range(4):
        write(spark.range(n + 1), n)
    write(spark.range(4), 3)
    assert read_totals(spark, folder.out).count() == 4
    assert sorted(p.name for p in folder.path.glob("out/*")) == ["_batch_id=2", "_batch_id=3"]
    # A batch that broke while it was written is not read.
    spark.range(9).write.parquet(f"{folder.out}/_batch_id=4")
    (folder.path / "out/_batch_id=4/_SUCCESS").unlink()
    assert read_totals(spark, folder.out).count() == 4
    write(spark.range(5), 4)
    assert read_totals(spark, folder.out).count() == 5


def test_late_rows_are_kept_apart(spark, folder):
    folder.drop([(1, 1, at(5), 1.0), (2, 1, at(1), 1.0)])
    folder.drop([(3, 1, at(4, 40), 1.0), (4, 1, at(4, 55), 1.0), (5, 1, None, 1.0)])
    folder.drop([(6, 1, at(4, 50), 1.0), (7, 1, at(9), 1.0), (8, 1, at(4), 1.0)])
    write = split_late_into(folder.out, "10 minutes")
    batches = {}

    def noted(batch, n):
        batches[n] = [tuple(r) for r in batch.collect()]
        write(batch, n)

    start_batches(folder.stream(files_per_trigger=1), noted, folder.state).awaitTermination()

    def sides():
        return [sorted(r.event_id for r in read_split(spark, folder.out, late).collect()) for late in (False, True)]

    assert sides() == [[1, 2, 4, 5, 6, 7], [3, 8]]
    # A batch seen again splits as it did before, though later ones have been seen.
    write(spark.createDataFrame(batches[1], SCHEMA), 1)
    assert sides() == [[1, 2, 4, 5, 6, 7], [3, 8]]


def test_spans_join_within_the_gap():
    assert state.merged_spans([(50, 60, 2), (0, 10, 1), (20, 30, 1)], 10) == [(0, 30, 2), (50, 60, 2)]
    assert state.merged_spans([(0, 5, 1), (1, 2, 3), (16, 16, 1)], 10) == [(0, 5, 4), (16, 16, 1)]
    assert state.merged_spans([], 10) == []


def test_activities_close_behind_the_watermark(spark, folder):
    folder.drop([(1, 1, at(1), 1.0), (2, 1, at(1, 20), 1.0), (3, 2, at(1, 5), 1.0), (9, None, at(1), 1.0), (10, 3, None, 1.0)])
    folder.drop([(4, 1, at(1, 45), 1.0), (5, 2, at(3), 1.0)])
    folder.drop([(6, 2, at(3, 10), 1.0), (7, 1, at(4), 1.0)])

    def run():
        with state.rocksdb_state(spark):
            timed = folder.stream(files_per_trigger=1).withWatermark("ts", "10 minutes")
            start_batches(state.closed_activities(timed, 1_800_000), upsert_into(folder.out, ["user_id", "started_at"], [F.desc("n_events")]),
                          folder.state, "update").awaitTermination()
        found = read_upserted(spark, folder.out, ["user_id", "started_at"], [F.desc("n_events")])
        return {(r.user_id, r.started_at, r.last_at, r.n_events) for r in found.collect()}

    closed = {(1, at(1), at(1, 45), 3), (2, at(1, 5), at(1, 5), 1), (None, at(1), at(1), 1), (2, at(3), at(3, 10), 2)}
    assert run() == closed
    folder.drop([(8, 2, at(9), 1.0)])
    assert run() == closed | {(1, at(4), at(4), 1)}


class Handle:
    """A processor's handle that keeps one user's value and timers in plain sight."""

    def __init__(self):
        self.value, self.timers = None, []

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def processor_of(spark, monkeypatch, build):
    """The processor that ``build`` gives to Spark, with a handle of its own."""
    taken = []
    with monkeypatch.context() as patched:
        patched.setattr(state, "_track", lambda rows, processor, schema, *_: taken.append(processor) or spark.createDataFrame([], schema))
        build(spark.createDataFrame([], SCHEMA))
    handle = Handle()
    taken[0].init(handle)
    return taken[0], handle


def test_a_user_has_one_timer_however_many_activities(spark, monkeypatch):
    activities, handle = processor_of(spark, monkeypatch, lambda events: state.closed_activities(events, 10))
    list(activities.handleInputRows((1,), iter([Row(first=i * 100, last=i * 100 + 5, n=2) for i in range(50)]), None))
    assert handle.timers == [15]

    class Now:
        getCurrentWatermarkInMs = staticmethod(lambda: 3015)
        getExpiryTimeInMs = staticmethod(lambda: 15)

    closed = list(activities.handleExpiredTimer((1,), Now, Now))
    handle.deleteTimer(15)  # as Spark does
    assert closed == [Row(user_id=1, first=[i * 100 for i in range(31)], last=[i * 100 + 5 for i in range(31)], n=[2] * 31)]
    assert handle.timers == [3115]
    list(activities.handleInputRows((1,), iter([Row(first=3090, last=3095, n=1)]), None))
    assert handle.timers == [3115] and handle.value[2][:2] == [3, 2]


def test_latest_events_go_over_rows(spark, monkeypatch):
    latest, handle = processor_of(spark, monkeypatch, lambda events: state.latest_events(events, 2))
    many = [Row(micros=i * 7 % 1000, event_id=i) for i in range(1000)]
    assert list(latest.handleInputRows((1,), iter(many), None)) == [Row(user_id=1, event_ids=[714, 857], times=[998, 999])]
    assert list(latest.handleInputRows((1,), iter([Row(micros=998, event_id=900)]), None)) == [
        Row(user_id=1, event_ids=[900, 857], times=[998, 999])]


def test_user_ids_stay_exact_beside_null(spark, folder):
    folder.drop([(1, 2**53 + 1, at(1), 1.0), (2, None, at(2), 1.0), (3, 2**53, at(3), 1.0)])
    with state.rocksdb_state(spark):
        start_batches(state.latest_events(folder.stream(), 3), upsert_into(folder.out, ["user_id"], [F.desc("times")]),
                      folder.state, "update").awaitTermination()
    found = read_upserted(spark, folder.out, ["user_id"], [F.desc("times")]).collect()
    assert sorted((r.user_id or 0, r.event_ids, r.times) for r in found) == [
        (0, [2], [at(2)]), (2**53, [3], [at(3)]), (2**53 + 1, [1], [at(1)])]


def test_events_without_user_or_time(spark, folder):
    """Users are told apart from NULL, and events without a time are kept only where there are too few others."""
    rows = [(i, None if i % 3 == 0 else 5, at(1, i), 1.0) for i in range(12)]
    folder.drop(rows[:7] + [(20, 5, None, 1.0), (21, 6, None, 1.0), (22, 6, at(2), 1.0)])
    folder.drop(rows[7:])

    def run(latest, out, order):
        with state.rocksdb_state(spark):
            start_batches(latest, upsert_into(out, ["user_id"], order), f"{out}-state", "update").awaitTermination()
        return {r[0]: r[1] for r in read_upserted(spark, out, ["user_id"], order).collect()}

    stream = folder.stream(files_per_trigger=1)
    order = [F.desc(F.array_max("times")), F.desc(F.size("times")), F.desc(F.reverse("times"))]
    assert run(state.latest_events(stream, 3), f"{folder.out}-latest", order) == {None: [3, 6, 9], 5: [8, 10, 11], 6: [22, 21]}
    assert run(state.event_counts(stream), f"{folder.out}-counts", [F.desc("n_events")]) == {None: 4, 5: 9, 6: 2}

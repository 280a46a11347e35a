"""Streaming loads: exactly once, late rows, agreement with the batch answer."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions.columns import day_of
from tidemark.operators.committed import CommittedTable, read_committed
from tidemark.operators.windows import latest_per_key
from tidemark.session import scratch_path
from tidemark.streaming import loads as L

SCHEMA = "id int, city string, ts timestamp_ntz, value double"


def t(hour, minute=0, day=1):
    return datetime(2024, 1, day, hour, minute)


@pytest.fixture
def feed(spark, frame):
    """A landing folder that grows by one file per call."""
    path = scratch_path(spark, "landing")

    def land(data):
        frame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)

    land.stream = lambda: L.landing_stream(spark, path, frame([], SCHEMA).schema, max_files=1)
    return land


@pytest.fixture
def dim(frame):
    return frame([(7, "a", True), (8, "b", True), (6, "a", False)], "sk int, nk string, is_current boolean")


def test_fact_load_takes_each_reading_once(spark, feed, dim):
    out, checkpoint = scratch_path(spark, "fact"), scratch_path(spark, "offsets")

    def run():
        L.stream_fact_load(feed.stream(), dim, {"city": "nk"}, "sk", "ts", ["id", "value"], out, checkpoint)
        return rows(spark.read.parquet(out), "sk", "date_sk", "id")

    feed([(1, "a", t(1), 1.0), (2, "z", t(1), 1.0)])
    assert run() == [(7, 20240101, 1)]
    assert run() == [(7, 20240101, 1)]
    feed([(3, "b", t(2), 2.0)])
    assert run() == [(7, 20240101, 1), (8, 20240101, 3)]


def test_no_new_files_start_no_batch(spark, feed, dim):
    out, checkpoint = scratch_path(spark, "fact"), scratch_path(spark, "offsets")
    feed([(1, "a", t(1), 1.0)])
    args = (dim, {"city": "nk"}, "sk", "ts", ["id"], out, checkpoint)
    first = L.stream_fact_load(feed.stream(), *args)
    again = L.stream_fact_load(feed.stream(), *args)
    assert first.lastProgress["numInputRows"] == 1
    assert again.lastProgress is None or again.lastProgress["numInputRows"] == 0


def test_summary_follows_new_readings(spark, feed):
    out, checkpoint = scratch_path(spark, "summary"), scratch_path(spark, "offsets")

    def run():
        L.stream_daily_summary(feed.stream(), ["city"], "ts", "value", "1 day", out, checkpoint)
        return rows(L.stored_summary(spark, out), "city", "daily_mean", "row_count")

    feed([(1, "a", t(1), 1.0), (2, "a", t(2), 2.0), (3, "b", t(1), 5.0)])
    assert run() == [("a", 1.5, 2), ("b", 5.0, 1)]
    feed([(4, "a", t(3), 6.0)])
    assert run() == [("a", 3.0, 3), ("b", 5.0, 1)]


def test_late_rows_are_dropped_and_open_slots_held_back(spark, feed):
    out, checkpoint = scratch_path(spark, "first"), scratch_path(spark, "offsets")

    def run():
        L.stream_keep_first(feed.stream(), ["city"], "ts", ["ts", "id"], ["id", "value"], "1 hour", out, checkpoint)
        return rows(spark.read.parquet(out), "city", "slot", "id")

    feed([(2, "a", t(1, 30), 1.0), (1, "a", t(1, 10), 2.0), (3, "a", t(1, 10), 2.0), (4, "a", t(5, 0), 2.0)])
    assert run() == [("a", t(1), 1)]
    feed([(5, "a", t(1, 0), 9.0), (6, "a", t(9, 0), 1.0)])  # five is behind the watermark
    assert run() == [("a", t(1), 1), ("a", t(5), 4)]


def test_copies_in_later_files_are_dropped(spark, feed):
    out, checkpoint = scratch_path(spark, "once"), scratch_path(spark, "offsets")
    for _ in range(2):
        feed([(1, "a", t(1), 1.0), (2, "a", t(1), 1.0)])
        L.stream_drop_copies(feed.stream(), ["id"], "ts", "1 hour", out, checkpoint)
    assert rows(spark.read.parquet(out), "id") == [(1,), (2,)]


def test_keep_latest_equals_batch_whatever_the_order(spark, feed, frame):
    data = [(i, "abc"[i % 3], t(0, 0, 1) + timedelta(hours=(i * 7) % 50), float(i)) for i in range(30)]
    out, checkpoint = scratch_path(spark, "latest"), scratch_path(spark, "offsets")
    order = [F.col("ts").desc(), F.col("id").desc()]
    for part in (data[20:], data[:10], data[10:20]):
        feed(part)
        L.stream_keep_latest(feed.stream(), ["city", "load_day"], order, day_of("ts"), out, checkpoint)
    batch = latest_per_key(frame(data, SCHEMA).withColumn("load_day", day_of("ts")), ["city", "load_day"], order)
    assert rows(read_committed(spark, out), "city", "load_day", "id") == rows(batch, "city", "load_day", "id")


@pytest.fixture(params=["UTC", "Asia/Kolkata", "America/New_York"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_days_and_slots_are_those_of_the_reading(spark, zone, feed):
    feed([(1, "a", t(0, 10), 1.0), (2, "a", t(23, 50), 3.0), (3, "a", t(0, 5, 2), 8.0), (4, "a", t(9, 0, 2), 8.0)])
    out = scratch_path(spark, "summary")
    L.stream_daily_summary(feed.stream(), ["city"], "ts", "value", "1 day", out, scratch_path(spark, "offsets"))
    days = rows(L.stored_summary(spark, out), "summary_date", "daily_mean")
    assert days == [(t(0).date(), 2.0), (t(0, 0, 2).date(), 8.0)]
    out = scratch_path(spark, "first")
    L.stream_keep_first(feed.stream(), ["city"], "ts", ["ts", "id"], ["id"], "1 hour", out, scratch_path(spark, "offsets"))
    assert rows(spark.read.parquet(out), "slot", "id") == [(t(0), 1), (t(23), 2), (t(0, 0, 2), 3)]


def test_late_rows_are_set_aside_with_their_lag(spark, feed):
    out, checkpoint = scratch_path(spark, "arrived"), scratch_path(spark, "offsets")

    def run():
        L.stream_set_aside_late(feed.stream(), "ts", "1 hour", out, checkpoint)
        return rows(read_committed(spark, out), "id", "late", "lag_seconds")

    feed([(1, "a", t(1, 30), 1.0), (2, "a", t(9), 1.0)])
    assert run() == [(1, False, None), (2, False, None)]
    # at 8:00 the slot of seven has closed, the slot of eight has not; a row without a time is never late
    feed([(3, "a", t(7, 59), 1.0), (4, "a", t(8), 1.0), (5, "a", None, 1.0), (6, "b", t(6, 0), 1.0)])
    found = run()
    assert found == sorted([(1, False, None), (2, False, None), (3, True, 60), (4, False, None), (5, False, None), (6, True, 7200)], key=repr)
    assert run() == found


def test_a_batch_that_runs_again_is_not_stored_twice(spark, feed, monkeypatch):
    out, checkpoint = scratch_path(spark, "arrived"), scratch_path(spark, "offsets")
    feed([(1, "a", t(1), 1.0)])
    real = CommittedTable.replace

    def committed_then_died(self, *args, **more):
        real(self, *args, **more)
        raise RuntimeError("died after the commit")

    with monkeypatch.context() as patched:
        patched.setattr(CommittedTable, "replace", committed_then_died)
        with pytest.raises(Exception, match="died after the commit"):
            L.stream_set_aside_late(feed.stream(), "ts", "1 hour", out, checkpoint)
    L.stream_set_aside_late(feed.stream(), "ts", "1 hour", out, checkpoint)
    assert rows(read_committed(spark, out), "id") == [(1,)]


def test_many_batches_leave_few_folders(spark, feed):
    out, checkpoint = scratch_path(spark, "summary"), scratch_path(spark, "offsets")
    for k in range(8):
        feed([(k, "ab"[k % 2], t(k % 4, day=1 + k % 2), float(k))])
        L.stream_daily_summary(feed.stream(), ["city"], "ts", "value", "9 days", out, checkpoint)
    table = CommittedTable(spark, out)
    held = {load for loads in table.commit().live.values() for load in loads}
    assert len(held) <= 2 and table.commit().number == 8
    assert rows(L.stored_summary(spark, out), "city", "row_count", "daily_mean") == [("a", 4, 3.0), ("b", 4, 4.0)]

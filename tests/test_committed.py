"""Committed tables: changes are seen whole or not at all, and marts follow the days that changed."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import mutations as U
from tidemark.operators.committed import LOAD, CommittedTable, read_committed
from tidemark.operators.marts import keep_mart, newest_rows
from tidemark.session import scratch_path

FACT = "k string, ts timestamp_ntz, value double, seq int"


def t(hour, day=1):
    return datetime(2024, 1, day, hour)


def newest():
    return [F.col("seq").desc()]


def merge(spark, path, data, **more):
    return rows(U.incremental_merge(spark, path, data, ["k"], "ts", newest(), **more), "k", "ts", "value")


class Died(Exception):
    pass


@pytest.mark.parametrize("where", ["second day", "commit"])
def test_a_run_that_dies_leaves_the_former_table(spark, frame, monkeypatch, where):
    path = scratch_path(spark, "fact")
    before = merge(spark, path, frame([("a", t(5), 1.0, 1), ("b", t(5, 2), 1.0, 1)], FACT))
    news = frame([("c", t(6), 2.0, 1), ("c2", t(7, 2), 2.0, 1), ("d", t(8, 3), 2.0, 1)], FACT)
    with monkeypatch.context() as patched:
        if where == "commit":
            patched.setattr(CommittedTable, "_put", lambda self, commit: (_ for _ in ()).throw(Died()))
            with pytest.raises(Died):
                merge(spark, path, news, lookback="2 days")
        else:  # the day of the second of January is written, the job fails on the third
            broken = news.withColumn("value", F.when(F.col("k") == "d", F.raise_error(F.lit("died"))).otherwise(F.col("value")))
            with pytest.raises(Exception, match="died"):
                merge(spark, path, broken, lookback="2 days")
            half = CommittedTable(spark, path)
            half_path = f"{path}/rows/{LOAD}={half.commit().number + 1}/load_day=2024-01-02"
            frame([("half", t(1, 2), 0.0, 1)], FACT).write.parquet(half_path)
    assert rows(read_committed(spark, path), "k", "ts", "value") == before
    assert merge(spark, path, news, lookback="2 days") == sorted([*before, ("c", t(6), 2.0), ("c2", t(7, 2), 2.0), ("d", t(8, 3), 2.0)])


def test_moved_keys_leave_their_former_day(spark, frame):
    source = [("1", t(5), 1.0, 1), ("2", t(6), 1.0, 1), ("1", t(5, 3), 2.0, 2)]
    path, fresh = scratch_path(spark, "fact"), scratch_path(spark, "fact")
    merge(spark, path, frame(source[:2], FACT))
    merge(spark, path, frame([], FACT))
    assert merge(spark, path, frame(source, FACT)) == merge(spark, fresh, frame(source, FACT)) == [("1", t(5, 3), 2.0), ("2", t(6), 1.0)]
    # the only key of a day leaves it, and comes back
    assert merge(spark, path, frame([("1", t(7, 4), 3.0, 3)], FACT)) == [("1", t(7, 4), 3.0), ("2", t(6), 1.0)]
    assert [s for s in CommittedTable(spark, path).commit().live] == ["load_day=2024-01-01", "load_day=2024-01-04"]
    back = merge(spark, path, frame([("1", t(9, 3), 4.0, 4)], FACT), lookback="3 days")
    assert back == [("1", t(9, 3), 4.0), ("2", t(6), 1.0)]


def test_rows_without_a_time_enter_once(spark, frame):
    source = [("a", t(5), 1.0, 1), ("n", None, 2.0, 1), (None, t(4), 3.0, 1), (None, None, 4.0, 2)]
    path = scratch_path(spark, "fact")
    for data in (source[:1], source, source):
        found = merge(spark, path, frame(data, FACT))
    assert found == merge(spark, path, frame(source, FACT), full_refresh=True) == sorted(
        [("a", t(5), 1.0), ("n", None, 2.0), (None, None, 4.0)], key=repr)
    # a key without a time gets one
    assert ("n", t(9), 5.0) in merge(spark, path, frame([("n", t(9), 5.0, 2)], FACT)) and read_committed(spark, path).count() == 3


def test_every_entity_has_its_own_watermark(spark, frame):
    schema = "city string, " + FACT
    path = scratch_path(spark, "fact")

    def run(data):
        return rows(U.incremental_merge(spark, path, frame(data, schema), ["k"], "ts", newest(), entity=["city"]), "k")

    run([("x", "a", t(5, 9), 1.0, 1), ("y", "b", t(5, 2), 1.0, 1), (None, "c", t(5, 1), 1.0, 1)])
    late = [("x", "d", t(5, 8), 1.0, 1), ("y", "e", t(5, 3), 1.0, 1), (None, "f", t(6, 1), 1.0, 1), ("z", "g", t(1, 1), 1.0, 1)]
    assert run(late) == [("a",), ("b",), ("c",), ("e",), ("f",), ("g",)]
    assert run([("y", "h", t(4, 3), 1.0, 1), ("z", "i", t(2, 1), 1.0, 1)]) == [("a",), ("b",), ("c",), ("e",), ("f",), ("g",), ("i",)]


def test_old_loads_are_removed_and_readers_keep_theirs(spark, frame):
    path = scratch_path(spark, "days")
    table = CommittedTable(spark, path, ["p"])
    table.replace(frame([(1, 1), (2, 2)], "v int, p int"))
    reader = table.read()
    table.replace(frame([(3, 2)], "v int, p int"))
    assert rows(reader, "v") == [(1,), (2,)]
    for v in range(4, 8):
        table.replace(frame([(v, 2)], "v int, p int"))
    assert rows(table.read(), "v", "p") == [(1, 1), (7, 2)]
    local = path.removeprefix("file:")
    if os.path.isdir(local):
        assert sorted(os.listdir(f"{local}/rows")) == [f"{LOAD}=1", f"{LOAD}=5", f"{LOAD}=6"]
        assert [n for n in os.listdir(f"{local}/rows/{LOAD}=1") if n.startswith("p=")] == ["p=1"]
        assert sorted(n for n in os.listdir(f"{local}/commits") if not n.startswith(".")) == ["5.json", "6.json"]


def test_slots_appends_and_odd_names(spark, frame):
    schema = "v int, p date, q string"
    table = CommittedTable(spark, scratch_path(spark, "odd"), ["p", "q"])
    assert not table.exists()
    with pytest.raises(ValueError):
        table.read()
    odd = [(1, date(2024, 1, 1), "a/b=% {*}"), (2, None, None), (3, date(2024, 1, 2), "x")]
    table.replace(frame(odd, schema))
    table.replace(frame([(4, date(2024, 1, 2), "x")], schema), append=True)
    assert rows(table.read()) == sorted([*odd, (4, date(2024, 1, 2), "x")], key=repr)
    null_slot = table.slots(frame([(0, None, None)], schema))
    assert rows(table.read(null_slot)) == [(2, None, None)] and table.slots_since(1) == table.slots(frame([odd[2]], schema))
    table.replace(frame([], schema), clear=null_slot)
    assert rows(table.read(), "v") == [(1,), (3,), (4,)] and table.slots_since(2) == null_slot
    table.replace(frame([], schema), full=True)
    assert table.read().columns == ["v", "p", "q"] and table.read().count() == 0


def test_a_second_writer_is_refused(spark, frame):
    table = CommittedTable(spark, scratch_path(spark, "two"), ["p"])
    first = table.replace(frame([(1, 1)], "v int, p int"))
    with pytest.raises(RuntimeError):
        table._put(first)


def test_a_mart_follows_the_days_that_changed(spark, frame):
    root = scratch_path(spark, "marts")
    facts = {n: CommittedTable(spark, f"{root}/{n}", ["load_day"]) for n in ("first", "second")}
    mart, built = CommittedTable(spark, f"{root}/mart", ["day"]), []

    def build(frames):
        days = frames["first"].groupBy("k", "load_day").agg(F.sum("v").alias("v"))
        more = frames["second"].groupBy("k", "load_day").agg(F.sum("v").alias("w"))
        built.append({r[0].day for r in frames["first"].select("load_day").union(frames["second"].select("load_day")).distinct().collect()})
        return days.join(more, ["k", "load_day"], "left").withColumnRenamed("load_day", "day")

    def change(name, data, **more):
        facts[name].replace(frame([(k, v, date(2024, 1, d)) for k, v, d in data], "k string, v int, load_day date"), **more)
        return rows(keep_mart(mart, facts, build, ["k"]), "k", "v", "w", "day")

    facts["second"].replace(frame([], "k string, v int, load_day date"))
    d = lambda n: date(2024, 1, n)
    assert change("first", [("a", 1, 1), ("a", 2, 2), ("b", 5, 1)]) == sorted([("a", 1, None, d(1)), ("a", 2, None, d(2)), ("b", 5, None, d(1))], key=repr)
    assert rows(newest_rows(mart, ["k"]), "k", "day") == [("a", d(2)), ("b", d(1))]
    change("second", [("a", 7, 2), ("z", 9, 4)])
    assert built == [{1, 2}, {2, 4}]
    assert rows(mart.read(), "k", "v", "w", "day") == sorted([("a", 1, None, d(1)), ("a", 2, 7, d(2)), ("b", 5, None, d(1))], key=repr)
    keep_mart(mart, facts, build, ["k"])  # no news, nothing is built
    assert len(built) == 2
    gone = facts["first"].slots(frame([(d(2),)], "load_day date"))
    assert change("first", [("c", 1, 3)], clear=gone) == sorted([("a", 1, None, d(1)), ("b", 5, None, d(1)), ("c", 1, None, d(3))], key=repr)
    assert rows(newest_rows(mart, ["k"]), "k", "day") == [("a", d(1)), ("b", d(1)), ("c", d(3))]
    files = newest_rows(mart, ["k"]).inputFiles()
    assert not [f for f in files if "day=2024-01-02" in f]

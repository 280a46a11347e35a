"""Upserts, history, incremental loads and insert-only tables; repeated runs change nothing."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import mutations as U
from tidemark.operators import vault as V
from tidemark.operators.committed import CommittedTable
from tidemark.operators.modeling import insert_missing
from tidemark.session import scratch_path

DIM = "k int, name string, state string, is_current boolean, valid_to timestamp_ntz"


@pytest.fixture
def dim(frame):
    return frame([(1, "a", "x", True, None), (2, "b", None, True, None), (3, "c", "z", False, None)], DIM)


def test_upsert_updates_changes_and_inserts_new_keys(frame, dim):
    source = frame([(1, "a", "y"), (2, "b", "s"), (3, "c", "z"), (4, "d", "w")], "k int, name string, state string")
    result = U.upsert(dim, source, ["k"], ["state", "name"], ["state"], only=F.col("is_current"),
                      insert_defaults={"is_current": F.lit(True)})
    # key 2: a NULL is not a change; key 3: only a closed row exists, so a current one is inserted
    assert rows(result, "k", "state", "is_current") == sorted([
        (1, "y", True), (2, None, True), (3, "z", False), (3, "z", True), (4, "w", True)], key=repr)


def test_null_safe_upsert_sees_nulls(frame, dim):
    source = frame([(1, None), (2, "s")], "k int, state string")
    result = U.upsert(dim, source, ["k"], ["state"], ["state"], insert=False, null_safe=True)
    assert rows(result, "k", "state") == sorted([(1, None), (2, "s"), (3, "z")], key=repr)


def test_soft_delete_closes_only_current_rows(frame, dim):
    result = U.soft_delete(dim, frame([(1,)], "k int"), "k", "2024-05-01")
    end = datetime(2024, 5, 1)
    assert rows(result, "k", "is_current", "valid_to") == sorted(
        [(1, True, None), (2, False, end), (3, False, None)], key=repr)


HISTORY = "k int, state string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"


def test_history_opens_and_closes_versions(frame):
    history = frame([], HISTORY)
    steps = [
        ([(1, "x"), (2, None)], "2024-01-01"), ([(1, "y"), (2, "z")], "2024-01-02"),
        ([(1, "y"), (2, "z")], "2024-01-03"), ([(1, "x")], "2024-01-04"),
    ]
    for source, as_of in steps:
        history = U.scd2_snapshot(history, frame(source, "k int, state string"), ["k"], ["state"], as_of)
    d = lambda n: datetime(2024, 1, n)
    assert rows(history) == sorted([
        (1, "x", d(1), d(2), False), (1, "y", d(2), d(4), False), (1, "x", d(4), None, True),
        (2, None, d(1), d(2), False), (2, "z", d(2), None, True)], key=repr)


def test_several_changes_of_a_key_in_one_batch(frame, dim):
    history = U.scd2_snapshot(frame([], HISTORY), frame([(1, "x", 1), (1, "y", 2)], "k int, state string, seq int"),
                              ["k"], ["state"], "2024-01-01", order=newest())
    assert rows(history, "k", "state") == [(1, "y")]
    source = frame([(1, "p", 1), (1, "q", 2), (9, "r", 1), (9, "s", 2)], "k int, state string, seq int")
    result = U.upsert(dim, source, ["k"], ["state"], ["state"], order=newest())
    assert [r for r in rows(result, "k", "state") if r[0] in (1, 9)] == [(1, "q"), (9, "s")]


FACT = "k string, ts timestamp_ntz, value double, seq int"
def newest():
    return [F.col("seq").desc()]


def t(hour, day=1):
    return datetime(2024, 1, day, hour)


def test_incremental_merge_skips_late_rows_until_a_full_refresh(spark, frame):
    path = scratch_path(spark, "fact")
    merge = lambda data, **more: rows(
        U.incremental_merge(spark, path, frame(data, FACT), ["k"], "ts", newest(), **more), "k", "value")
    first = [("a", t(5), 1.0, 1), ("a", t(5), 2.0, 2), ("b", t(6), 3.0, 1)]
    assert merge(first) == [("a", 2.0), ("b", 3.0)]
    assert merge(first) == [("a", 2.0), ("b", 3.0)]
    late = first + [("c", t(4), 9.0, 1), ("d", t(7, 2), 4.0, 1)]
    assert merge(late) == [("a", 2.0), ("b", 3.0), ("d", 4.0)]
    assert merge(late, full_refresh=True) == [("a", 2.0), ("b", 3.0), ("c", 9.0), ("d", 4.0)]


def test_lookback_admits_late_rows_and_updates(spark, frame):
    path = scratch_path(spark, "fact")
    U.incremental_merge(spark, path, frame([("a", t(5), 1.0, 1), ("b", t(8), 1.0, 1)], FACT), ["k"], "ts", newest())
    source = frame([("a", t(5), 7.0, 2), ("c", t(6), 2.0, 1), ("d", t(3), 2.0, 1)], FACT)
    result = U.incremental_merge(spark, path, source, ["k"], "ts", newest(), lookback="4 hours")
    assert rows(result, "k", "value") == [("a", 7.0), ("b", 1.0), ("c", 2.0)]


def test_empty_target_takes_everything(spark, frame):
    target, source = frame([], FACT), frame([("a", t(5), 1.0, 1)], FACT)
    assert U.rows_above_watermark(target, source, "ts").count() == 1


def test_untouched_days_are_not_rewritten(spark, frame):
    path = scratch_path(spark, "fact")
    data = [("a", t(5, 1), 1.0, 1), ("b", t(5, 2), 1.0, 1)]
    U.incremental_merge(spark, path, frame(data, FACT), ["k"], "ts", newest())
    files = lambda: {f for f in U.read_committed(spark, path).inputFiles() if "load_day=2024-01-01" in f}
    before = files()
    U.incremental_merge(spark, path, frame([("c", t(9, 2), 1.0, 1)], FACT), ["k"], "ts", newest())
    assert files() == before
    assert U.read_committed(spark, path).count() == 3


def test_replacing_partitions_keeps_the_rest(spark, frame):
    path = scratch_path(spark, "part")
    U.replace_partitions(frame([(1, 1), (2, 2)], "v int, p int"), path, ["p"])
    U.replace_partitions(frame([(9, 2)], "v int, p int"), path, ["p"])
    assert rows(U.read_committed(spark, path), "v", "p") == [(1, 1), (9, 2)]


def test_insert_missing_twice(frame):
    target, source = frame([(1, "a")], "k int, n string"), frame([(1, "b"), (2, "c")], "k int, n string")
    once = insert_missing(target, source, ["k"])
    assert rows(insert_missing(once, source, ["k"])) == [(1, "a"), (2, "c")]


READINGS = "name string, ts timestamp_ntz, value double, seq int"
STAMPS = "load_date timestamp_ntz, record_source string"


def load_sat(satellite, source, at, mode="changed"):
    return V.load_satellite(satellite, source, V.reading_hash("name", "ts"), key="hk", attributes=["value"],
                            order=newest(), required="value", load_date=at, record_source="s", mode=mode)


def test_vault_loads_are_idempotent(frame):
    source = frame([("Mumbai", t(1), 1.0, 1), (" MUMBAI ", t(1), 2.0, 2), ("Delhi", t(1), None, 1), (None, t(1), 1.0, 1)],
                   READINGS)
    hub = frame([], f"hk string, name string, {STAMPS}")
    link = frame([], f"rk string, hk string, ts timestamp_ntz, {STAMPS}")
    satellite = frame([], f"hk string, value double, {STAMPS}, load_end_date timestamp_ntz")
    for at in ("2024-02-01", "2024-02-02"):
        hub = V.load_hub(hub, source, V.name_hash("name"), F.col("name"), key="hk", name="name", load_date=at,
                         record_source="s")
        link = V.load_link(link, source, {"rk": V.reading_hash("name", "ts"), "hk": V.name_hash("name")}, ["ts"],
                           load_date=at, record_source="s")
        satellite = load_sat(satellite, source.where("name is not null"), at)
    assert hub.count() == 2 and link.count() == 2
    assert rows(satellite, "value", "load_end_date") == [(2.0, None)]


def test_satellite_ends_replaced_versions(frame):
    satellite = frame([], f"hk string, value double, {STAMPS}, load_end_date timestamp_ntz")
    satellite = load_sat(satellite, frame([("a", t(1), 1.0, 1), ("b", t(1), 1.0, 1)], READINGS), "2024-02-01")
    satellite = load_sat(satellite, frame([("a", t(1), 5.0, 1)], READINGS), "2024-02-02")
    assert rows(satellite, "value", "load_end_date") == sorted(
        [(1.0, datetime(2024, 2, 2)), (5.0, None), (1.0, None)], key=repr)


def test_satellite_append_mode_repeats(frame):
    satellite = frame([], f"hk string, value double, {STAMPS}, load_end_date timestamp_ntz")
    source = frame([("a", t(1), 1.0, 1)], READINGS)
    for at in ("2024-02-01", "2024-02-02"):
        satellite = load_sat(satellite, source, at, "append")
    assert satellite.count() == 2


def test_hash_of_a_null_part_is_null(frame):
    df = frame([(None, t(1))], "name string, ts timestamp_ntz")
    assert df.select(V.reading_hash("name", "ts")).first()[0] is None


def test_snapshot_carries_columns_and_matches_null_keys(spark):
    history = spark.createDataFrame(
        [(1, "a", "x", None, None, True), (None, "n", "y", None, None, True), (3, "old", "z", None, None, None)],
        "k int, state string, note string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
    source = spark.createDataFrame([(1, "b", "x2"), (None, "n", "y2"), (4, "d", "w")], "k int, state string, note string")
    after = U.scd2_snapshot(history, source, ["k"], ["state"], "2024-01-01 00:00:00")
    got = sorted(((r["k"], r["state"], r["note"], r["is_current"]) for r in after.collect()), key=repr)
    assert got == sorted([(1, "a", "x", False), (1, "b", "x2", True), (None, "n", "y", True), (3, "old", "z", None),
                          (4, "d", "w", True)], key=repr)
    again = U.scd2_snapshot(after, source, ["k"], ["state"], "2024-01-02 00:00:00")
    assert sorted(map(repr, again.collect())) == sorted(map(repr, after.collect()))


def test_repeated_source_keys_are_refused(spark):
    twice = spark.createDataFrame([(1, "b"), (1, "c"), (None, "d"), (None, "e")], "k int, state string")
    # the keys are counted in the plan, so the error comes with the result
    with pytest.raises(Exception, match="several source rows share a key"):
        U.upsert(twice.limit(1), twice, ["k"], ["state"], ["state"]).collect()
    nulls = twice.where("k IS NULL")
    assert rows(U.upsert(twice.limit(1), nulls, ["k"], ["state"], ["state"]), "state") == [("b",), ("d",), ("e",)]


def test_repeated_null_keys_do_not_fork_a_history(spark, frame):
    history = frame([(None, "x", datetime(2024, 1, 1), None, True)], HISTORY)
    with pytest.raises(Exception, match="several source rows share a key"):
        U.scd2_snapshot(history, frame([(None, "y"), (None, "z")], "k int, state string"), ["k"], ["state"], "2024-01-02").collect()
    after = U.scd2_snapshot(history, frame([(None, "y")], "k int, state string"), ["k"], ["state"], "2024-01-02")
    assert rows(after, "state", "is_current") == [("x", False), ("y", True)]


def test_an_upsert_joins_once(frame, dim):
    source = frame([(1, "a", "y")], "k int, name string, state string")
    plan = U.upsert(dim, source, ["k"], ["state"], ["state"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


def test_a_null_in_the_keep_list_closes_nothing(spark):
    dim = spark.createDataFrame([(1, None, True), (2, None, True)], "k int, valid_to timestamp_ntz, is_current boolean")
    keep = spark.createDataFrame([(1,), (None,)], "k int")
    assert U.soft_delete(dim, keep, "k", "2024-01-01 00:00:00").where("is_current").count() == 2


def test_the_last_partition_is_found_without_opening_a_file(spark, frame):
    path = scratch_path(spark, "days")
    frame([(1, date(2024, 1, 9)), (2, date(2024, 1, 31)), (3, None)], "k int, load_day date").write.partitionBy(
        "load_day").parquet(path)
    stored = spark.read.parquet(path)
    assert U.last_partition(stored, "load_day") == "2024-01-31"
    assert U.last_partition(frame([(1, date(2024, 1, 9))], "k int, load_day date"), "load_day") is None


@pytest.mark.parametrize("stored", [True, False])
def test_the_watermark_comes_from_the_last_day(spark, frame, stored):
    target = frame([(t(3), date(2024, 1, 1)), (t(5, 2), date(2024, 1, 2)), (t(9), None)],
                   "ts timestamp_ntz, load_day date")
    if stored:
        path = scratch_path(spark, "marked")
        target.write.partitionBy("load_day").parquet(path)
        target = spark.read.parquet(path)
    source = frame([(t(4),), (t(5, 2),), (t(6, 2),)], "ts timestamp_ntz")
    assert rows(U.rows_above_watermark(target, source, "ts", day="load_day")) == [(t(6, 2),)]


def test_a_satellite_load_windows_only_its_own_keys(spark, frame):
    path = scratch_path(spark, "satellite")
    frame([("x", 1.0, t(1), "s")], f"hk string, value double, {STAMPS}").write.parquet(path)
    satellite = spark.read.parquet(path)
    fresh = V.new_satellite_rows(satellite, frame([("x", 2.0), ("y", 1.0)], "k string, value double"), F.col("k"),
                                 key="hk", attributes=["value"], order=["value"], required=None,
                                 load_date="2024-02-01", record_source="s")
    plan = fresh._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
    assert rows(fresh, "hk", "value") == [("x", 2.0), ("y", 1.0)]


def test_a_stored_satellite_keeps_its_current_rows(spark, frame):
    table = CommittedTable(spark, scratch_path(spark, "satellite"), ["load_date"])

    def load(data, at):
        return rows(V.store_satellite(table, frame(data, "k string, v double, seq int"), F.col("k"), key="hk", attributes=["v"], order=newest(),
                                      required=None, load_date=at, record_source="s"), "hk", "v")

    assert load([("a", 1.0, 1), ("b", 2.0, 1), ("b", 3.0, 2)], "2024-01-01") == [("a", 1.0), ("b", 3.0)]
    assert load([("a", 1.0, 1), ("b", None, 1), ("c", 5.0, 1)], "2024-01-02") == sorted([("a", 1.0), ("b", None), ("c", 5.0)], key=repr)
    again = load([("a", 9.0, 1)], "2024-01-02")  # this load is stored already
    assert again == sorted([("a", 1.0), ("b", None), ("c", 5.0)], key=repr)
    assert rows(table.read(), "hk", "v", "load_date") == sorted([
        ("a", 1.0, t(0)), ("b", 3.0, t(0)), ("b", None, t(0, 2)), ("c", 5.0, t(0, 2))], key=repr)
    link = frame([("a", 1), ("b", 2)], "hk string, n int")
    view = V.current_view(link, [], table.side(V.CURRENT), "hk")
    assert rows(view, "hk", "n", "v") == sorted([("a", 1, 1.0), ("b", 2, None)], key=repr)
    assert "Window" not in view._jdf.queryExecution().optimizedPlan().toString()

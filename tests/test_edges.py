"""NULLs, ties, empty and boundary rows of the operators."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import columns as C
from tidemark.operators import aggregates as A
from tidemark.operators import joins as J
from tidemark.operators import modeling as M
from tidemark.operators import windows as W
from tidemark.operators.sorting import sort_sql


def at(hour, day=1):
    return datetime(2024, 1, day, hour)


RAW = "key string, ts timestamp_ntz, value double, loaded timestamp_ntz"


def test_later_load_wins_and_null_measures_do_not_compete(frame):
    raw = frame([
        ("a", at(1), 1.0, at(2)), ("a", at(1), 2.0, at(3)),
        ("b", at(1), 5.0, at(2)), ("b", at(1), None, at(3)),
    ], RAW)
    kept = W.latest_per_key(raw, ["key", "ts"], [F.col("loaded").desc()], F.col("value").isNotNull())
    assert rows(kept, "key", "value") == [("a", 2.0), ("b", 5.0)]


def test_rank_keeps_ties_and_row_number_does_not(frame):
    df = frame([("a", 3.0, 1), ("a", 3.0, 2), ("a", 1.0, 3)], "key string, value double, id int")
    order = [F.col("value").desc(), F.col("id")]
    assert W.top_k_per_group(df, ["key"], order, 1).count() == 1
    assert W.top_k_per_group(df, ["key"], [F.col("value").desc()], 1, "rank").count() == 2


def test_limits_are_strict_and_null_takes_the_default(frame):
    df = frame([(v,) for v in (75.0, 75.1, 35.0, 35.1, None)], "v double")
    label = C.bucket("v", M.AIR_QUALITY_CUTS, M.AIR_QUALITY_DEFAULT)
    assert [r[0] for r in df.select(label).collect()] == ["Moderate", "Unhealthy", "Good", "Moderate", "Good"]
    known = C.bucket("v", M.AIR_QUALITY_CUTS, M.AIR_QUALITY_DEFAULT, "Unknown")
    assert df.where("v is null").select(known).first()[0] == "Unknown"


def test_rollup_keeps_a_null_key_apart(frame):
    df = frame([("a", 1.0), (None, 3.0)], "key string, value double")
    summary = A.rollup_summary(df, ["key"], "value", labels={"key": "ALL"})
    assert rows(summary) == sorted([("a", 1.0, 1), (None, 3.0, 1), ("ALL", 2.0, 2)], key=repr)


def test_subtotals_weigh_groups_by_their_rows(frame):
    df = frame([("a", 1.0), ("a", 1.0), ("a", 1.0), ("b", 5.0)], "key string, value double")
    total = A.grouping_sets_summary(df, [["key"], []], "value", labels={"key": "ALL"}).where("key = 'ALL'")
    assert rows(total) == [("ALL", 2.0, 4)]


def test_one_row_groups_have_no_spread(frame):
    df = frame([("a", 1.0, 2.0)], "key string, x double, y double")
    assert A.group_corr(df, ["key"], "x", "y").first()["correlation"] is None
    deviation = W.deviation_from_group(df, ["key"], "x", stddev_name="s").first()
    assert deviation["s"] is None and deviation["deviation"] == 0.0


def test_mean_of_nothing_is_null(frame):
    df = frame([("a", None)], "key string, value double")
    assert df.groupBy("key").agg(C.rounded_mean("value").alias("m")).first()["m"] is None


def test_means_round_half_up(frame):
    df = frame([(0.01,), (0.02,)], "value double")
    assert df.agg(C.rounded_mean("value")).first()[0] == 0.02


def test_unknown_code_gets_the_default_and_unused_code_a_zero(frame):
    facts = frame([(1, 10), (2, 99), (3, None)], "id int, code int")
    codes = frame([(7, 10), (8, 11)], "sk int, code int")
    assert rows(J.lookup_key(facts, codes, {"code": "code"}, "sk", 1), "id", "sk") == [(1, 7), (2, 1), (3, 1)]
    assert rows(J.coverage_count(codes, facts, {"code": "code"}, "n"), "code", "n") == [(10, 1), (11, 0)]


@pytest.mark.parametrize("target, expected", [
    ([(1,), (None,)], []), ([(1,)], [(2,)]), ([], [(1,), (2,), (None,)]),
])
def test_not_in_follows_sql(frame, target, expected):
    source = frame([(1,), (2,), (None,)], "k int")
    absent = J.rows_absent(source, frame(target, "k int"), {"k": "k"}, null_aware=True)
    assert rows(absent) == sorted(expected, key=repr)


def test_plain_anti_join_keeps_null_keys(frame):
    source = frame([(1,), (None,)], "k int")
    assert rows(J.rows_absent(source, frame([(1,), (None,)], "k int"), {"k": "k"})) == [(None,)]


def test_member_of_the_second_fact_only_vanishes(frame):
    first = frame([("r1", 1, at(0), 10.0, 50.0)], "rk string, site int, at timestamp_ntz, value double, hum double")
    second = frame([(1, at(1), 80.0), (2, at(0), 80.0)], "site int, at timestamp_ntz, pm double")
    dim = frame([(1, "one"), (2, "two")], "site int, name string")
    mart = M.serving_mart(first, second, dim, key="site", name="name", ts="at", reading_key="rk",
                          means={"m": "value", "h": "hum"}, peak="value", second_means={"p": "pm"}, graded="p",
                          count_name="n", label_name="label")
    # and the hours do not meet, so the day has no second reading
    assert rows(mart, "name", "reading_date", "m", "p", "n", "label") == [("one", date(2024, 1, 1), 10.0, None, 1, "Good")]


def test_gap_report_marks_missing_slots(frame):
    df = frame([("a", at(5, 1)), ("a", at(6, 3)), (None, at(6, 2))], "key string, ts timestamp_ntz")
    report = M.gap_report(df, "key", "ts", "2024-01-01", "2024-01-03")
    found = {(r["key"], r["slot"].day): r["status"] for r in report.collect()}
    assert len(found) == 6
    assert [k for k, s in found.items() if s == "OK"] and found[("a", 2)] == "MISSING" and found[(None, 2)] == "OK"


def test_profile_gives_quartiles_where_asked(frame):
    df = frame([(i, "x") for i in range(1, 101)] + [(None, None)], "a int, b string")
    found = {r["column_name"]: r for r in A.profile(df, ["a"], quartiles=True).collect()}
    assert [found["a"][f"q{q}_value"] for q in (25, 50, 75)] == [25.0, 50.0, 75.0]
    assert found["b"]["q50_value"] is None
    assert "q25_value" not in A.profile(df, ["a"]).columns


def test_means_take_doubles_as_they_are(frame):
    day = at(1)
    fine = frame([("a", day, 0.004), ("a", day, 0.004), ("a", day, 0.013), ("a", day, None), ("b", day, 1e17)],
                 "key string, ts timestamp_ntz, value double")
    assert rows(A.daily_summary(fine, ["key"], "ts", {"m": "value"}), "key", "m") == [("a", 0.01), ("b", 1e17)]
    assert rows(A.rollup_summary(fine, ["key"], "value").where("key IS NOT NULL"), "key", "mean") == [("a", 0.01), ("b", 1e17)]
    odd = frame([("a", day, float("nan")), ("a", day, 1.0)], "key string, ts timestamp_ntz, value double")
    assert str(A.daily_summary(odd, ["key"], "ts", {"m": "value"}).first()["m"]) == "nan"
    assert str(A.cube_summary(odd, ["key"], "value").first()["mean"]) == "nan"


@pytest.mark.parametrize("step, start, seen, marked", [
    ("2 hours", "2024-01-01 00:00:00", datetime(2024, 1, 1, 1, 5), datetime(2024, 1, 1, 0)),
    ("15 minutes", "2024-01-01 00:00:00", datetime(2024, 1, 1, 1, 5), datetime(2024, 1, 1, 1)),
    ("2 days", "2024-01-01", datetime(2024, 1, 2, 7), date(2024, 1, 1)),
    ("1 hour", "2024-01-01 00:20:00", datetime(2024, 1, 1, 1, 5), datetime(2024, 1, 1, 0, 20)),
])
def test_gap_report_gives_readings_to_the_slot_they_fall_into(frame, step, start, seen, marked):
    before = datetime(2023, 12, 31, 23, 59, 59, 500_000)  # belongs to no slot
    df = frame([("a", seen), ("b", before), ("b", None)], "key string, ts timestamp_ntz")
    report = M.gap_report(df, "key", "ts", start, "2024-01-03", step).where("status = 'OK'")
    assert rows(report, "key", "slot") == [("a", marked)]


def test_gap_report_refuses_steps_of_no_fixed_length(frame):
    with pytest.raises(ValueError):
        M.gap_report(frame([("a", at(1))], "key string, ts timestamp_ntz"), "key", "ts", "2024-01-01", "2024-03-01", "1 month")


def test_baseline_never_multiplies_rows(frame):
    df = frame([("base", at(1), 1.0, 1), ("base", at(1), 2.0, 2), ("x", at(1), 5.0, 3), ("y", at(2), 5.0, 4)],
               "key string, ts timestamp_ntz, value double, id int")
    compared = J.compare_to_baseline(df, "key", "base", "ts", "value", [F.col("id").desc()])
    assert rows(compared, "key", "base_value", "difference") == [("x", 2.0, 3.0)]


def test_calendar_weekends_and_names(frame):
    days = M.build_dim_date(frame([(date(2026, 6, 6),), (date(2026, 6, 7),), (date(2026, 6, 8),)], "day date"))
    assert [tuple(r) for r in days.select("date_sk", "day_of_week", "day_num", "is_weekend", "month_name").orderBy(
        "date_sk").collect()] == [
        (20260606, "Sat", 7, True, "Jun"), (20260607, "Sun", 1, True, "Jun"), (20260608, "Mon", 2, False, "Jun")]


def test_rolling_rows_and_days_differ_over_a_gap(frame):
    df = frame([("a", date(2024, 1, 1), 1.0), ("a", date(2024, 1, 9), 3.0)], "key string, day date, value double")
    by_rows = W.rolling_periods(df, ["key"], "day", "value", 7, "m").orderBy("day").collect()
    by_days = W.rolling_periods(df, ["key"], "day", "value", 7, "m", mode="days").orderBy("day").collect()
    assert by_rows[1]["m"] == 2.0 and by_days[1]["m"] == 3.0


def test_window_means_keep_all_decimals_by_default(frame):
    df = frame([("a", date(2024, 1, d), v) for d, v in ((1, 0.004), (2, 0.004), (3, 0.013))],
               "key string, day date, value double")
    assert W.moving_mean(df, ["key"], ["day"], "value", 3, "m", 3).orderBy("day").collect()[2]["m"] == 0.007
    assert W.rolling_periods(df, ["key"], "day", "value", 3, "m", digits=3).orderBy("day").collect()[2]["m"] == 0.007
    assert abs(W.deviation_from_group(df, ["key"], "value").first()["group_mean"] - 0.007) < 1e-12
    huge = frame([("a", date(2024, 1, 1), 1e17), ("a", date(2024, 1, 2), float("nan"))],
                 "key string, day date, value double")
    first, second = W.moving_mean(huge, ["key"], ["day"], "value", 2, "m").orderBy("day").collect()
    assert first["m"] == 1e17 and second["m"] != second["m"]


def test_nulls_sort_high(frame):
    df = frame([(1,), (None,), (2,)], "v int")
    assert [r[0] for r in sort_sql(df, "v").collect()] == [1, 2, None]
    assert [r[0] for r in sort_sql(df, "-v").collect()] == [None, 2, 1]


def test_surrogate_key_keeps_parts_apart(frame):
    df = frame([(None, "a"), ("", "a"), ("a", None)], "x string, y string")
    keys = [r[0] for r in df.select(C.surrogate_key(df, ["x", "y"])).collect()]
    assert len(set(keys)) == 3


def test_profile_counts_nulls(frame):
    profile = {r["column_name"]: r for r in A.profile(frame([(1, None), (None, "x")], "a int, b string"), ["a"]).collect()}
    assert profile["a"]["null_count"] == 1 and profile["a"]["max_value"] == 1.0
    assert profile["b"]["row_count"] == 2 and profile["b"]["min_value"] is None


def test_nan_is_missing_where_a_scale_is_given(frame):
    df = frame([("a", at(1), float("nan"), 1), ("a", at(2), 1.0, 2), ("a", at(3), None, 3), ("a", at(4), 2.0, 4)],
               "key string, ts timestamp_ntz, value double, id int")
    assert rows(W.running_mean(df, ["key"], ["id"], "value", "m", scale=2), "id", "m") == [(1, None), (2, 1.0), (3, 1.0), (4, 1.5)]
    assert rows(W.moving_mean(df, ["key"], ["id"], "value", 2, "m", scale=2), "id", "m") == sorted([(1, None), (2, 1.0), (3, 1.0), (4, 2.0)], key=repr)
    assert df.groupBy("key").agg(C.rounded_mean("value", scale=2).alias("m")).first()["m"] == 1.5


def test_sketches_of_days_unite_to_distinct_counts(frame):
    data = [("a", at(1), k % 700) for k in range(1400)] + [("b", at(2), None), ("c", at(3), 7), ("c", at(3), 7)]
    data += [("a", datetime(2024, 1, 2), 500 + k) for k in range(700)]
    daily = A.daily_sketches(frame(data, "key string, ts timestamp_ntz, v int"), ["key"], "ts", "v")
    assert daily.count() == 3
    found = {r["key"]: r["n"] for r in A.united_distinct(daily, ["key"], "n").collect()}
    assert found["c"] == 1 and abs(found["a"] - 1200) <= 0.03 * 1200 and set(found) == {"a", "c"}
    assert A.united_distinct(daily.limit(0), ["key"]).count() == 0

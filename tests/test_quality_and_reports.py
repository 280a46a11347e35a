"""Checks, publishing, payload landing and report texts."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import quality as Q
from tidemark.operators import report as R
from tidemark.session import scratch_path, shared_dir
from tidemark.sources import files, payloads, sinks


def test_range_limits_are_inclusive_and_nulls_depend_on_the_condition(frame):
    df = frame([(-50.0,), (60.0,), (60.1,), (None,)], "v double")
    assert df.where(Q.out_of_range("v", -50, 60, F.col("v").isNotNull())).count() == 1
    assert df.where(Q.out_of_range("v", -50, 60)).count() == 2


def test_null_passes_accepted_values_and_unique(frame):
    df = frame([("a",), (None,), (None,)], "v string")
    results = {r["check"]: r for r in Q.run_checks(df, [
        Q.accepted_values("v", ["a"]), Q.not_null("v"), Q.unique("v"), Q.row_count_between(4, None),
        Q.row_count_between(None, 3).warn_only()]).collect()}
    assert results["accepted_values_v"]["status"] == "pass"
    assert results["not_null_v"]["failures"] == 2 and results["not_null_v"]["status"] == "fail"
    assert results["unique_v"]["status"] == "pass"


def test_group_checks_count_nulls_ties_and_missing_members(frame):
    df = frame([(1, "a"), (1, "a"), (None, "a"), (2, None), (3, "b"), (3, None)], "k int, v string")
    to, wanted = frame([(1,)], "id int"), frame([("a",), ("z",), (None,)], "m string")
    checks = [Q.unique("k"), Q.unique_combination(["k", "v"]), Q.relationships("k", to, "id"),
              Q.missing_members("v", wanted)]
    failures = {r["check"]: r["failures"] for r in Q.run_checks(df, checks).collect()}
    assert failures == {"unique_k": 2, "unique_combination_k_v": 1, "relationships_k": 3, "missing_members_v": 1}
    none = {r["check"]: r["failures"] for r in Q.run_checks(df.limit(0), checks).collect()}
    assert none == {"unique_k": 0, "unique_combination_k_v": 0, "relationships_k": 0, "missing_members_v": 2}


def test_two_checks_of_one_name_are_refused(frame):
    df = frame([(1.0,)], "v double")
    with pytest.raises(ValueError, match="between_v_0_1"):
        Q.run_checks(df, [Q.between("v", 0, 1), Q.between("v", 0, 1, F.lit(True))])
    named = Q.between("v", 0, 1, F.lit(True), "between_v_all")
    assert Q.run_checks(df, [Q.between("v", 0, 1), named]).count() == 2


def test_severity_decides_between_warning_and_failure(frame):
    df = frame([(-1,)], "v int")
    bad = Q.singular("negative", df.where("v < 0"))
    Q.gate(Q.run_checks(df, [bad.warn_only()]))
    with pytest.raises(Q.ChecksFailed, match="negative: 1"):
        Q.gate(Q.run_checks(df, [bad]))


@pytest.mark.parametrize("hours, status", [(24, "pass"), (24.5, "warn"), (48, "warn"), (48.1, "error")])
def test_freshness_limits(spark, frame, hours, status):
    as_of = datetime(2024, 1, 10)
    loaded = datetime.fromtimestamp(as_of.timestamp() - hours * 3600)
    df = frame([(loaded,)], "loaded timestamp_ntz")
    assert Q.freshness(df, "loaded", "2024-01-10", 24, 48).first()["status"] == status


def test_no_rows_are_not_fresh(frame):
    empty = frame([], "loaded timestamp_ntz")
    assert Q.freshness(empty, "loaded", "2024-01-10", 24, 48).first()["status"] == "error"


def test_member_three_days_old_is_not_stale(frame):
    df = frame([("a", datetime(2024, 1, 7)), ("b", datetime(2024, 1, 6))], "k string, ts timestamp_ntz")
    assert rows(Q.stale_members(df, "k", "ts", "2024-01-10", 3), "k") == [("b",)]


def test_orphans_leave_nulls_alone(frame):
    df, to = frame([(1,), (2,), (None,)], "k int"), frame([(1,)], "id int")
    assert rows(Q.orphans(df, "k", to, "id")) == [(2,)]


def test_a_stale_source_is_not_built(spark, frame):
    df = frame([(1, datetime(2024, 1, 10))], "v int, ts timestamp_ntz")
    checks = lambda _df: [Q.not_null("v")]
    results = sinks.publish_fresh(df, [Q.is_fresh("ts", "2024-01-11", 6, 48)], lambda d: d.select("v"), checks,
                                  "fresh_v", shared_dir(spark))
    assert rows(results, "check", "status") == [("freshness_ts_error", "pass"), ("not_null_v", "pass")]

    def never(_df):
        raise AssertionError("built from a stale source")

    with pytest.raises(Q.ChecksFailed, match="freshness_ts_error"):
        sinks.publish_fresh(df, [Q.is_fresh("ts", "2024-01-20", 6, 48)], never, checks, "fresh_v", shared_dir(spark))
    assert rows(spark.table("fresh_v")) == [(1,)]


def test_publish_keeps_readers_on_the_last_good_version(spark, frame):
    checks = lambda df: [Q.not_null("v")]
    sinks.publish(frame([(1,)], "v int"), checks, "published_v", shared_dir(spark))
    with pytest.raises(Q.ChecksFailed):
        sinks.publish(frame([(2,), (None,)], "v int"), checks, "published_v", shared_dir(spark))
    assert rows(spark.table("published_v")) == [(1,)]
    sinks.publish(frame([(3,)], "v int"), checks, "published_v", shared_dir(spark))
    assert rows(spark.table("published_v")) == [(3,)]


def test_csv_tokens_padding_and_bad_numbers(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("city,v\n  Mumbai , 1.5\nNULL,null\n,\nDelhi,n/a\n")
    assert rows(files.read_csv(spark, str(path), "city string, v double")) == sorted(
        [("Mumbai", 1.5), (None, None), (None, None), ("Delhi", None)], key=repr)


def test_seeds_and_inline(spark):
    assert files.load_seed(spark, "cities").count() == 4
    assert rows(files.load_seed(spark, "weather_codes"), "code_value", "severity")[-1] == (95, "High")
    assert files.inline(spark, [], "a int").count() == 0
    assert rows(files.inline(spark, [(1, None)], "a int, b string")) == [(1, None)]


FIELDS = {"temperature_2m": ("temperature_c", "double"), "weather_code": ("code", "bigint")}


def test_bad_payloads_are_set_aside(frame):
    good = {"hourly": {"time": ["2024-01-01T05:00", "2024-01-01T06:00"], "temperature_2m": [1.5, None],
                       "weather_code": [0, 95]}}
    uneven = {"hourly": {"time": ["2024-01-01T05:00"], "temperature_2m": [], "weather_code": [1]}}
    absent = {"hourly": {"time": ["2024-01-01T05:00"], "weather_code": [1]}}
    timeless = {"hourly": {"time": ["2024-01-01T05:00", "soon"], "temperature_2m": [1.0, 2.0], "weather_code": [1, 2]}}
    df = frame([("g", json.dumps(timeless)), ("a", json.dumps(good)), ("b", '{"hourly": {}}'), ("c", "{cut"), ("d", json.dumps(uneven)),
                ("e", json.dumps(absent)), ("f", None)], "city string, body string")
    ok, rejects = payloads.ingest_payloads(df, "body", FIELDS)
    assert rows(ok, "city", "recorded_at", "temperature_c", "code") == sorted([
        ("a", datetime(2024, 1, 1, 5), 1.5, 0), ("a", datetime(2024, 1, 1, 6), None, 95)], key=repr)
    assert rows(rejects, "city", "reason") == [
        ("b", "no hourly data"), ("c", "no hourly data"), ("d", "array lengths differ"), ("e", "array lengths differ"),
        ("f", "no hourly data"), ("g", "bad time")]


def test_append_refuses_other_schemas(spark, frame):
    path = scratch_path(spark, "raw")
    sinks.append_checked(frame([(1,)], "a int"), path, "a int")
    with pytest.raises(ValueError, match="'a'"):
        sinks.append_checked(frame([("x",)], "a string"), path, "a int")
    assert spark.read.parquet(path).count() == 1


def test_dev_reads_recent_days_only(frame):
    df = frame([(datetime(2024, 1, 1),), (datetime(2024, 3, 1),)], "ts timestamp_ntz")
    assert sinks.Env("dev", "/x").source(df, "ts", "2024-03-05").count() == 1
    assert sinks.Env("prod", "/x").source(df, "ts", "2024-03-05").count() == 2
    assert sinks.Env("ci", "/x/").path("mart") == "/x/ci/mart"


PLAIN = '{"overview": "Ok", "cities": [{"city": "A", "avg_temp": 1.5, "air_quality": "Good", "avg_pm25": null, "comment": "c"}], "alerts": ["look"]}'


@pytest.mark.parametrize("text, failed, problems", [
    (PLAIN, False, []),
    (f"```json\n{PLAIN}\n```", False, []),
    (f"Sure:\n{PLAIN} bye", False, []),
    (PLAIN[:40], True, []),
    ("", True, []),
    ("[1]", True, []),
    ("null", True, []),
    ('{"overview": null, "cities": {}, "alerts": []}', False, ["'cities' is not a list"]),
    ('{"cities": [], "alerts": 1}', False, ["Missing top-level keys: ['overview']", "'alerts' is not a list"]),
    ("{}", False, ["Missing top-level keys: ['alerts', 'cities', 'overview']", "'cities' is not a list",
                   "'alerts' is not a list"]),
    ('{"overview": "", "cities": [1, {"city": "A", "avg_temp": 1, "air_quality": "x", "comment": ""}], "alerts": []}',
     False, ["cities[0] is not an object", "cities[1] missing 'avg_pm25'"]),
])
def test_reports_are_parsed_and_validated(frame, text, failed, problems):
    row = R.parse_reports(frame([(text,)], "t string"), "t").select("parse_failed", "problems", "is_valid").first()
    assert (row["parse_failed"], row["problems"], row["is_valid"]) == (failed, problems, not problems)


def test_missing_values_are_named_in_the_report(frame):
    text = R.render_reports(R.parse_reports(frame([(PLAIN,)], "t string"), "t"), title="T").first()["report"]
    assert text == ("T\n\nOk\n\nA: Avg 1.5C | PM2.5 Not available | Air quality: Good\n  c\n\nALERTS:\n  ! look")


def test_block_is_cut_at_the_cap(frame):
    lines = frame([("g", i, f"line {i:03d}") for i in range(300)], "g string, i int, line string")
    for group in ([], ["g"]):
        block = R.render_block(lines, group, ["i"], "line", "head\n", 20).first()["block"]
        whole = "head\n" + "".join(f"\nline {i:03d}" for i in range(300))
        assert block == whole[:80]


@pytest.mark.parametrize("length, kept", [(80, 80), (83, 83), (84, 80), (85, 80)])
def test_block_is_cut_only_a_whole_token_over_the_cap(frame, length, kept):
    lines = frame([(1, "x" * 40), (2, "y" * (length - 46))], "i int, line string")
    block = R.render_block(lines, [], ["i"], "line", "head", 20).first()["block"]
    assert len(block) == kept


def test_empty_block_has_a_message(frame):
    empty = frame([], "i int, line string")
    assert R.render_block(empty, [], ["i"], "line", "head").first()["block"] == R.EMPTY_BLOCK


def test_cap_leaves_short_text(frame):
    df = frame([("x" * 10,), ("y" * 100,)], "t string")
    assert rows(R.cap_tokens(df, "t", 5)) == sorted([("x" * 10, 2), ("y" * 20, 25)], key=repr)


def test_numbers_keep_their_kind_and_the_last_repeated_key_counts(frame):
    def report(temp):
        return '{"overview": "a", "overview": "b", "cities": [{"city": "A", "avg_temp": %s}], "alerts": [1.0, true]}' % temp

    written = ["30.0", "30", "18.50", "-0.5", "1e3", "NaN", "-Infinity", "12345678.0", "null"]
    df = frame([(i, report(t)) for i, t in enumerate(written)], "id int, response string")
    rendered = R.render_reports(R.parse_reports(df, "response"), title="T").orderBy("id").collect()
    assert [r["report"].split("Avg ")[1].split(" | ")[0] for r in rendered] == [
        "30.0C", "30C", "18.5C", "-0.5C", "1000.0C", "nanC", "-infC", "12345678.0C", "Not available"]
    assert all(r["overview"] == "b" and "  ! 1.0\n  ! True" in r["report"] for r in rendered)


def test_line_templates(frame):
    df = frame([("a", 1.5), (None, None)], "name string, v double")
    line = R.render_line("{{{name}}} is {v}%", {"name": "name", "v": F.col("v") * 2})
    assert [r[0] for r in df.select(line.alias("l")).collect()] == ["{a} is 3.0%", "{nan} is nan%"]


def test_a_table_without_a_path_is_managed_by_the_warehouse(spark, frame):
    stored = sinks.materialize(frame([(1,)], "v int"), "table", "kept_v")
    assert rows(stored) == [(1,)]
    assert not stored.inputFiles()[0].removeprefix("file:").startswith(shared_dir(spark).removeprefix("file:"))
    spark.sql("DROP TABLE kept_v")


def test_no_checks_give_no_rows(frame):
    results = Q.run_checks(frame([(1,)], "k int"), [])
    assert results.columns == ["check", "severity", "failures", "status"] and results.count() == 0
    Q.gate(results)


def test_checks_observed_while_writing_equal_checks_of_the_table(spark, frame):
    at = datetime(2024, 1, 30)
    data = [(1, "a", at), (2, None, datetime(2024, 1, 31)), (3, "b", None)] * 7
    checks = [Q.not_null("v"), Q.accepted_values("v", ["a"]), Q.row_count_between(22, None), Q.unique("k"),
              Q.is_fresh("t", "2024-02-01 00:00:00", 12, 48, severity="warn")]
    for df in (frame(data, "k int, v string, t timestamp_ntz").repartition(3), frame([], "k int, v string, t timestamp_ntz")):
        path = scratch_path(spark, "observed")
        measured = Q.write_measured(df, path, checks)
        stored = spark.read.schema(df.schema).parquet(path)
        results = Q.run_checks(stored, checks, measured)
        assert rows(results) == rows(Q.run_checks(stored, checks))
    measured = Q.write_measured(frame(data, "k int, v string, t timestamp_ntz"), path + "b", checks)
    assert measured["not_null_v"] == 7 and measured["row_count_between_22_None"] == 21
    stored = spark.read.parquet(path + "b")
    scans = [Q.run_checks(stored, checks, m)._jdf.queryExecution().sparkPlan().toString().count("FileScan") for m in (measured, None)]
    assert scans == [1, 2]
    # a check that was not observed is read from the table
    more = [*checks, Q.not_null("k")]
    assert rows(Q.run_checks(stored, more, measured)) == rows(Q.run_checks(stored, more))
    assert Q.write_measured(stored, path + "c", [Q.unique("k")]) == {}

"""The physical plans: pruning, pushdown, early group limits, no crossings, no Python rows."""

import contextlib
import io
import os
import re

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")

QUERIES = entry.queries()


def plan(spark, name):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        QUERIES[name](spark, SF_DIR).explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", [
    "serving_mart", "gap_report_hours", "compare_to_baseline", "not_in_null_aware", "star_revenue", "deviation_all",
    "join_on_time_bucket", "rank_codes_with_ties", "upsert", "vault_view", "run_checks", "parse_reports",
    "enrich_from_literal", "build_fact",
])
def test_no_crossing_and_no_python(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEval", "MapIn"):
        assert bad not in text


@pytest.mark.parametrize("name", ["latest_per_key", "top_days_per_sensor", "top_hour_per_day", "serving_mart"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit.*Partial|Partial\b", plan(spark, name))
    assert "WindowGroupLimit" in plan(spark, name)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "serving_mart")
    assert "EqualTo(event_type,view)" in text and "EqualTo(event_type,purchase)" in text
    text = plan(spark, "filter_on_column")
    assert "GreaterThan(value,100.0)" in text and "GreaterThanOrEqual(ts," in text
    assert "props" not in re.search(r"ReadSchema: (.*)", text).group(1)
    schema = re.search(r"ReadSchema: (.*)", plan(spark, "check_unique")).group(1)
    assert schema.strip() == "struct<user_id:bigint>"


def test_sorted_limit_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top_orders")


def test_subtotals_expand_after_the_first_aggregate(spark):
    text = plan(spark, "rollup_sites")
    # printed top down: the expansion stands above the first pair of aggregates
    assert text.count("HashAggregate", text.index("Expand"), text.index("Scan parquet")) >= 2


def test_checks_share_scans(spark):
    results = QUERIES["run_checks"](spark, SF_DIR)
    results.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        results.explain("simple")
    final = text.getvalue().split("== Initial Plan ==")[0]
    # rows, counts and ages; event ids; users and types, shared by three checks; the parent
    assert len(re.findall(r"FileScan parquet", final)) <= 4
    assert final.count("ReusedExchange") >= 2


def test_literals_are_broadcast(spark):
    text = plan(spark, "enrich_from_literal")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_all_checks_have_sql():
    from tidemark.plans import all_oracles, all_queries

    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name, most", [("serving_mart_stored", 2), ("drill_across_stored", 1)])
def test_facts_stored_by_slot_join_where_they_lie(spark, name, most):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    tree = text[:text.index("(1) Scan")]
    assert "SortMergeJoin" in tree and tree.count("Exchange") <= most

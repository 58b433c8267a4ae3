"""What the batch queries' plans must and must not hold."""

import re

import pytest

from millrace.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
WRITES_FILES = {
    "shard_writer", "keyed_lines", "json_lines", "rows_per_day", "days_batch", "topic_window_files", "schema_id_files",
    "exact_shard_files", "shared_shard_files", "schema_records", "log_manifest", "start_latest_files",
}
IN_MEMORY = sorted(name for name in QUERIES if name not in WRITES_FILES and not name.startswith("stream_"))
MAP_ONLY = [
    "user_names", "names_projection", "json_fields", "utf8_defaults", "drop_empty", "case_value", "producer_records",
    "encoded_payloads", "shard_events", "start_at_timestamp",
]


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", IN_MEMORY)
def test_no_python_and_no_cross_product(spark, name):
    assert not re.search(r"Python|Pandas|Cartesian|NestedLoop", plan(spark, name))


@pytest.mark.parametrize("name", MAP_ONLY)
def test_projections_do_not_shuffle(spark, name):
    text = plan(spark, name)
    assert "Exchange" not in text
    # Parsing JSON is the one step that Spark does not generate code for.
    assert text.startswith("*(1)") or name == "json_fields"


@pytest.mark.parametrize(
    "name, columns",
    [
        ("names_projection", "c_name:string"),
        ("user_names", "event_id:bigint"),
        ("shard_events", "event_id:bigint,user_id:bigint"),
        ("window_10s", "ts:timestamp_ntz,event_type:string"),
    ],
)
def test_scans_read_only_the_columns_in_use(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(spark, name)


def test_start_timestamp_reaches_the_scan(spark):
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in plan(spark, "start_at_timestamp")


@pytest.mark.parametrize("name", ["window_10s", "rows_per_shard", "topic_metrics", "combine_per_key", "exactly_once_audit"])
def test_groups_are_counted_before_the_shuffle(spark, name):
    assert "partial_" in plan(spark, name)


@pytest.mark.parametrize("name", ["schema_lookup", "schema_rejects", "start_latest"])
def test_small_sides_are_broadcast(spark, name):
    assert "BroadcastHashJoin" in plan(spark, name)

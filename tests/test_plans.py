"""What the physical plans must and must not contain."""

import functools
import re

import pytest

from isobar.operators.rawday import clustered, last_write_wins, to_raw_day
from isobar.operators.telegram import accepted, flatten_responses, parse_messages, to_messages, within_box
from isobar.plans.queries import QUERIES
from isobar.plans.stations import as_responses, telegrams

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plan_of(spark):
    """The plan of a query; queries run their jobs once for all tests here."""
    return functools.cache(lambda name: plan(QUERIES[name](spark, SF_DIR)))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_workers_no_cross_joins(plan_of, name):
    text = plan_of(name)
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rows_meet_in_one_partition_only_as_aggregates(plan_of, name):
    """A single-partition exchange is fed by partial aggregates, never by rows."""
    text = plan_of(name)
    for match in re.finditer(r"Exchange SinglePartition[^\n]*\n([^\n]*)", text):
        assert "partial_" in match.group(1), text


@pytest.mark.parametrize(
    "name,table,columns",
    [
        ("numeric_profile", "lineitem", "l_quantity,l_extendedprice,l_discount,l_tax"),
        ("discrete_histogram", "lineitem", "l_returnflag,l_linestatus"),
        ("keyed_mean", "events", "event_type,props"),
        ("nul_scan", "documents", "text"),
    ],
)
def test_only_used_columns_are_read(spark, name, table, columns):
    text = plan(QUERIES[name](spark, SF_DIR))
    schemas = re.findall(rf"{table}\.parquet\].*?ReadSchema: struct<(.*?)>", text)
    assert schemas and all(re.sub(r":\w+", "", s) == columns for s in schemas)


@pytest.mark.parametrize("name", ["station_means", "keyed_mean", "window_means", "discrete_histogram", "raw_by_day"])
def test_groups_shrink_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for match in re.finditer(r"Exchange hashpartitioning[^\n]*\n([^\n]*)", text):
        assert re.search(r"\bHashAggregate.*partial_", match.group(1)), text


def test_value_tables_are_not_shuffled_by_field_alone(spark):
    """Shuffles by field carry aggregates only: most rows may belong to one field."""
    text = plan(QUERIES["string_profile"](spark, SF_DIR))
    for match in re.finditer(r"Exchange hashpartitioning\(field#\d+, \d+\)[^\n]*\n([^\n]*)", text):
        assert "partial_" in match.group(1), text


def test_messages_are_parsed_once(spark):
    readings = telegrams(spark, SF_DIR)
    assert plan(accepted(parse_messages(to_messages(readings)))).count("from_json") == 1
    assert plan(flatten_responses(as_responses(readings))).count("from_json") == 1


def test_box_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "readings")
    telegrams(spark, SF_DIR).write.parquet(path)
    text = plan(within_box(spark.read.parquet(path), -3.0, 50.0, 0.0, 60.0))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(longitude,-3\.0\)", text)


def test_hot_day_may_be_split_between_writers(spark):
    raw = last_write_wins(to_raw_day(telegrams(spark, SF_DIR), ("event_id",)), "event_id")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(clustered(raw))

"""A sample of the registered queries against DuckDB on the smallest data.

``python -m workload.compare <dir>`` runs all of them.
"""

import pytest

import __spark_entry__ as entry
from workload.compare import compare, connect
from workload.inputs import SMALL

SAMPLE = (
    "raw_quality bad_rows field_lengths parse_event_list null_markers bronze bronze_basic event_map_ranked "
    "enhance_events_named page_views hit_ids gold layer_summary event_trace_explosion user_journey read_hits "
    "tab_histogram assemble_records repaired_records repair_stats"
).split()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, name):
    same, note = compare(spark, duck, name, SMALL)
    assert same, note


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(entry.ORACLES)


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_name", "event_count", "unique_users", "percentage"] and df.count() > 0

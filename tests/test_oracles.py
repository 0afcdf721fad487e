"""Every query with SQL returns what the SQL returns, types included; the others run and keep their promises."""

import json

import pytest

from catalogue import ORACLES, QUERIES
from tools.compare import connect, differences

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    got = QUERIES[name](spark, SMALL).toArrow()
    assert differences(got, con.execute(ORACLES[name]).to_arrow_table()) == []


@pytest.mark.parametrize("name", ["results_json_parsed", "files_to_output"])
def test_results_with_rows_match_sql(spark, name):
    """At the smallest scale every anchor is stopped; these have results."""
    larger = "/root/testdata/sf0.01"
    got = QUERIES[name](spark, larger).toArrow()
    assert got.num_rows and differences(got, connect(larger).execute(ORACLES[name]).to_arrow_table()) == []


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_result_text_has_six_attributes_and_keeps_nulls(spark):
    rows = QUERIES["results_json"](spark, "/root/testdata/sf0.01").collect()
    assert rows
    for row in rows:
        event = json.loads(row["value"])
        assert list(event) == [
            "timestamp", "flag", "eventType", "currentFeatureRecords", "anticipatedFeatureRecords", "plantConditions"
        ]
        assert [r["id"] for r in event["plantConditions"]] == [11, 12, 13]
        assert [r["id"] for r in event["currentFeatureRecords"]] == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 14]
        assert all("value" in r for r in event["anticipatedFeatureRecords"])

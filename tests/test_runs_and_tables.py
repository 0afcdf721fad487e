"""The run from files with its checks, state per site, log compaction and merges by key: replays, broken writes and awkward rows."""

import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from catalogue import pipeline
from conftest import T0, minute
from millrace.operators import results
from millrace.operators.quality import FeatureMismatch
from millrace.plans import files
from millrace.session import scratch_path
from millrace.sources import compaction, folders, sinks
from millrace.sources import events as src
from millrace.streaming.state import KEPT, SiteState

SMALL = "/root/testdata/sf0.001"


# files to output


@pytest.fixture(scope="module")
def configured(spark):
    folder = scratch_path(spark, "configured")
    pipeline._config_files(spark, SMALL, folder)
    return folder


def event_lines(hours=400, level=20.0):
    lines = []
    for k in range(hours):
        stamp = (T0.replace(minute=0) - timedelta(hours=k)).strftime("%Y-%m-%dT%H:%M:%SZ")
        records = [{"id": t, "value": level + k % 5} for t in ("click", "view", "purchase", "signup")] + [{"id": "error", "value": 1.0}]
        lines.append(json.dumps({"site_id": 1, "timestamp": stamp, "eventtype": "eventtype1", "plant_up": 1, "sequenceID": str(k), "records": records}))
    return lines


def run_lines(spark, configured, lines, **changes):
    folder, out, bad = (scratch_path(spark, x) for x in ("events", "out", "bad"))
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(folder)
    given = pipeline.file_inputs(configured, folder)
    for name, value in changes.items():
        setattr(given, name, value)
    return files.run_files(spark, given, out, bad), out, bad


def test_run_from_files_reports_what_it_saw(spark, configured):
    lines = event_lines()
    report, out, bad = run_lines(spark, configured, lines + lines[:7] + ["{broken", '{"site_id": 1}'])
    assert (report.lines, report.broken, report.events, report.copies, report.results) == (409, 2, 400, 7, 1)
    assert sorted(r.reason for r in spark.read.parquet(bad).collect()) == ["missing timestamp", "unreadable"]
    assert [w.split(" ", 1)[1] for w in report.warnings()][:2] == ["broken lines were set aside", "copies of events were dropped"]
    answers = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert len(answers) == 1 and answers[0]["site_id"] == 1 and answers[0]["timestamp"].startswith("2023-10-01T06:00")
    assert report.features == len(answers[0]["currentFeatureRecords"]) + len(answers[0]["plantConditions"]) == 14


def test_empty_inputs_end_the_run(spark, configured):
    with pytest.raises(ValueError, match="Event input is empty"):
        run_lines(spark, configured, [])
    with pytest.raises(ValueError, match="Event input is empty"):
        run_lines(spark, configured, ["{broken"])
    for name, message in (("features", "Features config is empty"), ("tags", r"ETL configuration \(tags config\) is empty")):
        empty = scratch_path(spark, "empty")
        spark.createDataFrame([(json.dumps({"features": [], "sites": []}),)], "value string").write.text(empty)
        with pytest.raises(ValueError, match=message):
            run_lines(spark, configured, event_lines(5), **{name: empty})


def test_a_feature_mismatch_ends_the_run_before_anything_is_published(spark, configured, monkeypatch):
    from millrace.plans import feature_store

    whole = feature_store.nested_results

    def one_missing(*args):
        return whole(*args).withColumn("anticipatedFeatureRecords", F.slice("anticipatedFeatureRecords", 2, 100))

    monkeypatch.setattr(feature_store, "nested_results", one_missing)
    with pytest.raises(FeatureMismatch, match="Features mismatch between currentFeatureRecords and anticipatedFeatureRecords"):
        run_lines(spark, configured, event_lines())


def test_results_of_wholly_stopped_anchors_are_read_back_as_none(spark, configured):
    """A plant that is down answers nothing; the lines are still there to be read, none of them."""
    report, out, _ = run_lines(spark, configured, event_lines(level=1.0))
    assert report.results == 0 and results.read_result_text(spark, out).count() == 0


# state per site


def batch(spark, rows):
    """``(site, type, minutes back, sequence)``"""
    return spark.createDataFrame([(s, kind, minute(k), 1, seq, [("a", float(k))]) for s, kind, k, seq in rows], KEPT)


def held(df):
    return sorted((r.site_id, r.eventtype, int((T0 - r.ts.astimezone(T0.tzinfo)).total_seconds() // 60), r.sequenceID) for r in df.collect())


def test_state_keeps_what_is_within_reach(spark):
    state = SiteState(scratch_path(spark, "state"), 3600, "t", buckets=4)
    first = [(s, "t", k, "0") for s in range(6) for k in (130, 125, 70)] + [(0, "c", 128, "0")]
    assert held(state.merge(batch(spark, first), 0)) == sorted(first)
    # a newer event lets go what lies more than an hour before it; a late one is kept, a copy with a greater sequence replaces
    second = [(0, "t", 69, "0"), (0, "t", 100, "0"), (0, "t", 70, "1"), (0, "t", 200, "0")]
    merged = held(state.merge(batch(spark, second), 1))
    assert [r for r in merged if r[0] == 0] == [(0, "c", 128, "0"), (0, "t", 69, "0"), (0, "t", 70, "1"), (0, "t", 100, "0"), (0, "t", 125, "0")]
    rest = [r for r in held(state.newest(spark)) if r[0] != 0]
    assert rest == sorted(r for r in first if r[0] != 0)


def test_state_survives_replays_and_broken_writes(spark):
    state = SiteState(scratch_path(spark, "state"), 10**6, "t", buckets=2)
    for i in range(3):
        state.merge(batch(spark, [(s, "t", 50 - i, str(i)) for s in range(4)]), i)
    again = held(state.merge(batch(spark, [(s, "t", 48, "2") for s in range(4)]), 2))
    assert again == held(state.newest(spark)) and len(again) == 12
    # a generation without its mark was not written to the end: it counts for nothing
    folders.delete(spark, f"{state.path}/generation=2/_SUCCESS")
    assert len(held(state.newest(spark))) == 8
    # the bucket of site 0 comes with the two older events of each of its sites
    merged = held(state.merge(batch(spark, [(0, "t", 48, "2")]), 2))
    assert len(merged) == 2 * len({r[0] for r in merged}) + 1
    assert held(state.merge(batch(spark, []), 3)) == []
    # two versions of a bucket stay, no more
    for i in range(4, 8):
        state.merge(batch(spark, [(s, "t", 40 - i, str(i)) for s in range(4)]), i)
    kept = [n for g in folders.generations(spark, state.path) for n in folders.names(spark, f"{state.path}/generation={g}") if n.startswith("bucket=")]
    assert len(kept) <= 4


# compaction


def logged(spark, path, schema):
    return sorted((r.site_id, r.ts) for r in compaction.read_compacted_log(spark, path, schema).collect())


def test_compaction_with_replays_and_a_writer_between(spark):
    path = scratch_path(spark, "log")
    events = spark.createDataFrame([(i, "e1" if i % 2 else "e2", minute(i * 300)) for i in range(40)], "site_id int, eventtype string, ts timestamp")
    whole = sorted((r.site_id, r.ts) for r in events.collect())
    assert logged(spark, path, events.schema) == [] and compaction.compact_log(spark, path, events.schema) is None
    for i in range(8):
        src.append_event_batch(events.where(F.col("site_id") % 10 == i), path, i, "s")
    before = logged(spark, path, events.schema)
    assert compaction.compact_log(spark, path, events.schema) == 0 and logged(spark, path, events.schema) == before
    assert compaction.compact_log(spark, path, events.schema) is None
    src.append_event_batch(events.where("site_id % 10 = 3"), path, 3, "s")
    assert logged(spark, path, events.schema) == before
    # the same batch number of another stream is another batch
    src.append_event_batch(events.where("site_id % 10 = 8"), path, 3, "other")
    src.append_event_batch(events.where("site_id % 10 = 9"), path, 9, "s")
    assert logged(spark, path, events.schema) == whole
    assert compaction.compact_log(spark, path, events.schema) == 1 and logged(spark, path, events.schema) == whole
    left = spark.read.option("basePath", path).parquet(path).select("stream", "batch_id").distinct().collect()
    assert {(r.stream, r.batch_id) for r in left} == {("other", 3), ("s", 9)}
    # a generation that was not finished is as good as none
    folders.delete(spark, f"{path}-compacted/generation=1/_SUCCESS")
    assert logged(spark, path, events.schema) != [] and compaction.compact_log(spark, path, events.schema) == 1
    assert logged(spark, path, events.schema) == whole


# merges


def dated(spark, rows):
    return spark.createDataFrame([(k, v, date(2024, 1, d)) for k, v, d in rows], "k int, v string, field_date date")


def test_merge_replaces_keys_wherever_they_lie(spark):
    path = scratch_path(spark, "merge")
    table = lambda: sorted((tuple(r) for r in spark.read.schema("k int, v string, field_date date").parquet(path).collect()), key=repr)
    assert sinks.merge_dates(dated(spark, [(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", 3)]), path, ["k"]) == [date(2024, 1, d) for d in (1, 2, 3)]
    untouched = folders.names(spark, f"{path}/field_date=2024-01-01")
    # a new value, a moved row that empties its date, a new key twice
    touched = sinks.merge_dates(dated(spark, [(3, "C", 5), (4, "D", 3), (9, "x", 4), (9, "y", 5)]), path, ["k"])
    assert touched == [date(2024, 1, d) for d in (2, 3, 5)]
    assert table() == sorted([(1, "a", date(2024, 1, 1)), (2, "b", date(2024, 1, 1)), (3, "C", date(2024, 1, 5)), (4, "D", date(2024, 1, 3)), (9, "y", date(2024, 1, 5))], key=repr)
    assert folders.names(spark, f"{path}/field_date=2024-01-01") == untouched and not folders.exists(spark, f"{path}/field_date=2024-01-02")
    # null keys are one key; merging the same again changes nothing, merging nothing neither
    for _ in range(2):
        sinks.merge_dates(dated(spark, [(None, "n", 1)]), path, ["k"])
    sinks.merge_dates(dated(spark, []), path, ["k"])
    assert [r for r in table() if r[0] is None] == [(None, "n", date(2024, 1, 1))] and len(table()) == 6

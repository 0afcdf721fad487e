"""Configuration files, gate decisions, output events and the live stream."""

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import T0, minute
from millrace.config import bounded_rows
from millrace.operators import gate, results
from millrace.plans import configs, feature_store
from millrace.session import cut_lineage, scratch_path
from millrace.sources import events as src
from millrace.sources import sinks
from millrace.streaming import events as st

FEATURE = dict(
    equipment="Mill, Pump", function=" Mean ", lag=None, nullImpute=None, nullThreshold=0.5, currentTimeAggregation="Mean",
    anticipatedTimeAggregation="mean", timeAggregationMinutes=60, customInput=None, plantCondition="false",
    area="A1 ", line="L1", measure="Flow", position="in",
)
PLANT = {
    "trigger_features": [1, 4, 11, 12], "plantup_time": 11, "plantup_switch": 12, "plantup_minutes": 13, "moisture_feature": 1,
    "moisture_target_feature": 4, "moisture_target": 8.1, "skip_low_pass": ["x2"], "optimal_tag": "feed", "optimal_threshold": 600.0,
}


def feature(ident, **changes):
    return {**FEATURE, "id": ident, **changes}


def condition(ident):
    return feature(ident, function=None, plantCondition="true", currentTimeAggregation="last", anticipatedTimeAggregation=None, area="none")


def tag(name, equipment="mill", kind="numeric", critical="Normal", area="a1"):
    return dict(enterpriseId=name, tagType=kind, criticality=critical, equipment=equipment, area=area, line="l1", measure="flow", position="in")


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("config")
    features = [
        feature(1), feature(2, function="MAX", timeAggregationMinutes=2880), feature(4, function="moisture_target", area="none", currentTimeAggregation="last"),
        condition(11), condition(12), condition(13),
    ]
    tags = [
        [tag("x1"), tag("x2", equipment="Pump "), tag("feed", critical="Critical Run Status", equipment="belt", area="b")],
        [tag("run", kind="discrete", critical="Critical Run Status", area="c"), tag("ghost")],
    ]
    (folder / "features.json").write_text(json.dumps({"features": features}, indent=1))
    (folder / "tags.json").write_text(json.dumps({"sites": [{"tags": t} for t in tags]}, indent=1))
    (folder / "plant.json").write_text(json.dumps(PLANT, indent=1))
    return folder


def is_run_tag():
    return (F.col("tagType") == "discrete") & (F.col("criticality") == "Critical Run Status")


@pytest.fixture(scope="module")
def cfg(spark, files):
    present = spark.createDataFrame([("x1",), ("x2",), ("feed",), ("run",)], "tag_id string")
    tags = configs.normalise_tags(src.read_tags_config(spark, str(files / "tags.json")), present)
    features = configs.normalise_features(src.read_features_config(spark, str(files / "features.json")))
    runs = configs.run_tag_pairs(tags, is_run_tag())
    return configs.resolve(features, tags, runs, src.read_plant_config(spark, str(files / "plant.json")))


def test_configuration_files_resolve(cfg):
    by_id = {f.id: f for f in cfg.features}
    assert by_id[1].tags == ("x1", "x2") and by_id[1].function == "mean"
    assert by_id[2].steps == 2880 and [f.id for f in cfg.long_features] == [2]
    assert by_id[11].tags == ("plantup_time",) and by_id[11].condition
    assert by_id[4].tags == ()
    assert cfg.run_tags_of == {"x1": ("run",)}  # the absent tag is dropped, the pump has no run tag
    assert cfg.smoothed_tags == ("feed", "x1")  # x2 is on the skip list, the run tag is discrete
    assert cfg.critical_tags == ("feed", "run")
    assert [f.id for f in cfg.gate_features] == [1, 4, 11, 12]


def test_empty_inputs_are_rejected(spark, files):
    with pytest.raises(ValueError, match="Features config is empty"):
        feature_store.check_inputs(spark.range(1), spark.range(0), spark.range(1))
    with pytest.raises(ValueError, match=r"ETL configuration \(tags config\) is empty"):
        feature_store.check_inputs(spark.range(1), spark.range(1), spark.range(0))
    with pytest.raises(ValueError, match="Event input is empty"):
        feature_store.check_inputs(spark.range(0), spark.range(1), spark.range(1))
    with pytest.raises(ValueError, match="more than 3 rows"):
        bounded_rows(spark.range(4), 3)


def decide(spark, age_hours, time=1.0, switch=0.0, moisture=8.0, target=8.1):
    inputs = spark.createDataFrame(
        [(1, T0, time, switch, moisture, target)],
        "site_id int, anchor_ts timestamp, plantup_time double, plantup_switch double, moisture double, moisture_target double",
    )
    change = None if age_hours is None else T0 - timedelta(hours=age_hours)
    last = spark.createDataFrame([(1, T0, change)], "site_id int, anchor_ts timestamp, change_ts timestamp")
    row = gate.trigger_gate(inputs, last).first()
    return row["trigger"], row["flag"]


@pytest.mark.parametrize(
    "inputs,expected",
    [
        (dict(age_hours=5, time=0.0), (0, None)),
        (dict(age_hours=5, time=None), (0, None)),
        (dict(age_hours=1, switch=1.0), (0, None)),
        (dict(age_hours=3), (1, True)),
        (dict(age_hours=5, switch=1.0), (1, True)),
        (dict(age_hours=5, moisture=7.1), (1, True)),
        (dict(age_hours=5, moisture=8.0), (1, False)),
        (dict(age_hours=None), (1, False)),
        (dict(age_hours=5, moisture=None), (1, False)),
    ],
)
def test_gate_decisions(spark, inputs, expected):
    assert decide(spark, **inputs) == expected


def test_result_inputs_are_checked(spark):
    some, none = spark.range(1), spark.range(0)
    for current, anticipated, message in [
        (None, some, "The current features is None"), (some, None, "The anticipated features is None"),
        (none, some, "The current features is empty"), (some, none, "The anticipated features is empty"),
    ]:
        with pytest.raises(ValueError, match=message):
            results.require_features(current, anticipated)


IDS = gate.GateFeatures(11, 12, 1, 4)


def telemetry(last=200):
    return [
        (k, 1, {"x1": 10.0 + k % 3, "x2": 5.0, "run": 1.0, "feed": 900.0 if k % 40 else 100.0}) for k in range(last)
    ]


@pytest.fixture(scope="module")
def change_events(spark):
    return spark.createDataFrame([(1, minute(180)), (1, minute(400))], "site_id int, ts timestamp")


def test_run_from_events_to_json(spark, cfg, make_events, anchor, change_events):
    output = feature_store.run(make_events(telemetry()), change_events, anchor, cfg, IDS, materialise_gate=True)
    assert [tuple(r)[2:] for r in output.gate.collect()] == [(1, True)]
    text = results.result_json(output.results).first()["value"]
    event = json.loads(text)
    assert event["timestamp"] == "2023-10-01T06:30:00.000000Z" and event["eventType"] == "rtfsOutput" and event["flag"] is True
    assert [r["id"] for r in event["currentFeatureRecords"]] == [1, 2, 4]
    # the plant is down once every 40 minutes, the anchor's own minute does not count
    assert event["plantConditions"] == [{"id": 11, "value": 1.0}, {"id": 12, "value": 0.0}, {"id": 13, "value": 59.0}]
    path = scratch_path(spark, "published")
    sinks.write_result_text(results.result_json(output.results), path)
    assert spark.read.text(path).first()["value"] == text


def test_stopped_anchor_gives_no_output(spark, cfg, make_events, anchor):
    recent = spark.createDataFrame([(1, minute(30))], "site_id int, ts timestamp")
    output = feature_store.run(make_events(telemetry()), recent, anchor, cfg, IDS)
    assert output.results.count() == 0 and output.gate.first()["trigger"] == 0


def message_rows(make_events, rows):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return make_events(rows).select(
        "site_id", stamp.alias("timestamp"), F.lit("eventtype1").alias("eventtype"), "plant_up", F.unix_seconds("ts").cast("string").alias("sequenceID"), "records"
    )


def test_live_stream_equals_batch_run(spark, cfg, make_events, anchor, change_events):
    """Two message files, the second with the newest event and a copy of an old one; a replay changes nothing."""
    inbox, log, out, marks = (scratch_path(spark, x) for x in ("inbox", "log", "out", "marks"))
    rows = telemetry()
    message_rows(make_events, rows[1:]).coalesce(1).write.mode("append").json(inbox)
    stream = src.typed_events(st.file_stream(spark, inbox, src.EVENT, "json"))
    changes = change_events.withColumns({"timestamp": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "eventtype": F.lit("eventtype2")})
    changes.select("site_id", "timestamp", "eventtype").coalesce(1).write.mode("append").json(inbox)
    handler = st.live_features(log, out, cfg, IDS)
    st.drain(stream, marks, each=handler)
    message_rows(make_events, [rows[0], rows[50]]).coalesce(1).write.mode("append").json(inbox)
    st.drain(stream, marks, each=handler)
    schema = "site_id int, anchor_ts timestamp, value string, batch_id int"
    newest = spark.read.schema(schema).parquet(out).where(F.col("anchor_ts") == F.lit(T0)).first()["value"]
    expected = feature_store.run(make_events(rows), change_events, anchor, cfg, IDS)
    assert json.loads(newest) == json.loads(results.result_json(expected.results).first()["value"])
    logged = src.read_log(spark, log, stream.schema, "eventtype1")
    assert logged.count() == 201
    assert feature_store.unique_events(logged.select("site_id", "ts", "plant_up", "records", "sequenceID")).count() == 200


def test_gate_stage_survives_as_a_table(spark):
    kept = cut_lineage(spark.range(10).withColumn("x", F.col("id") * 2))
    assert kept.where("x = 18").count() == 1
    assert "FileScan" in kept._jdf.queryExecution().executedPlan().toString()


def test_both_stages_read_inputs_that_were_written_once(spark, cfg, make_events, anchor, change_events):
    """Derived events and anchors are not derived anew for each of their readers."""
    output = feature_store.run(make_events(telemetry()), change_events, anchor, cfg, IDS, materialise_gate=True, materialise_inputs=True)
    plain = feature_store.run(make_events(telemetry()), change_events, anchor, cfg, IDS)
    plan = output.results._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan and "Scan ExistingRDD" not in plan, plan
    assert results.result_json(output.results).first()["value"] == results.result_json(plain.results).first()["value"]

"""Cases in which rows, readings or an order were once lost without a word."""

import pytest
from pyspark.sql import functions as F

from millrace.config import Feature
from millrace.operators import dedup, features, optimal, reshape
from millrace.plans import configs, lab, synthetic
from millrace.session import scratch_path
from millrace.sources import events as src
from millrace.sources import sinks
from millrace.streaming import events as st


def test_survivor_without_any_order_keeps_its_columns(spark):
    rows = [(1, None, "a", [1]), (1, None, "a", [1]), (2, None, "b", [2]), (2, 5, "c", [3]), (3, 7, "x", [4]), (3, 7, "y", [5])]
    df = spark.createDataFrame(rows, "k int, seq int, v string, records array<int>")
    got = {r.k: (r.seq, r.v, r.records) for r in dedup.survivor_per_key(df, ["k"], F.col("seq")).collect()}
    again = {r.k: (r.seq, r.v, r.records) for r in dedup.survivor_per_key(df.orderBy(F.desc("v")).repartition(3), ["k"], F.col("seq")).collect()}
    assert got == again and got[1] == (None, "a", [1]) and got[2] == (5, "c", [3]) and got[3] in ((7, "x", [4]), (7, "y", [5]))


def test_all_run_tags_must_be_on(spark):
    runs = {"x": ("r1", "r2"), "y": ("r1",)}
    rows = [(1, t, [("r1", a), ("r2", b), ("x", 5.0), ("y", 6.0), ("z", 7.0)]) for t, (a, b) in enumerate([(1.0, 1.0), (1.0, 0.0), (0.0, 1.0), (1.0, None)])]
    events = spark.createDataFrame(rows, "site_id int, ts int, records array<struct<id:string,value:double>>")
    wanted = [(5.0, 6.0), (None, 6.0), (None, None), (None, 6.0)]
    nested = {r.ts: dict(map(tuple, r.records)) for r in optimal.mask_stopped_equipment(events, runs).collect()}
    long = events.select("site_id", "ts", F.inline("records")).withColumnRenamed("id", "tag_id")
    pairs = spark.createDataFrame([(t, r) for t, several in runs.items() for r in several], "tag_id string, run_tag string")
    flat = {}
    for r in optimal.mask_stopped_equipment_long(long, pairs).collect():
        assert r.tag_id not in flat.setdefault(r.ts, {})  # no reading comes twice
        flat[r.ts][r.tag_id] = r.value
    for found in (nested, flat):
        assert [(found[t]["x"], found[t]["y"]) for t in range(4)] == wanted and all(found[t]["z"] == 7.0 for t in range(4))


TAG = "struct<enterpriseId:string,tagType:string,criticality:string,equipment:string,area:string,line:string,measure:string,position:string>"


def tag_rows(spark, *sites):
    nested = [[(name, "numeric", kind, equipment, "a", "l", "m", "p") for name, kind, equipment in site] for site in sites]
    return spark.createDataFrame([([(site,) for site in nested],)], f"sites array<struct<tags:array<{TAG}>>>")


def feature_rows(spark, **changes):
    one = dict(id=1, equipment="mill,pump", function="passthrough", lag=None, nullImpute=None, nullThreshold=None, currentTimeAggregation="ratio",
               anticipatedTimeAggregation=None, timeAggregationMinutes=60, customInput=None, plantCondition="false", area="a", line="l", measure="m", position="p")
    one |= changes
    return configs.normalise_features(spark.createDataFrame([([tuple(one.values())],)], (
        "features array<struct<id:int,equipment:string,function:string,lag:int,nullImpute:double,nullThreshold:double,currentTimeAggregation:string,"
        "anticipatedTimeAggregation:string,timeAggregationMinutes:int,customInput:string,plantCondition:string,area:string,line:string,measure:string,position:string>>")))


def test_tags_of_a_feature_come_in_configuration_order(spark):
    tags = configs.normalise_tags(tag_rows(spark, [("z_num", "n", "mill"), ("b", "n", "pump")], [("a_den", "n", "mill"), ("a", "n", "pump")]))
    lists = configs.feature_tag_lists(configs.feature_tags(feature_rows(spark), tags)).first()
    assert lists.tags == ["z_num", "a_den", "b", "a"]
    reversed_ = configs.feature_tag_lists(configs.feature_tags(feature_rows(spark, equipment="pump,mill"), tags)).first()
    assert reversed_.tags == ["b", "a", "z_num", "a_den"]


def test_resolved_configuration_keeps_order_and_all_run_tags(spark):
    tags = configs.normalise_tags(tag_rows(spark, [("z_num", "n", "mill"), ("a_den", "n", "mill"), ("run2", "Run", "mill"), ("run1", "Run", "mill")]))
    measured = tags.where("criticality = 'n'")
    runs = configs.run_tag_pairs(tags, F.col("criticality") == "Run")
    cfg = configs.resolve(feature_rows(spark, equipment="mill"), measured, runs, {})
    assert cfg.features[0].tags == ("z_num", "a_den") and cfg.run_tags_of == {"z_num": ("run1", "run2"), "a_den": ("run1", "run2")}


@pytest.mark.parametrize("changes", [{"function": "meen"}, {"currentTimeAggregation": "lost"}, {"anticipatedTimeAggregation": "x"}])
def test_unknown_names_are_refused(spark, changes):
    tags = configs.normalise_tags(tag_rows(spark, [("t", "n", "mill")]))
    with pytest.raises(ValueError, match="unknown"):
        configs.resolve(feature_rows(spark, **changes), tags, configs.run_tag_pairs(tags, F.lit(False)), {})


def test_optimal_tag_without_threshold_is_refused(spark):
    tags = configs.normalise_tags(tag_rows(spark, [("t", "n", "mill")]))
    with pytest.raises(ValueError, match="threshold"):
        configs.resolve(feature_rows(spark), tags, configs.run_tag_pairs(tags, F.lit(False)), {"optimal_tag": "t", "optimal_threshold": None})


@pytest.mark.parametrize("tags", [("a",), ("a", "b", "c")])
def test_ratio_of_other_than_two_tags_is_refused(tags):
    with pytest.raises(ValueError, match="two tags"):
        features.require_pairs([Feature(1, tags, "passthrough", current="ratio")])


def test_a_tag_twice_in_one_event(spark):
    rows = [(1, 1, [("a", 1.0), ("b", 2.0), ("a", 3.0), (None, 9.0)]), (1, 2, [("b", 5.0)]), (1, 3, [])]
    events = spark.createDataFrame(rows, "site_id int, ts int, records array<struct<id:string,value:double>>")
    got = {r.ts: r.cells for r in events.select("ts", reshape.aligned_values(F.col("records"), ["a", "b"]).alias("cells")).collect()}
    assert got == {1: [3.0, 2.0], 2: [None, 5.0], 3: [None, None]}
    assert [tuple(r) for r in reshape.repeated_readings(events).collect()] == [(1, 1, "a", 1)]


def test_two_streams_share_a_log(spark):
    schema = "site_id int, ts timestamp, eventtype string"
    log = scratch_path(spark, "log")
    for n, name in enumerate(("one", "two")):
        inbox = scratch_path(spark, "inbox")
        spark.sql(f"SELECT {n} AS site_id, timestamp'2024-01-01 00:00:00' AS ts, 'eventtype1' AS eventtype").write.parquet(inbox)
        stream = spark.readStream.schema(schema).parquet(inbox)
        checkpoint = scratch_path(spark, name)
        st.drain(stream, checkpoint, each=st.log_writer(log))
        st.drain(stream, checkpoint, each=st.log_writer(log))  # nothing new
    assert sorted(r.site_id for r in src.read_log(spark, log, stream.schema).collect()) == [0, 1]
    with pytest.raises(ValueError, match="stream"):
        src.append_event_batch(spark.read.schema(schema).parquet(inbox), log, 0)


def test_sequence_ids_go_on_over_event_types(spark):
    one = {"schema": {"timestamp": "timestamp", "records": [{"id": "string", "value": "float"}]}, "ids": [1], "interval_seconds": 3600}
    span = {"start_time": "2024-01-01T00:00:00", "end_time": "2024-01-01T02:00:00"}
    path = scratch_path(spark, "made")
    sites = spark.createDataFrame([(0,), (3,)], "site_id int")
    synthetic.generate(sites, {"event_types": {"eventtype1": one | span, "eventtype2": one | span}}, path)
    ids = [r.sequenceID for r in spark.read.json(path).collect()]
    assert len(ids) == 12 == len(set(ids))
    with pytest.raises(Exception, match="16 digits"):
        spark.range(1).select(synthetic.sequence_id(F.lit(9 * 10**15))).collect()


def test_goals_without_results_and_results_without_goals(spark):
    names = dict(sample="s", test_sample="ts", test="t", result_test="rt", result_analysis="ra", analysis="a", goal=["g", "h"])
    keys = lab.LabKeys(**names)
    make = spark.createDataFrame
    data = lab.lab_dataset(
        make([(1,), (1,), (2,)], "s int"), make([(1, 1), (2, 2)], "ts int, t int"), make([(1, 1, 7, 7), (2, 1, 8, None)], "rt int, ra int, g int, h int"),
        make([(1,)], "a int"), make([(7, 7, "met"), (9, 9, "unmet"), (8, None, "null key")], "g int, h int, goal string"), keys)
    assert sorted((r.g, r.s, r.goal) for r in data.collect() if r.s is not None) == [(7, 1, "met"), (8, 2, None)]
    assert sorted((r.g, r.goal) for r in data.collect() if r.s is None) == [(8, "null key"), (9, "unmet")]


def test_dates_are_written_to_few_files(spark):
    path = scratch_path(spark, "dates")
    days = spark.range(2000).selectExpr("id", "date_add(date'2024-01-01', cast(id % 20 AS int)) AS field_date").repartition(16)
    sinks.overwrite_dates(days, path)
    assert len(spark.read.parquet(path).inputFiles()) <= 20 * 2 and spark.read.parquet(path).count() == 2000


def test_a_gap_of_years_is_filled_without_one_long_row(spark):
    from millrace.functions.times import Grid
    from millrace.operators.signals import regularise

    rows = [(1, "1969-12-31 23:00:30", 1.0), (1, "1969-12-31 23:00:10", 3.0), (1, "1974-06-01 00:01:00", 5.0), (2, "2024-01-01 00:00:00", 7.0)]
    df = spark.createDataFrame(rows, "site_id int, ts string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    found = regularise(df, ["site_id"], Grid(60))
    steps = found.groupBy("site_id").agg(F.count("*").alias("n"), F.count("value").alias("held"), F.count_distinct("ts").alias("times")).collect()
    span = spark.sql("SELECT (unix_seconds(timestamp'1974-06-01 00:01:00') - unix_seconds(timestamp'1969-12-31 23:00:00')) div 60 + 1 AS n").first().n
    assert {(r.site_id, r.n, r.held, r.times) for r in steps} == {(1, span, 2, span), (2, 1, 1, 1)}
    assert found.agg(F.max("value"), F.sum("value")).first() == (7.0, 14.0)


def test_newest_row_is_carried_over_many_runs_of_buckets(spark):
    from millrace.operators.joins import latest_before

    day = 86_400_000_000
    series = spark.sql("SELECT 1 AS site_id, timestamp_micros(id * 40 * 86400000000L) AS ts, id AS v FROM range(1, 30)")
    anchors = spark.sql("SELECT 1 AS site_id, timestamp_micros(id * 86400000000L) AS anchor_ts FROM range(0, 1300)")
    got = {r.day: r.v for r in latest_before(series, anchors, F.col("v"), "v", day // 24).selectExpr("unix_micros(anchor_ts) div 86400000000 AS day", "v").collect()}
    assert got == {d: min(d // 40, 29) if d >= 40 else None for d in range(1300)}


def test_a_grid_of_one_site_is_dealt_out(spark):
    sites = spark.sql("SELECT 5 AS site_id")
    start, end = F.lit("2024-01-01").cast("timestamp"), F.lit("2024-02-01").cast("timestamp")
    grid = synthetic.time_grid(sites, start, end, 60)
    assert grid.count() == grid.distinct().count() == 31 * 1440 + 1
    assert grid.agg(F.min("ts") == start, F.max("ts") == end).first() == (True, True)

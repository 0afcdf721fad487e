"""Readers, log, sinks, lab loads, streaming dedup and synthetic events."""

import pytest
from pyspark.sql import functions as F

from conftest import T0, minute
from millrace.functions import times
from millrace.operators import filters, joins, reshape
from millrace.plans import lab, synthetic
from millrace.session import scratch_path
from millrace.sources import events as src
from millrace.streaming import events as st


def test_event_times_with_and_without_fraction(spark):
    texts = ["2023-10-01T06:30:00Z", "2023-10-01T06:30:00.123456Z", "2023-10-01T08:30:00+02", "yesterday", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(times.format_event_time(times.parse_event_time(F.col("t"))))
    assert [r[0] for r in rows.collect()] == ["2023-10-01T06:30:00.000000Z", "2023-10-01T06:30:00.123456Z", "2023-10-01T06:30:00.000000Z", None, None]


def test_empty_folder_reads_as_empty_frame(spark, tmp_path):
    assert src.read_json_events(spark, str(tmp_path)).count() == 0


def test_log_keeps_types_apart_and_prunes_folders(spark, make_events, tmp_path):
    log = str(tmp_path / "log")
    events = make_events([(k, 1, {"a": 1.0}) for k in (0, 1, 1500)]).withColumn("eventtype", F.when(F.col("ts") == F.lit(T0), "two").otherwise("one"))
    src.append_events(events, log)
    src.append_events(events.limit(1), log)
    one = src.read_log(spark, log, events.schema, "one")
    assert one.count() + src.read_log(spark, log, events.schema, "two").count() == 4
    day = src.between_days(one, F.lit(T0), F.lit(T0))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(eventtype" in plan and "event_date" in plan.split("PartitionFilters")[1].split("]")[0]
    assert src.newest_anchor(one).first()["anchor_ts"].replace(tzinfo=None) == minute(1).replace(tzinfo=None)


def test_explode_keeps_rows_with_empty_lists(spark):
    df = spark.createDataFrame([(1, []), (2, None), (3, [("a", 1.0)])], "k int, r array<struct<id:string,value:double>>")
    assert sorted(tuple(r) for r in reshape.explode_structs(df, "r").collect()) == [(1, None, None), (2, None, None), (3, "a", 1.0)]


def test_date_windows_are_closed_and_methods_checked(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), ("2024-01-16",), ("2024-01-17",), ("2024-01-18",)], "d string").select(F.to_date("d").alias("sample_date"))
    kept = filters.date_window(df, "incremental", F.lit("2024-01-17"))
    assert [str(r[0]) for r in kept.orderBy("sample_date").collect()] == ["2024-01-02", "2024-01-16", "2024-01-17"]
    assert filters.date_window(df, "full", F.lit("2024-01-17")).count() == 5
    with pytest.raises(ValueError, match="Incorrect load-method"):
        filters.date_window(df, "sometimes", F.lit("2024-01-17"))


def test_load_is_incremental_once_the_target_exists(spark):
    df = spark.createDataFrame([("2020-01-01",), ("2024-01-16",)], "d string").select(F.to_date("d").alias("sample_date"))
    assert filters.load_selection(df, "lab_target", F.lit("2024-01-17")).count() == 2
    df.write.option("path", scratch_path(spark, "table")).saveAsTable("lab_target")
    try:
        assert filters.load_selection(df, "lab_target", F.lit("2024-01-17")).count() == 1
    finally:
        spark.sql("DROP TABLE lab_target")


def test_range_join_matches_the_plain_predicate_on_a_hot_site(spark):
    """One site holds most rows, many at the same instant; bucket borders fall on rows and anchors."""
    series = spark.range(3000).select(
        F.when(F.col("id") % 10 < 9, 1).otherwise(2).alias("site_id"),
        F.timestamp_seconds(F.when(F.col("id") % 3 == 0, 6000).otherwise(F.col("id") * 7 - 5000)).alias("ts"), "id",
    )
    anchors = spark.range(40).select((F.col("id") % 2 + 1).cast("int").alias("site_id"), F.timestamp_seconds(F.col("id") * 500 - 4000).alias("anchor_ts"))
    for span in (1000, 999, 7):
        for closed in (True, False):
            back = F.unix_seconds("anchor_ts") - F.unix_seconds("ts")
            inside = back.between(0 if closed else 1, span)
            plain = series.join(anchors, "site_id").where(inside)
            fast = joins.anchor_slice(series, anchors, span * 1_000_000, closed)
            key = ["site_id", "anchor_ts", "id"]
            assert fast.select(key).exceptAll(plain.select(key)).count() == 0
            assert fast.count() == plain.count()


def test_latest_before_matches_brute_force(spark):
    series = spark.range(200).select((F.col("id") % 3).cast("int").alias("site_id"), F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(100000))).alias("ts"), "id")
    anchors = spark.range(60).select((F.col("id") % 4).cast("int").alias("site_id"), F.timestamp_seconds(F.col("id") * 2000 - 5000).alias("anchor_ts"))
    got = joins.latest_before(series, anchors, F.col("id"), "v", 3_000_000_000)
    rows = {}
    for r in series.collect():
        rows.setdefault(r["site_id"], []).append((r["ts"], r["id"]))
    for r in got.collect():
        before = [x for x in rows.get(r["site_id"], []) if x[0] <= r["anchor_ts"]]
        assert (r["found_ts"], r["v"]) == (max(before) if before else (None, None))
    assert got.count() == 60


def test_lab_dataset_equals_dropping_duplicates_at_the_end(spark):
    sample = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c")], "SAMPLE_ID int, s string")
    test = spark.createDataFrame([(1, 10), (1, 11), (2, 20)], "TEST_SAMPLE_ID int, test_id int")
    result = spark.createDataFrame([(10, 5, 1, 1), (11, 6, 1, 2), (20, 7, 2, 2)], "RESULT_TEST_ID int, RESULT_aid int, k1 int, k2 int")
    analysis = spark.createDataFrame([(5, "x"), (6, "y")], "ANALYSIS_aid int, name string")
    goal = spark.createDataFrame([(1, 1, "g"), (9, 9, "h")], "k1 int, k2 int, g string")
    keys = lab.LabKeys("SAMPLE_ID", "TEST_SAMPLE_ID", "test_id", "RESULT_TEST_ID", "RESULT_aid", "ANALYSIS_aid", ["k1", "k2"])
    late = lab.join_chain(sample, test, result, analysis, keys, strict_inner=False).dropDuplicates().join(goal, ["k1", "k2"], "outer")
    early = lab.lab_dataset(sample, test, result, analysis, goal, keys)
    assert early.exceptAll(late).count() == 0 and early.count() == late.count() == 3


def test_stream_drops_copies_across_batches(spark):
    inbox, marks, out = (scratch_path(spark, x) for x in ("in", "marks", "out"))
    base = spark.createDataFrame([(1, minute(k), float(k)) for k in range(5)], "site_id int, ts timestamp, value double").coalesce(1)
    base.write.parquet(inbox)
    stream = st.unique_stream(st.file_stream(spark, inbox, base.schema), ["site_id", "ts"], "1 hour")
    for attempt in range(2):
        if attempt:
            base.write.mode("append").parquet(inbox)
        st.drain(stream, marks, out)
    assert spark.read.schema(base.schema).parquet(out).count() == 5


def test_replayed_batch_is_written_once(spark, make_events):
    log = scratch_path(spark, "log")
    events = make_events([(k, 1, {"a": 1.0}) for k in range(4)]).withColumn("eventtype", F.lit("one"))
    for batch in (0, 1, 1):
        src.append_event_batch(events, log, batch, "plant")
    assert src.read_log(spark, log, events.schema, "one").count() == 8


SPEC = synthetic.EventSpec({"p_Up": "int", "flag": "bool", "text": "string", "what": "nothing"}, ids=["1", "2"], allowed={"1": [0.0, 1.0], "p_Up": [0, 1]}, nullable=["value", "flag"], float_range=(10.0, 100.0))


def test_synthetic_events_follow_their_configuration(spark):
    sites = spark.range(20).select(F.col("id").cast("int").alias("site_id"))
    grid = synthetic.time_grid(sites, F.lit("2024-10-05 08:00:00").cast("timestamp"), F.lit("2024-10-05 10:00:00").cast("timestamp"), 60)
    made = synthetic.synthetic_events(grid, SPEC)
    again = synthetic.synthetic_events(grid.repartition(5), SPEC)
    assert made.count() == 20 * 121 and made.exceptAll(again).count() == 0
    rows = made.collect()
    assert {r["p_Up"] for r in rows} == {0, 1} and {r["what"] for r in rows} == {""}
    assert all(len(r["text"]) == 10 and r["text"].isalpha() for r in rows)
    values = {i: [x["value"] for r in rows for x in r["records"] if x["id"] == i] for i in ("1", "2")}
    assert set(values["1"]) == {0.0, 1.0}
    held = [v for v in values["2"] if v is not None]
    assert all(10 <= v <= 100 for v in held) and 0.75 < len(held) / len(values["2"]) < 0.85
    assert 0.15 < sum(r["flag"] is None for r in rows) / len(rows) < 0.25
    ids = [r[0] for r in spark.range(1000).select(synthetic.sequence_id(F.col("id"))).collect()]
    assert len(set(ids)) == 1000 and {len(i) for i in ids} == {16} and ids == sorted(ids)


def test_written_synthetic_events_read_back(spark):
    grid = spark.createDataFrame([(1, T0)], "site_id int, ts timestamp")
    path = scratch_path(spark, "synthetic")
    made = synthetic.synthetic_events(grid, SPEC).withColumn("timestamp", times.format_event_time(F.col("ts"))).drop("ts")
    synthetic.write_events(made, path)
    back = src.read_json_events(spark, path).first()
    assert back["ts"].replace(tzinfo=None) == T0.replace(tzinfo=None) and len(back["records"]) == 2


def test_configured_run_writes_every_event_type(spark):
    one = {
        "schema": {"timestamp": "Timestamp", "p_Up": "int", "records": [{"id": "int", "value": "Float"}]},
        "start_time": "2024-10-05 08:00:00", "end_time": "2024-10-05 10:00:00", "ids": list(range(1, 16)), "interval_seconds": 60,
        "allowed_values": {**{str(i): [0, 1] for i in range(1, 11)}, "p_Up": [0, 1]}, "f_min_value": 10.0, "f_max_value": 100.0,
    }
    path = scratch_path(spark, "generated")
    sites = spark.range(3).select(F.col("id").cast("int").alias("site_id"))
    synthetic.generate(sites, {"event_types": {"input": one, "other": {**one, "ids": None}}}, path)
    made = spark.read.json(path)
    assert {r["eventtype"]: r["count"] for r in made.groupBy("eventtype").count().collect()} == {"input": 363, "other": 363}
    first = made.where("eventtype = 'input'")
    assert first.select("sequenceID").distinct().count() == 363
    assert first.where("size(records) = 15 and p_Up in (0, 1)").count() == 363
    values = first.select(F.explode("records").alias("r")).where("cast(r.id as int) > 10").agg(F.min("r.value"), F.max("r.value")).first()
    assert 10 <= values[0] < values[1] <= 100
    assert made.where("eventtype = 'other'").select("records").first()[0][0]["id"] == "#NA"


def test_tables_come_from_a_folder_or_the_catalog(spark):
    folder = scratch_path(spark, "tables")
    spark.range(3).write.parquet(f"{folder}/sample")
    assert src.read_table(spark, "sample", folder).count() == 3
    spark.range(2).createOrReplaceTempView("goal_view")
    assert src.read_table(spark, "goal_view").count() == 2


def test_small_spans_of_many_sites_are_written_out_by_many_tasks(spark):
    """The rows that say how long a site reports are few bytes; what is made from them is not."""
    sites = spark.createDataFrame([(i, T0, minute(-50)) for i in range(40)], "site_id int, lo timestamp, hi timestamp")
    grid = synthetic.time_grid(sites, F.col("lo"), F.col("hi"), 60)
    per_task = [r["count"] for r in grid.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert sum(per_task) == 40 * 51 and max(per_task) < 40 * 51


def test_lab_dataset_makes_its_joined_rows_once(spark):
    """The goals left over are found among the same joined rows, up to their last shuffle; null keys meet nothing."""
    sample = spark.createDataFrame([(1, "a"), (2, "b")], "SAMPLE_ID int, s string")
    test = spark.createDataFrame([(1, 10), (1, 11), (2, 20)], "TEST_SAMPLE_ID int, test_id int")
    result = spark.createDataFrame([(10, 5, 1, 1), (11, 6, 1, None), (20, 5, None, None)], "RESULT_TEST_ID int, RESULT_aid int, k1 int, k2 int")
    analysis = spark.createDataFrame([(5, "x"), (6, "y")], "ANALYSIS_aid int, name string")
    goal = spark.createDataFrame([(1, 1, "g"), (1, None, "n"), (None, None, "m"), (9, 9, "h")], "k1 int, k2 int, g string")
    keys = lab.LabKeys("SAMPLE_ID", "TEST_SAMPLE_ID", "test_id", "RESULT_TEST_ID", "RESULT_aid", "ANALYSIS_aid", ["k1", "k2"])
    wanted = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    known = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        joined = lab.join_chain(sample.distinct(), test.distinct(), result.distinct(), analysis, keys)
        whole = lab.lab_dataset(sample, test.distinct(), result.distinct(), analysis, goal, keys)
        plans = [x._jdf.queryExecution().executedPlan().toString() for x in (joined, whole)]
        chain, both = (sum("- Exchange " in line for line in p.splitlines()) for p in plans)
        # besides those of the joined rows: joined rows and goals by goal, the keys that are met and the goals again
        assert both <= chain + 5, plans[1]
        late = joined.join(goal, ["k1", "k2"], "outer")
        assert whole.exceptAll(late).count() == 0 and whole.count() == late.count() == 6
    finally:
        for k, v in known.items():
            spark.conf.set(k, v)

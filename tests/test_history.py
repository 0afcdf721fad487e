"""Gap filling, plant conditions, duplicates and warnings on a minute grid."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import T0, minute
from millrace.config import Feature, StoreConfig
from millrace.functions.times import Grid
from millrace.operators import dedup, history
from millrace.plans.feature_store import unique_events

CFG = StoreConfig(features=())


def full(up=lambda k: 1, skip=lambda k: False, last=151):
    return [(k, up(k), {"a": float(k)}) for k in range(last) if not skip(k)]


def frame_rows(events, anchor):
    return history.short_frame(history.compact_events(events, ["a"]), anchor, CFG)


@pytest.mark.parametrize(
    "skip",
    [lambda k: k > 30, lambda k: 0 < k < 30, lambda k: 90 < k < 120, lambda k: k > 0, lambda k: False],
    ids=["gap at start", "gap at end", "gap in the middle", "no history", "no gap"],
)
def test_always_121_rows(make_events, anchor, skip):
    rows = frame_rows(make_events(full(skip=skip)), anchor).orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, 122))
    for r in rows:
        k = r["rank"] - 1
        if skip(k):
            assert r["cells"] is None and r["plant_up"] == 0
        else:
            assert r["cells"] == [float(k)] and r["plant_up"] == 1


def test_rows_off_the_grid_do_not_count(spark, make_events, anchor):
    from datetime import timedelta

    odd = spark.createDataFrame([(1, T0 - timedelta(seconds=90), 1, [("a", 5.0)])], make_events([]).schema)
    rows = frame_rows(odd, anchor).where("cells is not null").count()
    assert rows == 0


def test_anchor_without_any_event_of_its_own(make_events, anchor):
    rows = frame_rows(make_events(full(skip=lambda k: True) or [(500, 1, {"a": 1.0})]), anchor)
    assert rows.count() == 121
    assert rows.where("cells is not null").count() == 0


@pytest.mark.parametrize(
    "up,expected",
    [
        (lambda k: 1, (1, 0, 60)),
        (lambda k: int(k > 29), (0, 0, 31)),  # half an hour down in the last hour
        (lambda k: int(not 90 < k <= 120), (0, 0, 60)),  # half an hour down in the hour before
        (lambda k: int(k <= 120), (1, 1, 60)),  # down before the slice: switched on since
        (lambda k: int(not 0 < k <= 12), (0, 0, 48)),  # exactly 80% is not enough
        (lambda k: int(not 0 < k <= 11), (1, 0, 49)),
    ],
)
def test_plant_conditions(make_events, anchor, up, expected):
    row = frame_rows(make_events(full(up=up)), anchor).first()
    assert tuple(int(v) for v in row["constants"]) == expected


def test_duplicates_collapse_to_one_deterministic_survivor(spark, make_events, anchor):
    events = make_events(full()).withColumn("sequenceID", F.lit("1"))
    copies = events.where(F.col("ts") == F.lit(minute(30))).withColumn("sequenceID", F.lit("2")).withColumn("plant_up", F.lit(0))
    many = events.unionByName(copies).unionByName(events)
    unique = unique_events(many)
    assert unique.count() == 151
    kept = unique.where(F.col("ts") == F.lit(minute(30))).first()
    assert kept["sequenceID"] == "2" and kept["plant_up"] == 0
    surplus = dedup.duplicate_counts(many, ["site_id", "ts"])
    assert surplus.where("surplus = 2").count() == 1 and surplus.where("surplus = 1").count() == 150
    assert frame_rows(unique.drop("sequenceID"), anchor).count() == 121


def test_newest_event_is_the_trigger(make_events):
    newest, rest = dedup.newest_and_rest(make_events(full()))
    assert newest.first()["ts"].replace(tzinfo=None) == T0.replace(tzinfo=None)
    assert rest.count() == 150


def test_warnings(make_events, anchor):
    events = make_events(full(up=lambda k: int(k > 29), skip=lambda k: k in (40, 41)))
    dense = history.dense_history(history.compact_events(events, ["a"]), anchor, Grid(60), 150)
    copies = dedup.duplicate_counts(events.unionByName(events.limit(3)), ["site_id", "ts"])
    row = history.history_warnings(dense, copies, anchor, 60, 0.8).first()
    assert (row["duplicate_rows"], row["missing_steps"], row["no_history"], row["has_gaps"]) == (3, 2, False, True)
    assert row["low_last_hour"] and not row["low_hour_before"]
    assert row["up_last_hour"] == pytest.approx(29 / 60)


def test_long_frame_keeps_rows_as_they_are(make_events, anchor):
    cfg = replace(CFG, features=(Feature(1, ("a",)),))
    events = make_events([(k, 1, {"a": float(k)}) for k in (0, 7, 100, 2879, 2880, 3300, 3301)])
    rows = history.long_frame(history.compact_events(events, ["a"]), anchor, cfg).orderBy("rank").collect()
    assert [r["cells"][0] for r in rows] == [0.0, 7.0, 100.0, 2879.0, 2880.0, 3300.0]
    assert {r["tail_rows"] for r in rows} == {4}


def test_long_frame_without_history_falls_back_to_the_empty_short_grid(make_events, anchor):
    events = make_events([(0, 1, {"a": 1.0}), (4000, 1, {"a": 2.0})])
    rows = history.long_frame(history.compact_events(events, ["a"]), anchor, CFG).orderBy("rank").collect()
    assert len(rows) == 121
    assert rows[0]["cells"] == [1.0] and all(r["cells"] is None for r in rows[1:])


def test_result_is_independent_of_row_order_and_partitioning(make_events, anchor):
    rows = full(up=lambda k: k % 3 and 1 or 0, skip=lambda k: k % 5 == 2)
    first = frame_rows(make_events(rows), anchor).orderBy("rank").collect()
    second = frame_rows(make_events(rows[::-1]).repartition(7), anchor).orderBy("rank").collect()
    assert first == second

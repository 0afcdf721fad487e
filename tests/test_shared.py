"""Shared series against one copy of every slice per anchor, and how their work grows."""

import math
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import EVENT_DDL, T0
from millrace.config import Feature, StoreConfig
from millrace.operators import features as fo
from millrace.operators import shared
from millrace.operators.history import ANCHOR, compact_events
from millrace.plans.feature_store import compute_features

FEATURES = (
    Feature(1, ("a", "b"), "mean", 20, 3.0, 0.1, "mean", "last", 60),
    Feature(2, ("a", "b"), "max", 90, None, 0.9, "last", "mean", 30),
    Feature(3, ("d",), "greater", None, None, 0.5, "last", "mean", 60, ("1",)),
    Feature(4, ("a", "d", "b"), "passthrough", 15, 0.0, 0.5, "mean", "last", 60),
    Feature(5, ("b", "a"), "passthrough", None, 2.0, 0.5, "ratio", None, 45),
    Feature(6, (), "moisture_target", 100, None, 0.5, "last", "mean", 60),
    Feature(7, ("a",), "mean", 2, None, 0.5, "torque", None, 120),
    Feature(8, ("d",), "mean", None, None, 0.5, "torque", None, 120),
    Feature(9, (), None, None, 1.5, 0.5, "mean", "mean", 60),
    Feature(11, ("plantup_time",), None, None, None, 0.5, "last", None, 60),
    Feature(12, ("plantup_switch",), None, None, None, 0.5, "mean", None, 60),
    Feature(13, ("plantup_minutes",), "mean", 30, None, 0.5, "last", "mean", 60),
    Feature(14, ("plantup_minutes", "plantup_time"), "passthrough", None, None, 0.5, "ratio", None, 60),
    Feature(15, ("plantup_minutes", "d"), "max", None, None, 0.5, "mean", None, 60),
    Feature(16, ("plantup_minutes",), "mean", None, None, 0.5, "torque", None, 120),
    Feature(21, ("a", "b"), "mean", 10, 7.0, 0.5, "mean", "last", 288),
    Feature(22, ("d",), "max", 70, None, 0.5, "last", "mean", 288),
    Feature(23, ("b",), "mean", None, None, 0.5, "torque", "mean", 288),
    Feature(24, ("d",), "greater", None, None, 0.5, "mean", "last", 288, ("1",)),
)
CFG = StoreConfig(features=FEATURES, smoothed_tags=("a", "b"), moisture_target=8.1, trend_high=30.0, trend_high_high=45.0, long_slice_steps=330, long_steps=288)
HALF = timedelta(seconds=30)


def random_events(spark, minutes, sites=(1, 2)):
    """Minutes before ``T0``; the second site is sparse, has a day without events and some off the minute."""
    draw = np.random.default_rng(8)
    rows = []
    for site in sites:
        for k in range(minutes):
            if site == 2 and (draw.random() < 0.8 or 500 < k < 900):
                continue
            tags = [(t, None if draw.random() < 0.15 else float(v)) for t, v in zip("abd", (draw.uniform(0, 80).__round__(3), 40.0, k % 3 == 0))]
            shift = HALF if site == 2 and draw.random() < 0.3 else timedelta(0)
            rows.append((site, T0 - timedelta(minutes=k) + shift, int(draw.random() < 0.9), tags))
    return spark.createDataFrame(rows, EVENT_DDL)


def anchors_of(spark, minutes_back, sites=(1, 2), shift=timedelta(0)):
    return spark.createDataFrame([(s, T0 - timedelta(minutes=k) + shift) for s in sites for k in minutes_back], "site_id int, anchor_ts timestamp")


def by_feature(df):
    return {(r.site_id, r.anchor_ts, r.feature_id): r for r in df.collect()}


def alike(x, y):
    if x is None or y is None:
        return x is y
    if isinstance(x, list):
        return len(x) == len(y) and all(map(alike, x, y))
    return math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9)


def test_shared_series_equal_slices_of_their_own(spark, monkeypatch):
    events = random_events(spark, 1500)
    # dense and odd instants, a gap, the first events, and long before them
    instants = anchors_of(spark, [0, 1, 7, 151, 160, 505, 700, 899, 1385, 1499, 1500, 1560, 1700, 4000])
    instants = instants.unionByName(anchors_of(spark, [3, 640, 1490], shift=HALF))
    together = by_feature(compute_features(events, instants, CFG))
    monkeypatch.setattr(shared, "shares_work", lambda *_: False)
    alone = by_feature(compute_features(events, instants, CFG))
    assert together.keys() == alone.keys() and len(together) == 34 * len(FEATURES)
    for key, row in alone.items():
        for name in ("current", "anticipated", "null_share", "too_many_nulls", "current_list", "anticipated_list"):
            assert alike(together[key][name], row[name]), (key, name, together[key][name], row[name])
    shown = {f.id: [r.current for (_, _, i), r in together.items() if i == f.id and r.current is not None] for f in FEATURES}
    assert all(shown.values()) and {0.0, 1.0} <= set(shown[11])
    assert all(len(r.current_list) == 3 for (_, _, i), r in together.items() if i == 4)


def test_without_smoothing_no_slice_is_read_apart(spark, monkeypatch):
    cfg = CFG.subset(tuple(f for f in FEATURES if f.id in (1, 3, 4, 21, 22)))
    bare = StoreConfig(**{**vars(cfg), "smoothed_tags": ()})
    events, instants = random_events(spark, 700), anchors_of(spark, [0, 33, 640])
    monkeypatch.setattr(shared, "edge_rows", lambda *_: pytest.fail("no median is cut off"))
    together = by_feature(compute_features(events, instants, bare))
    monkeypatch.setattr(shared, "shares_work", lambda *_: False)
    for key, row in by_feature(compute_features(events, instants, bare)).items():
        assert all(alike(together[key][n], row[n]) for n in ("current", "anticipated", "null_share", "current_list"))


def rows_by_kind(spark, events, anchors, dense):
    """Rows behind the shuffle of events: of series, and of what anchors read and have for themselves."""
    h = shared.horizon(CFG, dense)
    chosen = [f for f in (CFG.short_features if dense else CFG.long_features) if shared.shares_work(f, CFG, h) and not shared.is_constant(f, h)]
    slots = fo.Slots(tuple(fo.needed_tags(chosen, CFG)))
    compact = compact_events(events, slots.tags)
    facts = shared.dense_facts(anchors, h) if dense else shared.row_facts(events, anchors, h, CFG)
    series = shared.series_values(shared.block_rows(compact, anchors, h, True), CFG, chosen, slots, dense).count()
    table = shared.reading_table(spark, chosen, {f.id for f in chosen}, not dense)
    return series, shared.range_requests(facts, table, h).count() / len(chosen), shared.edge_rows(compact, facts, h).count()


@pytest.mark.parametrize("dense", [True, False])
def test_rows_grow_with_events_and_not_with_slices(spark, dense):
    """Ten times the anchors read the same series; each adds a few rows, however long its slice is."""
    events = random_events(spark, 1200, sites=(1,))
    few, many = ([k for k in range(0, 200, step)] for step in (20, 2))
    series, reads, edges = rows_by_kind(spark, events, anchors_of(spark, few, (1,)), dense)
    series10, reads10, edges10 = rows_by_kind(spark, events, anchors_of(spark, many, (1,)), dense)
    assert series10 == series
    for n, found in ((len(few), (reads, edges)), (len(many), (reads10, edges10))):
        # at most four readings of two blocks and two ends, and twice twice the width of a median
        assert found[0] <= 16 * n and found[1] <= 2 * 31 * n
    h = shared.horizon(CFG, dense)
    steps = events.count() if not dense else -(-1200 // h.block_steps + 1) * h.block_steps
    assert series <= 1.2 * len(CFG.features) * steps
    assert (16 + 62) * len(many) < (CFG.slice_steps if dense else CFG.long_slice_steps) * len(many)


def test_events_are_shuffled_once_by_block_and_series_not_again(spark):
    """The series stay where the block shuffle put them: prefixes and look-ups add no exchange of their own."""
    h = shared.horizon(CFG, True)
    chosen = [f for f in CFG.short_features if f.id in (1, 3)]
    slots = fo.Slots(tuple(fo.needed_tags(chosen, CFG)))
    compact, anchors = compact_events(random_events(spark, 300), slots.tags), anchors_of(spark, [0, 5])
    values = shared.series_values(shared.block_rows(compact, anchors, h, True), CFG, chosen, slots, True)
    requests = shared.range_requests(shared.dense_facts(anchors, h), shared.reading_table(spark, chosen, {1}, False), h)
    plan = shared.range_pieces(shared.with_prefixes(values, []), requests)._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) >= 2, plan
    assert not any("feature_id" in line or "pos#" in line for line in shuffles), plan


def test_horizon_of_a_slice_as_short_as_a_median_is_not_shared(spark, monkeypatch):
    cfg = StoreConfig(features=(Feature(1, ("a",), "mean", None, None, 0.5, "mean", "mean", 5),), smoothed_tags=("a",), slice_steps=12, switch_steps=15, hour_steps=6)
    assert not shared.shares_work(cfg.features[0], cfg, shared.horizon(cfg, True))
    found = compute_features(random_events(spark, 60, (1,)), anchors_of(spark, [0], (1,)), cfg).collect()
    assert len(found) == 1 and found[0].current is not None


def test_anchor_columns_do_not_clash(spark):
    anchors = anchors_of(spark, [0], (1,)).withColumns({c: F.lit(1) for c in ("phase", "rows", "pos", "kind", "value")})
    events = random_events(spark, 200, (1,)).withColumns({c: F.lit(1) for c in ("phase", "own", "value", "side")})
    found = compute_features(events, anchors, CFG)
    assert found.count() == len(FEATURES) and found.columns[:2] == ANCHOR


def test_prefixes_read_no_frame_to_the_end_and_are_not_sorted_again(spark):
    """A trend's next point comes from one pass over a block, not from its rest for every row, and look-ups meet prefixes in their order."""
    h = shared.horizon(CFG, True)
    chosen = [f for f in CFG.short_features if f.current == fo.TORQUE and shared.shares_work(f, CFG, h)]
    slots = fo.Slots(tuple(fo.needed_tags(chosen, CFG)))
    compact, anchors = compact_events(random_events(spark, 300), slots.tags), anchors_of(spark, [0, 5])
    values = shared.series_values(shared.block_rows(compact, anchors, h, True), CFG, chosen, slots, True)
    prefixes = shared.with_prefixes(values, [f.id for f in chosen])
    requests = shared.range_requests(shared.dense_facts(anchors, h), shared.reading_table(spark, chosen, set(), False), h)
    plan = shared.range_pieces(prefixes, requests)._jdf.queryExecution().executedPlan().toString()
    assert chosen and "unboundedfollowing" not in plan, plan
    again = [line for line in plan.splitlines() if " Sort [" in line and "feature_id" in line and " pos#" in line and "elem" not in line]
    assert not again, plan
    held = prefixes.where("value IS NOT NULL AND `from`.x <> pos").count()
    late = prefixes.where("value IS NULL AND `from`.x <= pos").count()
    assert held == late == 0

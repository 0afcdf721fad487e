"""Feature semantics on a minute grid against plain pandas and numpy."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import T0, minute
from millrace.config import Feature, StoreConfig
from millrace.functions import scalar
from millrace.operators import features as fo
from millrace.operators import history, optimal, quality, signals, trend
from millrace.plans.feature_store import compute_features

RNG = np.random.default_rng(5)


def random_series(n, missing=0.2, low=0.0, high=100.0):
    values = RNG.uniform(low, high, n).round(3)
    return [None if RNG.random() < missing else float(v) for v in values]


@pytest.fixture(scope="module")
def history_rows():
    a, b, flag = random_series(151), random_series(151, 0.5), [float(x) for x in RNG.integers(0, 2, 151)]
    up = [int(x) for x in RNG.random(151) < 0.9]
    return [(k, up[k], {"a": a[k], "b": b[k], "d": flag[k]}) for k in range(151)]


FEATURES = (
    Feature(1, ("a", "b"), "mean", 20, 3.0, 0.1, "mean", "mean", 60),
    Feature(2, ("a", "b"), "max", 90, None, 0.9, "last", "mean", 30),
    Feature(3, ("d",), "greater", None, None, 0.5, "mean", "last", 60, ("1",)),
    Feature(4, ("a", "b"), "passthrough", 15, 0.0, 0.5, "ratio", None, 60),
    Feature(5, ("a",), "mean", -10, None, 0.5, "mean_greater", "mean", 60, ("50",)),
    Feature(6, (), "thickener_underflow_mass_rate", None, None, 0.5, "mean", "mean", 60, ("a", " b", "d", "a ")),
    Feature(7, (), "moisture_target", 100, None, 0.5, "last", "mean", 60),
    Feature(8, ("a",), "mean", None, None, 0.5, "torque", None, 120),
    Feature(9, ("a",), "mean", None, None, 0.5, None, None, 60),
)
CFG = StoreConfig(features=FEATURES, smoothed_tags=("a", "b"), moisture_target=8.1, trend_high=40.0, trend_high_high=45.0)


def pandas_reference(rows):
    """The same features, one site and anchor, the way a notebook would compute them."""
    frame = pd.DataFrame(
        [{"ts": minute(k).replace(tzinfo=None), "up": up, **tags} for k, up, tags in rows if k <= 120]
    ).set_index("ts").sort_index().astype(float)
    for tag in ("a", "b"):
        frame[tag] = frame[tag].rolling("15min", min_periods=7, center=True).median()
    values = {
        1: frame[["a", "b"]].mean(axis=1), 2: frame[["a", "b"]].max(axis=1), 3: (frame["d"] >= 1).astype(float),
        5: frame["a"], 6: (frame["a"] * frame["b"]).fillna(frame["d"] * frame["a"]),
        7: pd.Series(8.1, index=frame.index), 8: frame["a"], 9: frame["a"],
    }
    nulls = {i: s.isna().mean() for i, s in values.items()} | {4: 0.0}
    up = frame["up"] == 1
    values[1] = values[1].where(values[1].notna() | ~up, 3.0)
    first, second = (frame[t].where(frame[t].notna() | ~up, 0.0) for t in ("a", "b"))
    out = {}
    for f in FEATURES:
        def tail(series, lag, agg):
            bins = series.shift(lag).resample(f"{f.steps}min", origin="end")
            return getattr(bins, agg)().iloc[-1]

        lag = f.lag or 0
        ahead_lag = lag - 60 if lag > 60 else 0
        now, ahead = None, None
        if f.current in ("mean", "last"):
            now = tail(values[f.id], lag, f.current)
        elif f.current == "mean_greater":
            now = float(tail(values[f.id], lag, "mean") >= f.threshold)
        elif f.current == "ratio":
            now = first.shift(lag).tail(f.steps).mean() / second.shift(lag).tail(f.steps).mean()
        elif f.current == "torque":
            now = torque_reference(values[f.id].tail(120).to_numpy(), CFG.trend_high, CFG.trend_high_high)
        if f.anticipated:
            ahead = tail(values[f.id], ahead_lag, f.anticipated)
        out[f.id] = (now, ahead, nulls[f.id])
    return out


def torque_reference(values, high, high_high):
    if np.isnan(values).sum() > 24:
        return None
    y = pd.Series(values).interpolate().to_numpy()
    mean = np.nanmean(y)
    if mean < high:
        return 0.0
    trend_sign = 0
    if not np.isnan(y).any():
        x = np.arange(120)
        slope, start = np.polyfit(x, y, 1)
        spread = math.sqrt(((y - start - slope * x) ** 2).sum() / 118 * (1 + 1 / 120 + (180 - 59.5) ** 2 / ((x - 59.5) ** 2).sum()))
        low, up = (start + 180 * slope + sign * 1.9802722 * spread for sign in (-1, 1))
        trend_sign = 1 if low >= mean else -1 if up <= mean else 0
    if mean < high_high:
        return float(trend_sign == 1)
    return 1.0 if trend_sign == -1 else 2.0


def same(x, y):
    if x is None or y is None or (isinstance(y, float) and math.isnan(y)):
        return x is None and (y is None or math.isnan(y))
    return x == pytest.approx(y, rel=1e-9)


def test_all_features_match_pandas(make_events, anchor, history_rows):
    expected = pandas_reference(history_rows)
    got = {r["feature_id"]: r for r in compute_features(make_events(history_rows), anchor, CFG).collect()}
    assert set(got) == set(expected)
    for i, (now, ahead, share) in expected.items():
        assert same(got[i]["current"], now), (i, "current", got[i]["current"], now)
        assert same(got[i]["anticipated"], ahead), (i, "anticipated", got[i]["anticipated"], ahead)
        assert got[i]["null_share"] == pytest.approx(share)
        limit = next(f.null_threshold for f in FEATURES if f.id == i)
        assert got[i]["too_many_nulls"] == (share > limit)


def test_features_do_not_look_past_their_anchor(spark, make_events, history_rows):
    """The same anchor gives the same features whether or not later events are known."""
    from datetime import timedelta

    early = spark.createDataFrame([(1, T0 - timedelta(minutes=25))], "site_id int, anchor_ts timestamp")
    shifted = [(k, up, tags) for k, up, tags in history_rows]
    known = make_events(shifted)
    past = known.where(F.col("ts") <= F.lit(minute(25)))
    cfg = CFG.subset(FEATURES)
    assert sorted(compute_features(known, early, cfg).collect()) == sorted(compute_features(past, early, cfg).collect())


def test_many_anchors_equal_each_anchor_alone(spark, make_events, history_rows):
    from datetime import timedelta

    instants = [(1, T0), (1, T0 - timedelta(minutes=7)), (1, T0 - timedelta(minutes=31))]
    events = make_events(history_rows)
    together = compute_features(events, spark.createDataFrame(instants, "site_id int, anchor_ts timestamp"), CFG)
    alone = [compute_features(events, spark.createDataFrame([i], "site_id int, anchor_ts timestamp"), CFG).collect() for i in instants]
    key = lambda r: (r["anchor_ts"], r["feature_id"])
    assert sorted(together.collect(), key=key) == sorted(sum(alone, []), key=key)


@pytest.mark.parametrize("shape", ["flat", "rising", "falling", "noise", "gaps", "late start", "sparse", "low"])
def test_trend_level_matches_numpy(spark, shape):
    x = np.arange(120)
    base = {
        "flat": np.full(120, 17.0), "rising": 10 + x * 0.2 + RNG.normal(0, 0.5, 120), "falling": 40 - x * 0.2 + RNG.normal(0, 0.5, 120),
        "noise": 18 + RNG.normal(0, 3, 120), "gaps": 10 + x * 0.15 + RNG.normal(0, 0.5, 120), "late start": 10 + x * 0.15,
        "sparse": 18 + x * 0.0, "low": 3 + x * 0.05,
    }[shape].copy()
    if shape == "gaps":
        base[[5, 6, 7, 40, 119]] = np.nan
    if shape == "late start":
        base[:10] = np.nan
    if shape == "sparse":
        base[::4] = np.nan
    rows = [(int(i), None if np.isnan(v) else float(v)) for i, v in enumerate(base)]
    points = spark.createDataFrame([(1, *r) for r in rows], "k int, x int, v double")
    # a constant series' interval is its mean, and reaching the mean counts as rising
    expected = 1.0 if shape == "flat" else torque_reference(base, 15, 20)
    assert trend.trend_levels(points, ["k"], "x", "v", trend.TrendLimits()).first()["level"] == expected
    # the same from three stretches that are merged
    whole = trend.part_of_points(points, ["k"], "x", "v").select(F.struct(*trend.PART).alias("p")).first()["p"]
    stretches = trend.part_of_points(points.withColumn("k", F.expr("x div 41")), ["k"], "x", "v")
    merged = stretches.agg(F.collect_list(F.struct(*trend.PART)).alias("ps")).select(trend.merged_part("ps").alias("p"))
    again = merged.select(trend.part_level("p", trend.TrendLimits()).alias("level"), "p").first()
    assert again["level"] == expected
    assert [again["p"][c] for c in trend.PART] == pytest.approx([whole[c] for c in trend.PART], rel=1e-9, abs=1e-6)


def test_low_pass_leaves_discrete_tags_and_needs_seven_values(spark):
    rows = [(1, T0, minute(k), tag, float(k % 2 if tag == "d" else k)) for k in range(20) for tag in ("n", "d")]
    series = spark.createDataFrame(rows, "site_id int, anchor_ts timestamp, ts timestamp, tag_id string, value double")
    series = series.where(~((F.col("tag_id") == "n") & (F.col("ts") <= F.lit(minute(8)))) | (F.col("ts") == F.lit(minute(19))))
    from millrace.functions.times import Grid

    smooth = signals.low_pass(series, ["site_id", "anchor_ts", "tag_id"], F.col("tag_id") == "n", Grid(60))
    values = {(r["tag_id"], r["ts"].replace(tzinfo=None)): r["value"] for r in smooth.collect()}
    assert values["d", minute(3).replace(tzinfo=None)] == 1.0
    assert values["n", minute(0).replace(tzinfo=None)] == 3.5
    assert values["n", minute(19).replace(tzinfo=None)] is None


def test_stopped_equipment_is_masked(make_events):
    events = make_events([
        (0, 1, {"run": 0.0, "x": 5.0, "y": 6.0, "z": 7.0}),
        (1, 1, {"run": 1.0, "x": 5.0, "z": 7.0}),
        (2, 1, {"x": 5.0, "z": 7.0}),
    ])
    masked = optimal.mask_stopped_equipment(events, {"x": ("run",), "y": ("run",)})
    got = {r["ts"]: {x["id"]: x["value"] for x in r["records"]} for r in masked.collect()}
    by_age = [got[t] for t in sorted(got, reverse=True)]
    assert by_age == [{"run": 0.0, "x": None, "y": None, "z": 7.0}, {"run": 1.0, "x": 5.0, "z": 7.0}, {"x": None, "z": 7.0}]
    assert optimal.mask_stopped_equipment(events, {}).collect() == events.collect()


def test_optimal_state_boundaries(make_events):
    events = make_events([(0, 9, {"f": 600.0, "c": 1.0, "x": 2.0}), (1, 9, {"f": 600.1, "x": 2.0}), (2, 9, {"f": None, "x": 2.0}), (3, 9, {"x": 2.0})])
    rows = optimal.optimal_state(events, "f", 600.0, ["c"]).orderBy(F.desc("ts")).collect()
    assert [r["plant_up"] for r in rows] == [0, 1, 0, 1]
    assert {x["id"]: x["value"] for x in rows[0]["records"]} == {"f": None, "c": 1.0, "x": None}
    assert {x["id"]: x["value"] for x in rows[3]["records"]} == {"x": 2.0}


def test_small_functions(spark):
    one = spark.range(1)
    pick = lambda c: one.select(c.alias("c")).first()[0]
    lit = F.lit
    assert pick(scalar.normalise_text(lit("  AbC\t "))) == "abc\t"
    assert pick(scalar.split_list(lit("a, b,"))) == ["a", " b", ""]
    assert pick(scalar.strip_spaces(lit(" 1 2"))) == "12"
    assert [pick(scalar.at_least_flag(lit(v).cast("double"), scalar.whole_threshold(lit("5.9")))) for v in (4.9, 5.0, None)] == [0, 1, 0]
    assert pick(scalar.whole_threshold(lit("high"))) is None
    assert pick(scalar.null_if_nan(lit(float("nan")))) is None
    nulls = F.array(lit(None).cast("double"), lit(None).cast("double"))
    assert pick(scalar.impute_list_when_up(nulls, lit(1), lit(0.0))) == [0.0, 0.0]
    assert pick(scalar.impute_list_when_up(nulls, lit(0), lit(0.0))) == [None, None]
    assert pick(scalar.list_mean(nulls)) is None and pick(scalar.list_max(nulls)) is None
    assert pick(scalar.ratio_or_null(lit(1.0), lit(0.0))) is None
    assert pick(scalar.mass_rate(lit(None).cast("double"), lit(2.0), lit(3.0), lit(4.0))) == 12.0


def test_null_report_severity(spark):
    rows = [("quarter", None if k < 30 else 1.0) for k in range(121)] + [("most", None if k < 90 else 1.0) for k in range(121)]
    series = spark.createDataFrame(rows, "feature string, value double")
    report = quality.null_share_report(series, ["feature"], F.lit(0.6)).collect()
    assert [(r["feature"], r["severity"]) for r in report] == [("most", "error")]
    assert quality.null_share_report(series, ["feature"], F.lit(0.6), gate_run=True).first()["severity"] == "info"


def test_feature_parity(spark):
    left, right = (spark.createDataFrame([(i,) for i in ids], "feature_id int") for ids in ((1, 2, 3), (2, 3, 4)))
    quality.require_parity(left, left)
    with pytest.raises(quality.FeatureMismatch, match="Features mismatch between currentFeatureRecords and anticipatedFeatureRecords"):
        quality.require_parity(left, right)


def test_operands_of_mass_rates_come_from_the_custom_input():
    assert fo.operands(FEATURES[5]) == ("a", "b", "d", "a")
    assert history.PLANT_SERIES == ["plantup_time", "plantup_switch", "plantup_minutes"]


def test_interpolation_sorts_once_in_fine_partitions(spark):
    rows = [("a", 1, None), ("a", 2, 4.0), ("a", 3, None), ("a", 5, 10.0), ("a", 6, None), ("b", 1, None), ("b", None, 7.0), (None, 1, 1.0), (None, 2, None)]
    filled = signals.interpolate(spark.createDataFrame(rows, "k string, x int, y double"), ["k"], "x", "y")
    plan = filled._jdf.queryExecution().executedPlan().toString()
    got = sorted((tuple(r) for r in filled.collect()), key=str)
    assert got == sorted([("a", 1, None), ("a", 2, 4.0), ("a", 3, 6.0), ("a", 5, 10.0), ("a", 6, 10.0), ("b", 1, 7.0), ("b", None, 7.0), (None, 1, 1.0), (None, 2, 1.0)], key=str)
    assert plan.count(" Sort [") == 1 and plan.count("Exchange hashpartitioning") == 1, plan
    assert filled.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))

"""Trigger gate: which anchors deserve an output, and whether it should be stored."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.history import ANCHOR


@dataclass(frozen=True)
class GateRules:
    """Ages of the last change event (seconds) and the moisture gap that decide the gate.

    A change younger than ``quiet_seconds`` stops the run; one younger than ``settle_seconds`` triggers it.
    """

    quiet_seconds: float = 2 * 3600
    settle_seconds: float = 4 * 3600
    moisture_gap: float = 0.3


@dataclass(frozen=True)
class GateFeatures:
    """Ids of the current features the gate reads."""

    plantup_time: int
    plantup_switch: int
    moisture: int
    moisture_target: int


def gate_inputs(features: DataFrame, ids: GateFeatures) -> DataFrame:
    """One row per anchor with the gate's current features as columns."""
    def pick(feature: int, name: str):
        return F.max(F.when(F.col("feature_id") == feature, F.col("current"))).alias(name)

    return features.groupBy(*ANCHOR).agg(
        pick(ids.plantup_time, "plantup_time"),
        pick(ids.plantup_switch, "plantup_switch"),
        pick(ids.moisture, "moisture"),
        pick(ids.moisture_target, "moisture_target"),
    )


def trigger_gate(inputs: DataFrame, last_change: DataFrame, rules: GateRules = GateRules()) -> DataFrame:
    """``(site_id, anchor_ts, trigger, flag)``.

    ``last_change(site_id, anchor_ts, change_ts)`` holds the newest change event at or before each anchor.
    Ages are taken against the anchor, not the wall clock, so a rerun decides the same.
    """
    age = (F.unix_micros("anchor_ts") - F.unix_micros("change_ts")) / 1e6
    up = F.coalesce(F.col("plantup_time") == 1, F.lit(False))
    # a change exactly at a cut point belongs to the older class
    quiet = F.coalesce(age < rules.quiet_seconds, F.lit(False))
    settling = F.coalesce(age < rules.settle_seconds, F.lit(False))
    switched = F.coalesce(F.col("plantup_switch") == 1, F.lit(False))
    gap = F.coalesce(F.abs(F.col("moisture") - F.col("moisture_target")) > rules.moisture_gap, F.lit(False))
    stopped = ~up | quiet
    return inputs.join(last_change, ANCHOR, "left").select(
        *ANCHOR,
        F.when(stopped, 0).otherwise(1).alias("trigger"),
        F.when(stopped, None).when(settling | switched | gap, True).otherwise(False).alias("flag"),
    )


def passed(gate: DataFrame) -> DataFrame:
    """Anchors the expensive stage still has to compute, with their flag."""
    return gate.where("trigger = 1").select(*ANCHOR, "flag")

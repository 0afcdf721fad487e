"""From events and anchors to features, gate and output events."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.config import StoreConfig
from millrace.operators.dedup import survivor_per_key
from millrace.operators.gate import GateFeatures, GateRules, gate_inputs, passed, trigger_gate
from millrace.operators.history import ANCHOR
from millrace.operators.joins import latest_before
from millrace.operators.optimal import mask_stopped_equipment, optimal_state
from millrace.operators.reshape import stack_rows
from millrace.operators.results import nested_results
from millrace.operators.shared import horizon_features
from millrace.plans.configs import require_rows
from millrace.session import cut_lineage


def corrected_events(events: DataFrame, cfg: StoreConfig) -> DataFrame:
    """Optimal state, then run status. Both look at one event only, so they run once per event and not
    once per anchor that reads it."""
    if cfg.optimal_tag is not None:
        events = optimal_state(events, cfg.optimal_tag, cfg.optimal_threshold, cfg.critical_tags)
    return mask_stopped_equipment(events, cfg.run_tags_of)


def unique_events(events: DataFrame, order: str = "sequenceID", keys: Sequence[str] = ("site_id", "ts")) -> DataFrame:
    """One event per site and instant; copies collapse before the shuffle."""
    return survivor_per_key(events, list(keys), F.col(order))


def compute_features(events: DataFrame, anchors: DataFrame, cfg: StoreConfig, is_corrected: bool = False) -> DataFrame:
    """Current and anticipated value of every configured feature at every anchor.

    ``events(site_id, ts, plant_up, records)`` must be unique per site and instant; ``anchors(site_id,
    anchor_ts)`` may be any number of instants, one per site being the live case. ``is_corrected``: events come from ``corrected_events``.
    """
    corrected = events if is_corrected else corrected_events(events, cfg)
    parts = []
    if cfg.short_features:
        parts.append(horizon_features(corrected, anchors, cfg, cfg.short_features, dense=True))
    if cfg.long_features:
        # rows of the long horizon carry no plant state, so nothing is imputed there
        parts.append(horizon_features(corrected, anchors, cfg, cfg.long_features, dense=False))
    return stack_rows(*parts)


def gate_anchors(events: DataFrame, changes: DataFrame, anchors: DataFrame, cfg: StoreConfig, ids: GateFeatures, rules: GateRules, is_corrected: bool = False) -> DataFrame:
    """Trigger and flag of every anchor, from the gate's features only."""
    features = compute_features(events, anchors, cfg.subset(cfg.gate_features), is_corrected)
    width = max(int(rules.settle_seconds * 1_000_000), 1)
    last = latest_before(changes, anchors, F.lit(True), "changed", width)
    last = last.select(*ANCHOR, F.col("found_ts").alias("change_ts"))
    return trigger_gate(gate_inputs(features, ids), last, rules)


def check_inputs(trigger: DataFrame, features_config: DataFrame, tags_config: DataFrame) -> None:
    """Reject a run without a trigger event or with an empty configuration."""
    require_rows(trigger, "Event input is empty")
    require_rows(features_config, "Features config is empty")
    require_rows(tags_config, "ETL configuration (tags config) is empty")


@dataclass
class RunOutput:
    gate: DataFrame
    features: DataFrame
    results: DataFrame


def run(
    events: DataFrame,
    changes: DataFrame,
    anchors: DataFrame,
    cfg: StoreConfig,
    ids: GateFeatures,
    rules: GateRules = GateRules(),
    materialise_gate: bool = False,
    gate_name: str | None = None,
    materialise_inputs: bool = False,
) -> RunOutput:
    """Gate first, then all features for the anchors that passed, then nested output events.

    ``materialise_gate`` writes the (small) gate table to the shared folder, so the feature stage starts
    from finished anchors and the gate's plan is not run again inside it; with ``gate_name`` into a folder of this name, which the
    next run overwrites. ``materialise_inputs`` does the same with corrected events and anchors: a dozen readers of both stages
    start from them, so where they are derived and not stored they would be derived as often.
    """
    if materialise_inputs:
        events, anchors = cut_lineage(corrected_events(events, cfg)), cut_lineage(anchors)
    gate = gate_anchors(events, changes, anchors, cfg, ids, rules, materialise_inputs)
    if materialise_gate:
        gate = cut_lineage(gate, gate_name)
    flags = passed(gate)
    features = compute_features(events, flags.select(*ANCHOR), cfg, materialise_inputs)
    conditions = [f.id for f in cfg.features if f.condition]
    return RunOutput(gate, features, nested_results(features, flags, conditions))

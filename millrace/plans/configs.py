"""Configuration tables: features, tags, run tags and the horizons they are needed on."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.config import Feature, StoreConfig, bounded_rows
from millrace.functions.scalar import normalise_text, split_list
from millrace.operators.features import AGGREGATIONS, FUNCTIONS
from millrace.operators.reshape import explode_structs, explode_structs_in_order, stack_rows
from millrace.schemas import MATCH_KEYS

#: Text columns of the features configuration that are compared in lower case.
FEATURE_TEXTS = [*MATCH_KEYS, "function", "currentTimeAggregation", "anticipatedTimeAggregation"]
#: Attributes of a feature that stay one per feature when its tags are collected.
FEATURE_KEYS = [
    "id", "function", "lag", "nullImpute", "nullThreshold", "currentTimeAggregation",
    "anticipatedTimeAggregation", "timeAggregationMinutes", "customInput",
]


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """The frame itself, or ``ValueError`` when it has no rows."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def normalise_features(config: DataFrame, list_column: str = "features") -> DataFrame:
    """One row per feature and equipment, compared texts in lower case without outer spaces."""
    rows = explode_structs(config, list_column)
    others = [c for c in rows.columns if c != "equipment"]
    per_equipment = rows.select(*others, F.posexplode_outer(split_list(F.col("equipment"))).alias("equipment_place", "equipment"))
    return per_equipment.withColumns({c: normalise_text(F.col(c)) for c in FEATURE_TEXTS})


def condition_features(features: DataFrame, is_condition: str) -> DataFrame:
    """Ids of the features that are (``"true"``) or are not (``"false"``) plant conditions."""
    return features.where(F.col("plantCondition") == is_condition).select("id").distinct()


def normalise_tags(config: DataFrame, present: DataFrame | None = None) -> DataFrame:
    """One row per tag of the doubly nested configuration, only tags that occur in the input.

    ``place`` orders the tags as the configuration lists them, within sites and sites among each other.
    """
    sites = explode_structs_in_order(config, "sites", "_site")
    tags = explode_structs_in_order(sites, "tags", "_tag").withColumn("place", F.struct("_site", "_tag")).drop("_site", "_tag")
    tags = tags.withColumns({c: normalise_text(F.col(c)) for c in MATCH_KEYS})
    if present is None:
        return tags
    return tags.join(present.select(F.col("tag_id").alias("enterpriseId")).distinct(), "enterpriseId", "left_semi")


def run_tag_pairs(tags: DataFrame, is_run_tag: Column, on: str = "equipment") -> DataFrame:
    """``(run_tag, tag_id)`` for every tag that shares its equipment with a run tag."""
    runs = tags.where(is_run_tag).select(on, F.col("enterpriseId").alias("run_tag"))
    others = tags.where(~is_run_tag).select(on, F.col("enterpriseId").alias("tag_id"))
    return others.join(runs, on).select("run_tag", "tag_id")


def feature_tags(features: DataFrame, tags: DataFrame, match: list[str] | None = None) -> DataFrame:
    """One row per feature and tag; ``place`` orders a feature's tags by its equipment, then as the tags are configured.

    ``tag_id`` is null for a feature without tags.
    """
    match = match or MATCH_KEYS
    named = tags.select(*match, F.col("enterpriseId").alias("tag_id"), F.col("place").alias("_place"))
    place = F.struct("equipment_place", "_place").alias("place")
    joined = features.join(named, match, "left").select(*FEATURE_KEYS, "tag_id", place)
    return joined.withColumn("customInput", split_list(F.col("customInput")))


def feature_tag_lists(pairs: DataFrame) -> DataFrame:
    """One row per feature with its tags as a list in configuration order (empty when it has none)."""
    listed = F.collect_list(F.when(F.col("tag_id").isNotNull(), F.struct("place", "tag_id")))
    return pairs.groupBy(*FEATURE_KEYS).agg(F.transform(F.array_sort(listed), lambda x: x["tag_id"]).alias("tags"))


@dataclass
class Scope:
    """The configuration rows one run needs."""

    features: DataFrame
    feature_tags: DataFrame
    tags: DataFrame
    run_tags: DataFrame


def scope_for(chosen: DataFrame, features: DataFrame, pairs: DataFrame, tags: DataFrame, runs: DataFrame) -> Scope:
    """Restrict the configuration to the chosen feature ids, their tags and those tags' run tags."""
    wanted = chosen.select("id").distinct()
    kept_pairs = pairs.join(wanted, "id", "left_semi")
    tag_ids = kept_pairs.select("tag_id").dropna().distinct()
    needed_runs = runs.join(tag_ids, "tag_id", "left_semi").select("run_tag").distinct()
    return Scope(
        features=features.join(wanted, "id", "left_semi"),
        feature_tags=kept_pairs,
        tags=tags.join(tag_ids.withColumnRenamed("tag_id", "enterpriseId"), "enterpriseId", "left_semi"),
        run_tags=runs.join(needed_runs, "run_tag", "left_semi"),
    )


def scope_columns(scope: Scope) -> DataFrame:
    """Every tag, run tag and feature id (as text) the scope reads."""
    names = (
        scope.feature_tags.select(F.col("tag_id").alias("name")).dropna(),
        scope.run_tags.select(F.col("run_tag").alias("name")),
        scope.feature_tags.select(F.col("id").cast("string").alias("name")),
    )
    return stack_rows(*names).distinct()


def split_horizon(pairs: DataFrame, long_minutes: int) -> tuple[DataFrame, DataFrame]:
    """Features aggregated over the long horizon, and all the others."""
    is_long = F.col("timeAggregationMinutes") == long_minutes
    return pairs.where(is_long), pairs.where(~F.coalesce(is_long, F.lit(False)))


def _require_known(features: DataFrame, column: str, known: frozenset) -> None:
    """Raise for a name that no function or aggregation has; nulls and empty texts mean none."""
    unknown = features.where(F.col(column).isNotNull() & (F.col(column) != "") & ~F.col(column).isin(*known))
    names = sorted(r[0] for r in unknown.select(column).distinct().limit(10).collect())
    if names:
        raise ValueError(f"unknown {column}: {', '.join(names)}")


def resolve(
    features: DataFrame,
    tags: DataFrame,
    runs: DataFrame,
    plant: dict,
    numeric_type: str = "numeric",
    critical: str = "Critical Run Status",
    **grid,
) -> StoreConfig:
    """Build a :class:`StoreConfig` from the configuration tables (``plant`` is the one-row plant config)."""
    if plant.get("optimal_tag") is not None and plant.get("optimal_threshold") is None:
        raise ValueError("the plant configuration names an optimal tag but no threshold for it")
    _require_known(features, "function", FUNCTIONS)
    for column in ("currentTimeAggregation", "anticipatedTimeAggregation"):
        _require_known(features, column, AGGREGATIONS)
    conditions = {r["id"] for r in bounded_rows(condition_features(features, "true"))}
    resolved = []
    for r in bounded_rows(feature_tag_lists(feature_tags(features, tags)).orderBy("id")):
        resolved.append(
            Feature(
                id=r["id"], tags=tuple(r["tags"]), function=r["function"], lag=r["lag"],
                null_impute=r["nullImpute"], null_threshold=r["nullThreshold"],
                current=r["currentTimeAggregation"], anticipated=r["anticipatedTimeAggregation"],
                steps=r["timeAggregationMinutes"], custom=tuple(r["customInput"] or ()),
                condition=r["id"] in conditions,
            )
        )
    skip = set(plant.get("skip_low_pass") or ())
    tag_rows = bounded_rows(tags.select("enterpriseId", "tagType", "criticality").distinct())
    # the three plant conditions read the constant series of the same name
    slots = {plant.get(name): name for name in ("plantup_time", "plantup_switch", "plantup_minutes")}
    resolved = [
        replace(f, tags=(slots[f.id],)) if f.id in slots else f for f in resolved
    ]
    grouped_runs = runs.groupBy("tag_id").agg(F.array_sort(F.collect_set("run_tag")).alias("run_tags"))
    return StoreConfig(
        features=tuple(resolved),
        smoothed_tags=tuple(sorted(r[0] for r in tag_rows if r[1] == numeric_type and r[0] not in skip)),
        run_tags_of={r["tag_id"]: tuple(r["run_tags"]) for r in bounded_rows(grouped_runs)},
        critical_tags=tuple(sorted(r[0] for r in tag_rows if r[2] == critical)),
        optimal_tag=plant.get("optimal_tag"),
        optimal_threshold=plant.get("optimal_threshold"),
        moisture_target=plant.get("moisture_target"),
        trigger_features=tuple(plant.get("trigger_features") or ()),
        **grid,
    )

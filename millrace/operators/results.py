"""Nested output events from feature rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.times import format_event_time
from millrace.operators.history import ANCHOR

EVENT_TYPE = "rtfsOutput"


def _records(value: str, keep: Column) -> Column:
    record = F.struct(F.col("feature_id").try_cast("smallint").alias("id"), F.col(value).alias("value"))
    return F.array_sort(F.collect_list(F.when(keep, record)))


def nested_results(features: DataFrame, flags: DataFrame, condition_ids: Sequence[int]) -> DataFrame:
    """One row per anchor: time, flag, event type, current and anticipated records, plant conditions.

    Conditions are taken from the current values and appear in neither of the other lists. Only anchors
    in ``flags(site_id, anchor_ts, flag)`` produce a row. ``too_many_nulls`` counts the features beyond their null limit.
    """
    is_condition = F.col("feature_id").isin(list(condition_ids))
    nested = features.groupBy(*ANCHOR).agg(
        _records("current", ~is_condition).alias("currentFeatureRecords"),
        _records("anticipated", ~is_condition).alias("anticipatedFeatureRecords"),
        _records("current", is_condition).alias("plantConditions"),
        F.sum(F.col("too_many_nulls").cast("bigint")).alias("too_many_nulls"),
    )
    return nested.join(flags, ANCHOR).select(
        *ANCHOR,
        format_event_time(F.col("anchor_ts")).alias("timestamp"),
        "flag",
        F.lit(EVENT_TYPE).alias("eventType"),
        "currentFeatureRecords",
        "anticipatedFeatureRecords",
        "plantConditions",
        "too_many_nulls",
    )


#: The attributes of an output event, in order.
ATTRIBUTES = ["timestamp", "flag", "eventType", "currentFeatureRecords", "anticipatedFeatureRecords", "plantConditions"]
RECORDS = "array<struct<id:smallint,value:double>>"


def result_json(nested: DataFrame, with_site: bool = False) -> DataFrame:
    """The six output attributes as one JSON text per anchor; null values are written as ``null``.

    ``with_site`` puts the site before them, for lines of several sites in one file.
    """
    body = F.struct(*(["site_id"] if with_site else []), *ATTRIBUTES)
    return nested.select(*ANCHOR, F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def read_result_text(spark: SparkSession, path: str) -> DataFrame:
    """Output events from files of lines that ``result_json`` made with their site; a folder without a line gives none."""
    kinds = f"site_id int, timestamp string, flag boolean, eventType string, currentFeatureRecords {RECORDS}, anticipatedFeatureRecords {RECORDS}, plantConditions {RECORDS}"
    lines = spark.read.schema("value string").text(path)
    return lines.select(F.from_json("value", kinds, {"mode": "FAILFAST"}).alias("event")).select("event.*")


def require_features(current: DataFrame | None, anticipated: DataFrame | None) -> None:
    """Reject missing or empty feature frames before formatting."""
    for name, frame in (("current", current), ("anticipated", anticipated)):
        if frame is None:
            raise ValueError(f"The {name} features is None")
        if frame.isEmpty():
            raise ValueError(f"The {name} features is empty")

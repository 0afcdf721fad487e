"""Row-local event corrections: nested records need no join and no shuffle to be masked."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.reshape import explode_structs, nest_records


def _literal_set(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def optimal_state(events: DataFrame, optimal_tag: str, threshold: float, critical_tags: Sequence[str]) -> DataFrame:
    """Mark the plant down where the optimal tag is at most the threshold (null counts as 0).

    There, readings of all but the critical tags become null; everywhere else ``plant_up`` is 1.
    """
    low = F.exists(
        "records", lambda r: (r["id"] == optimal_tag) & (F.coalesce(r["value"], F.lit(0.0)) <= threshold)
    )
    critical = _literal_set(critical_tags)
    cleared = F.transform(
        "records",
        lambda r: F.struct(
            r["id"].alias("id"), F.when(F.array_contains(critical, r["id"]), r["value"]).alias("value")
        ),
    )
    down = F.coalesce(low, F.lit(False))
    return events.withColumns(
        {
            "plant_up": F.when(down, 0).otherwise(1),
            "records": F.when(down, cleared).otherwise(F.col("records")),
        }
    )


def _all_on(run_tags: Column, running: Column) -> Column:
    return F.size(F.array_except(run_tags, running)) == 0


def mask_stopped_equipment(events: DataFrame, run_tags_of: Mapping[str, Sequence[str]]) -> DataFrame:
    """Keep a tag's reading only where all its run tags read 1; tags without a run tag are untouched.

    ``run_tags_of`` maps dependent tags to their run tags. A missing or null run reading masks too.
    """
    if not run_tags_of:
        return events
    owner = F.create_map(*[x for tag, runs in sorted(run_tags_of.items()) for x in (F.lit(tag), _literal_set(sorted(runs)))])
    running = F.transform(F.filter("records", lambda r: r["value"] == 1.0), lambda r: r["id"])

    def masked(r: Column) -> Column:
        run_tags = F.try_element_at(owner, r["id"])
        keep = run_tags.isNull() | _all_on(run_tags, F.col("_running"))
        return F.struct(r["id"].alias("id"), F.when(keep, r["value"]).alias("value"))

    return events.withColumn("_running", running).withColumn("records", F.transform("records", masked)).drop("_running")


def mask_stopped_equipment_long(telemetry: DataFrame, run_tags: DataFrame, keys: Sequence[str] = ("site_id", "ts")) -> DataFrame:
    """The same for long telemetry, with the mapping ``(tag_id, run_tag)``, a row for each pair, as a table of any size.

    Each instant's readings of run tags travel to its other rows in one nested row, so rows without a run
    tag never meet on a shared null key.
    """
    owned = run_tags.groupBy("tag_id").agg(F.collect_set("run_tag").alias("run_tags"))
    mapped = telemetry.join(owned, "tag_id", "left")
    item = F.struct(F.col("tag_id").alias("id"), F.col("value"), F.col("run_tags"))
    rows = mapped.groupBy(*keys).agg(F.collect_list(item).alias("records"))
    running = F.transform(F.filter("records", lambda r: r["value"] == 1.0), lambda r: r["id"])
    masked = F.transform(
        "records",
        lambda r: F.struct(
            r["id"].alias("tag_id"),
            F.when(r["run_tags"].isNull() | _all_on(r["run_tags"], F.col("_running")), r["value"]).alias("value"),
        ),
    )
    return explode_structs(rows.withColumn("_running", running).select(*keys, masked.alias("records")), "records")


def records_to_long(events: DataFrame, keys: Sequence[str] = ("site_id", "ts", "plant_up")) -> DataFrame:
    """Nested events to ``(keys..., tag_id, value)``."""
    long = explode_structs(events.select(*keys, "records"), "records")
    return long.withColumnsRenamed({"id": "tag_id"})


def long_to_events(telemetry: DataFrame, keys: Sequence[str] = ("site_id", "ts")) -> DataFrame:
    return nest_records(telemetry, keys)

"""History frames: one compact row per (site, anchor, instant), with all needed tags in one array.

Anchors are taken in blocks of time, and frames are hash-partitioned by ``(site_id, _block)`` once. An
event crosses the network once per block that can see it (twice on the short horizon), however many
anchors the block holds; it is multiplied by anchors only inside the task. Every later step -- gap
filling, plant conditions, smoothing, features, aggregation -- groups by ``GROUP`` and more, so Spark
needs no further shuffle. A group holds one anchor's slice (121 instants on the short horizon), never a site.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.times import Grid, whole_div
from millrace.operators.reshape import aligned_values, stack_rows

ANCHOR = ["site_id", "anchor_ts"]
#: Grouping of frames: an anchor together with the block it belongs to. Sorts compare the first column
#: cheaply, so the most selective one leads.
GROUP = ["anchor_ts", "site_id", "_block"]
#: Constant series each short frame provides besides the tags, in this order.
PLANT_SERIES = ["plantup_time", "plantup_switch", "plantup_minutes"]


def compact_events(events: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Events with only the needed tags, as one array of doubles in tag order."""
    return events.select("site_id", "ts", "plant_up", aligned_values(F.col("records"), tags).alias("cells"))


def sliced_rows(events: DataFrame, anchors: DataFrame, span_micros: int, width_micros: int) -> DataFrame:
    """Events within ``[anchor_ts - span, anchor_ts]`` once per anchor, plus one row without ``ts`` per anchor.

    Events no block can see are dropped before the shuffle. The shuffle has the session's number of
    partitions, given explicitly: data grows a hundredfold behind it where anchors are dense, and
    partitions merged by their size there would be too few and too large.
    """
    block = whole_div(F.unix_micros("anchor_ts"), width_micros)
    blocks = anchors.groupBy("site_id", block.alias("_block")).agg(F.collect_set("anchor_ts").alias("_anchors"))
    keys = blocks.select("site_id", "_block")
    micros = F.unix_micros("ts")
    seen_by = F.sequence(whole_div(micros, width_micros), whole_div(micros + F.lit(span_micros), width_micros))
    # an outer explode keeps Spark from filtering the source by this expression, which would stop the
    # horizons from sharing one shuffled copy of the events
    copies = events.withColumn("_block", F.explode_outer(seen_by)).join(keys, ["site_id", "_block"], "left_semi")
    count = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = stack_rows(copies, keys, missing=True).repartition(count, "site_id", "_block")
    ts = F.col("ts")

    def sees(anchor: Column) -> Column:
        back = F.unix_micros(anchor) - F.unix_micros(ts)
        return ts.isNull() | back.between(0, span_micros)

    carried = [c for c in events.columns if c != "site_id"]
    matched = merged.join(blocks, ["site_id", "_block"])
    return matched.select("site_id", "_block", F.explode(F.filter("_anchors", sees)).alias("anchor_ts"), *carried)


def fill_gaps(rows: DataFrame, steps: int) -> DataFrame:
    """Exactly the steps 0..``steps`` before each anchor; steps without a row get nulls.

    Each row also emits the missing steps that separate it from the previous one, and one marker row per
    anchor at ``steps + 1`` closes the far end. The grid is thus made after the shuffle.
    """
    by_back = Window.partitionBy(*GROUP).orderBy("back")
    previous = F.coalesce(F.lag("back").over(by_back), F.lit(-1))
    carried = [c for c in rows.columns if c not in (*GROUP, "back")]
    filled = rows.withColumn("_from", previous + 1).withColumn("step", F.explode(F.sequence("_from", "back")))
    return filled.where(F.col("step") <= steps).select(
        *GROUP,
        F.col("step").alias("back"),
        *[F.when(F.col("step") == F.col("back"), F.col(c)).alias(c) for c in carried],
    )


def dense_history(events: DataFrame, anchors: DataFrame, grid: Grid, steps: int) -> DataFrame:
    """The gap-free slice ``[anchor - steps, anchor]`` of compact events; a missing plant state counts as down.

    Rows that do not lie a whole number of steps before their anchor are dropped.
    """
    span = grid.span(steps)
    rows = sliced_rows(events, anchors, span, width_micros=span)
    micros = grid.back_micros(F.col("anchor_ts"), F.col("ts"))
    marker = F.col("ts").isNull()
    back = F.when(marker, steps + 1).otherwise(whole_div(micros, grid.step_micros))
    on_grid = rows.where(marker | (F.pmod(micros, F.lit(grid.step_micros)) == 0))
    dense = fill_gaps(on_grid.withColumn("back", back.cast("bigint")).drop("ts"), steps)
    return dense.withColumn("plant_up", F.coalesce("plant_up", F.lit(0)))


def _share_up(condition: Column, window) -> Column:
    return F.coalesce(F.avg(F.when(condition, F.col("plant_up"))).over(window), F.lit(0.0))


def plant_conditions(dense: DataFrame, hour: int, slice_steps: int, switch_steps: int, up: float, switch: float) -> DataFrame:
    """Add each anchor's uptime flag, switch flag and minutes up to all of its rows.

    The anchor's own row counts for none of them.
    """
    whole = Window.partitionBy(*GROUP)
    back = F.col("back")
    last_hour = back.between(1, hour)
    hour_before = back.between(hour + 1, 2 * hour)
    before_slice = back.between(slice_steps + 1, switch_steps)
    time_flag = (_share_up(last_hour, whole) > up) & (_share_up(hour_before, whole) > up)
    return dense.withColumns(
        {
            "plantup_time": F.when(time_flag, 1).otherwise(0),
            "plantup_switch": F.when(_share_up(before_slice, whole) < switch, 1).otherwise(0),
            "plantup_minutes": F.coalesce(F.sum(F.when(last_hour, F.col("plant_up"))).over(whole), F.lit(0)),
        }
    )


def short_frame(events: DataFrame, anchors: DataFrame, cfg) -> DataFrame:
    """Frame of the short horizon: the anchor's row and the slice before it, gap-free."""
    dense = dense_history(events, anchors, Grid(cfg.step_seconds), cfg.switch_steps)
    rows = plant_conditions(
        dense, cfg.hour_steps, cfg.slice_steps, cfg.switch_steps, cfg.up_share, cfg.switch_share
    ).where(F.col("back") <= cfg.slice_steps)
    constants = F.array(*[F.col(c).cast("double") for c in PLANT_SERIES])
    return rows.select(
        *GROUP,
        (F.unix_micros("anchor_ts") - F.col("back") * Grid(cfg.step_seconds).step_micros).alias("micros"),
        (F.col("back") + 1).alias("rank"),
        F.lit(None).cast("bigint").alias("tail_rows"),
        "plant_up",
        "cells",
        constants.alias("constants"),
    )


def long_frame(events: DataFrame, anchors: DataFrame, cfg) -> DataFrame:
    """Frame of the long horizon: the rows there are, newest first, not gap-filled.

    An anchor without any earlier row gets the empty short grid instead.
    """
    grid = Grid(cfg.step_seconds)
    # blocks as wide as the slice: an event is seen by two of them
    span = width = grid.span(cfg.long_slice_steps)
    merged = sliced_rows(events, anchors, span, width)
    whole = Window.partitionBy(*GROUP)
    earlier = F.count(F.when(F.col("ts") < F.col("anchor_ts"), 1)).over(whole)
    fallback = F.transform(
        F.sequence(F.lit(1), F.lit(cfg.slice_steps)), lambda k: grid.earlier(F.col("anchor_ts"), k)
    )
    own = F.array(F.col("ts"))
    instants = F.when(F.col("ts").isNotNull(), own).when(F.col("_earlier") == 0, fallback)
    rows = merged.withColumn("_earlier", earlier).withColumn("_at", F.explode(instants)).drop("ts")
    newest_first = Window.partitionBy(*GROUP).orderBy(F.desc("_at"))
    recent = grid.back_micros(F.col("anchor_ts"), F.col("_at")) < F.lit(grid.span(cfg.long_steps))
    return rows.select(
        *GROUP,
        F.unix_micros("_at").alias("micros"),
        F.row_number().over(newest_first).cast("bigint").alias("rank"),
        F.count(F.when(recent, 1)).over(whole).alias("tail_rows"),
        "plant_up",
        "cells",
        F.lit(None).cast("array<double>").alias("constants"),
    )


def history_warnings(dense: DataFrame, duplicates: DataFrame, anchors: DataFrame, hour: int, up: float) -> DataFrame:
    """Per anchor: surplus rows, missing steps, emptiness and the uptime shares that deserve a warning."""
    present = F.col("cells").isNotNull()
    back = F.col("back")
    per_anchor = dense.where(back > 0).groupBy(*GROUP).agg(
        F.count(F.when(~present, 1)).alias("missing_steps"),
        F.count(F.when(present, 1)).alias("present_steps"),
        F.coalesce(F.avg(F.when(back <= hour, F.col("plant_up"))), F.lit(0.0)).alias("up_last_hour"),
        F.coalesce(F.avg(F.when(back.between(hour + 1, 2 * hour), F.col("plant_up"))), F.lit(0.0)).alias("up_hour_before"),
    )
    surplus = duplicates.groupBy("site_id").agg(F.sum("surplus").alias("duplicate_rows"))
    return per_anchor.join(surplus, "site_id", "left").select(
        *ANCHOR,
        F.coalesce("duplicate_rows", F.lit(0)).alias("duplicate_rows"),
        "missing_steps",
        (F.col("present_steps") == 0).alias("no_history"),
        ((F.col("missing_steps") > 0) & (F.col("present_steps") > 0)).alias("has_gaps"),
        "up_last_hour",
        "up_hour_before",
        (F.col("up_last_hour") <= up).alias("low_last_hour"),
        (F.col("up_hour_before") <= up).alias("low_hour_before"),
    )

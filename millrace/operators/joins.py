"""Range and as-of joins between time series and as-of instants (anchors).

Both compare ``(site, time bucket)`` for equality, so they hash-join without a nested loop and a site with
very many rows is spread over its buckets. No side is hinted: Spark broadcasts anchors when their
measured size allows and otherwise shuffles, splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.times import whole_div
from millrace.operators.reshape import stack_rows


#: Buckets that one task orders at once when rows are carried forward.
RUN_BUCKETS = 256


def anchor_slice(
    series: DataFrame,
    anchors: DataFrame,
    span_micros: int,
    include_anchor: bool = True,
    width_micros: int | None = None,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``series(site_id, ts, ...)`` within ``[anchor_ts - span, anchor_ts]``, once per anchor.

    ``include_anchor=False`` gives the half-open slice. Buckets are a quarter of the span unless a width is
    given, which keeps candidate rows within a quarter of the true matches. ``carried`` names columns of the anchors to keep.
    """
    width = max(width_micros or span_micros // 4, 1)
    anchor_micros = F.unix_micros("anchor_ts")
    covered = F.sequence(whole_div(anchor_micros - F.lit(span_micros), width), whole_div(anchor_micros, width))
    spread = anchors.select("site_id", "anchor_ts", *carried, F.explode(covered).alias("_bucket"))
    bucketed = series.withColumn("_bucket", whole_div(F.unix_micros("ts"), width))
    back = F.unix_micros("anchor_ts") - F.unix_micros("ts")
    inside = (back >= 0 if include_anchor else back > 0) & (back <= F.lit(span_micros))
    return bucketed.join(spread, ["site_id", "_bucket"]).where(inside).drop("_bucket")


def latest_before(
    series: DataFrame, anchors: DataFrame, value: Column, value_name: str, width_micros: int
) -> DataFrame:
    """For each anchor the newest ``value`` at or before it, with its instant; null when there is none.

    No pairs of rows and anchors are made. A row meets one list, the anchors of its own time bucket, and
    is credited to the first of them not before it (or to the bucket's end). Per credited anchor only the
    newest row survives, partly before the shuffle; what remains is at most one row per anchor and
    bucket, along which the newest row is carried forward. A site's time is cut into runs of buckets, so
    its anchors spread over tasks; only one row per run passes a window of the whole site.
    """
    packed = F.struct(F.col("ts").alias("ts"), value.alias("v"))
    rows = series.select(
        "site_id", "ts", packed.alias("_row"), whole_div(F.unix_micros("ts"), width_micros).alias("_bucket")
    )
    marked = anchors.select(
        "site_id", "anchor_ts", whole_div(F.unix_micros("anchor_ts"), width_micros).alias("_bucket")
    ).distinct()
    lists = marked.groupBy("site_id", "_bucket").agg(F.array_sort(F.collect_list("anchor_ts")).alias("_anchors"))
    next_anchor = F.try_element_at(F.filter("_anchors", lambda a: a >= F.col("ts")), F.lit(1))
    credited = (
        rows.join(lists, ["site_id", "_bucket"], "left")
        .groupBy("site_id", "_bucket", next_anchor.alias("anchor_ts"))
        .agg(F.max_by("_row", "ts").alias("_row"))
    )
    steps = stack_rows(credited, marked, missing=True).groupBy("site_id", "_bucket", "anchor_ts").agg(
        F.first("_row", ignorenulls=True).alias("_row")
    )
    # carried forward within runs of buckets, and from run to run by one row for each of them
    steps = steps.withColumn("_run", whole_div(F.col("_bucket"), RUN_BUCKETS))
    in_run = Window.partitionBy("site_id", "_run").orderBy("_bucket", F.col("anchor_ts").asc_nulls_last())
    own = F.last("_row", ignorenulls=True).over(in_run.rowsBetween(Window.unboundedPreceding, 0))
    newest = steps.groupBy("site_id", "_run").agg(F.max("_row").alias("_newest"))
    runs_before = Window.partitionBy("site_id").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    before = newest.select("site_id", "_run", F.last("_newest", ignorenulls=True).over(runs_before).alias("_before"))
    carried = steps.withColumn("_own", own).where(F.col("anchor_ts").isNotNull()).join(before, ["site_id", "_run"])
    carried = carried.withColumn("_found", F.coalesce("_own", "_before"))
    return carried.select(
        "site_id", "anchor_ts", F.col("_found.ts").alias("found_ts"), F.col("_found.v").alias(value_name)
    )

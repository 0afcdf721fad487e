"""Signal operators on long series: smoothing, interpolation, regularising."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.functions.times import Grid, floor_div
from millrace.operators.reshape import stack_rows


def centred_median(value: Column, keys: Sequence[str], micros: str, width_micros: int, minimum: int) -> Column:
    """Median of the values within half a width either side, later edge included; null below ``minimum`` values.

    ``keys`` must name one bounded series, such as (site, anchor, tag).
    """
    half = width_micros // 2
    frame = Window.partitionBy(*keys).orderBy(micros).rangeBetween(-(half - 1), half)
    # sorting the frame's few values costs a quarter of the percentile aggregate
    return list_median(F.collect_list(value).over(frame), minimum)


def list_median(values: Column, minimum: int = 1) -> Column:
    """Median of a list's non-null values; null below ``minimum`` values."""
    count = F.size(values)
    ordered = F.sort_array(values)
    low, high = ((count - 1) / 2).cast("int"), (count / 2).cast("int")
    return F.when(count >= minimum, (F.get(ordered, low) + F.get(ordered, high)) / 2)


def low_pass(series: DataFrame, keys: Sequence[str], smoothed: Column, grid: Grid, steps: int = 15, minimum: int = 7) -> DataFrame:
    """Replace ``value`` by its centred median where ``smoothed`` holds; other rows stay as they are."""
    timed = series.withColumn("_micros", F.unix_micros("ts"))
    signal = F.when(smoothed, F.col("value"))
    median = centred_median(signal, keys, "_micros", grid.span(steps), minimum)
    return timed.withColumn("value", F.when(smoothed, median).otherwise(F.col("value"))).drop("_micros")


#: Partitions of a sort of whole series, in multiples of the session's number.
SORT_PARTS = 4


def interpolate(series: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Fill inner gaps of ``y`` linearly over ``x``; a leading gap stays null, a trailing one keeps the last value.

    Rows are sorted once, for both neighbours, and in finer partitions than the session's: a task holds what it sorts.
    """
    count = SORT_PARTS * int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = Window.partitionBy(*keys).orderBy(x)
    upto = in_order.rowsBetween(Window.unboundedPreceding, 0)
    known = series.withColumn("_x", F.when(F.col(y).isNotNull(), F.col(x))).repartition(count, *keys)
    left = {"_lx": F.last("_x", ignorenulls=True).over(upto), "_ly": F.last(y, ignorenulls=True).over(upto)}
    sided = known.withColumns(left | {"_rx": next_known("_x", in_order), "_ry": next_known(y, in_order)})
    slope = (F.col("_ry") - F.col("_ly")) / (F.col("_rx") - F.col("_lx"))
    filled = F.when(F.col(y).isNotNull(), F.col(y)).when(F.col("_ly").isNull(), None).when(F.col("_ry").isNull(), F.col("_ly")).otherwise(
        F.col("_ly") + slope * (F.col(x) - F.col("_lx"))
    )
    return sided.withColumn(y, filled).drop("_x", "_lx", "_ly", "_rx", "_ry")


def next_known(column: str, in_order: WindowSpec) -> Column:
    """The column's next value after the row that is not null. A frame to the end would be read anew for every row; this goes on."""
    return F.expr(f"lead(`{column}`) IGNORE NULLS").over(in_order)


#: Grid steps of one block when a series is put on the grid.
BLOCK_STEPS = 1440


def regularise(series: DataFrame, keys: Sequence[str], grid: Grid) -> DataFrame:
    """Mean per grid step, every step between a series' first and last one present.

    Steps are means first (partial sums before the shuffle). A series is cut into blocks of steps: a block knows from the blocks
    around it where it begins and ends, and gaps between blocks become blocks of their own. So neither a long series nor a
    long gap is ever in one task or in one row; only one row per block passes a window of the whole series.
    """
    step = F.lit(grid.step_micros)
    means = series.groupBy(*keys, floor_div(F.unix_micros("ts"), grid.step_micros).alias("_step")).agg(F.avg("value").alias("value"))
    blocks = means.groupBy(*keys, floor_div(F.col("_step"), BLOCK_STEPS).alias("_block")).agg(F.min("_step").alias("_low"), F.max("_step").alias("_high"))
    in_order = Window.partitionBy(*keys).orderBy("_block")
    placed = blocks.withColumns({"_before": F.lag("_block").over(in_order), "_after": F.lead("_block").over(in_order)})
    start, end = F.col("_block") * BLOCK_STEPS, F.col("_block") * BLOCK_STEPS + (BLOCK_STEPS - 1)
    own = placed.select(
        *keys, "_block", F.when(F.col("_before").isNull(), F.col("_low")).otherwise(start).alias("_from"),
        F.when(F.col("_after").isNull(), F.col("_high")).otherwise(end).alias("_to"),
    )
    gaps = placed.where(F.col("_before") < F.col("_block") - 1).select(*keys, F.explode(F.sequence(F.col("_before") + 1, F.col("_block") - 1)).alias("_block"))
    every = stack_rows(own, gaps.select(*keys, "_block", start.alias("_from"), end.alias("_to"))).repartition(*keys, "_block")
    steps = every.select(*keys, F.explode(F.sequence("_from", "_to")).alias("_step"))
    return steps.join(means, [*keys, "_step"], "left").select(*keys, F.timestamp_micros(F.col("_step") * step).alias("ts"), "value")


def shift_rows(series: DataFrame, keys: Sequence[str], order: str, lag: Column, lags: Sequence[int]) -> DataFrame:
    """Shift ``value`` by as many rows as the row's ``lag`` says (negative pulls from later rows).

    ``lags`` lists the few distinct lags in use; all of them share one window pass.
    """
    rows = Window.partitionBy(*keys).orderBy(order)
    shifted = F.col("value")
    for n in sorted(set(lags)):
        if n:
            shifted = F.when(lag == n, F.lag("value", n).over(rows)).otherwise(shifted)
    return series.withColumn("value", shifted)


def last_rows(series: DataFrame, keys: Sequence[str], order: str, count: int) -> DataFrame:
    """The newest ``count`` rows of every series."""
    newest = Window.partitionBy(*keys).orderBy(F.desc(order))
    return series.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= count).drop("_n")

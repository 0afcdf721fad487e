"""Trend level of a signal: where its next hour lies against its past, from a closed-form line fit.

The fit needs sums of y, x*y and y*y over the gap-filled series only. Between two present points the filled values lie on a line, so
their sums are closed forms of the two points; sums of neighbouring parts of a series add up, joined by the line between them. A
series is therefore never a list: parts are summed wherever they lie and merged (``merged_part``). Values are taken against a
reference of their part, so a constant series has moments of exactly zero.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The series is two hours of minutes, the prediction one hour past its end, and the
# two-sided 95% quantile of Student's t has 118 degrees of freedom.
TREND_POINTS = 120
TREND_TARGET = 180
T_QUANTILE = 1.9802722
MAX_MISSING_SHARE = 0.2

CENTRE = (TREND_POINTS - 1) / 2
SXX = TREND_POINTS * (TREND_POINTS**2 - 1) / 12
SPREAD = 1 + 1 / TREND_POINTS + (TREND_TARGET - CENTRE) ** 2 / SXX

#: Columns of a part: its first and last point, the reference of its values, its number of points and the sums over its filled values.
PART = ["fx", "fy", "lx", "ly", "ref", "points", "s0", "s1", "s2"]


@dataclass(frozen=True)
class TrendLimits:
    high: float = 15.0
    high_high: float = 20.0


def own_sums(x: Column, y: Column) -> tuple[Column, Column, Column]:
    """The sums a single point adds."""
    return y, x * y, y * y


def segment_sums(x1: Column, y1: Column, x2: Column, y2: Column) -> tuple[Column, Column, Column]:
    """Sums of y, x*y and y*y over the line from one point to the next, at whole steps; the first point excluded, the next included."""
    s, d = x2 - x1, y2 - y1
    return (
        s * y1 + d * (s + 1) / 2,
        s * x1 * y1 + x1 * d * (s + 1) / 2 + y1 * s * (s + 1) / 2 + d * (s + 1) * (2 * s + 1) / 6,
        s * y1 * y1 + y1 * d * (s + 1) + d * d * (s + 1) * (2 * s + 1) / (6 * s),
    )


def part_of_points(rows: DataFrame, keys: Sequence[str], x: str, value: str) -> DataFrame:
    """One part per key from its points; rows where either is null add nothing, and a key without points has no part."""
    held = rows.where(F.col(x).isNotNull() & F.col(value).isNotNull())
    in_order = Window.partitionBy(*keys).orderBy(x)
    pointed = held.select(*keys, F.col(x).cast("double").alias("x"), F.col(value).alias("v"), F.first(value).over(in_order).alias("ref"))
    in_order = Window.partitionBy(*keys).orderBy("x")
    pointed = pointed.withColumn("y", F.col("v") - F.col("ref"))
    pointed = pointed.withColumns({"px": F.lag("x").over(in_order), "py": F.lag("y").over(in_order)})
    alone = own_sums(F.col("x"), F.col("y"))
    joined = segment_sums(F.col("px"), F.col("py"), F.col("x"), F.col("y"))
    sums = [F.sum(F.when(F.col("px").isNull(), a).otherwise(j)).alias(f"s{i}") for i, (a, j) in enumerate(zip(alone, joined))]
    return pointed.groupBy(*keys).agg(
        F.min("x").alias("fx"), F.min_by("y", "x").alias("fy"), F.max("x").alias("lx"), F.max_by("y", "x").alias("ly"),
        F.max("ref").alias("ref"), F.count("*").alias("points"), *sums,
    )


def part_of_point(x: Column, value: Column) -> Column:
    """A single point as a part."""
    zero = F.lit(0.0)
    return part_struct({c: zero for c in PART} | {"fx": x.cast("double"), "lx": x.cast("double"), "ref": value, "points": F.lit(1).cast("bigint")})


def part_struct(columns: dict[str, Column]) -> Column:
    return F.struct(*[columns[c].alias(c) for c in PART])


def merged_part(parts: str) -> Column:
    """The part of a whole series from the column of an array of its few parts, which must not overlap; lines join neighbours.

    Written as SQL text, which reaches the session in one call.
    """
    shift, n = "(p.ref - a.ref)", "(p.lx - p.fx + 1)"
    fy = f"(p.fy + {shift})"
    s, d = "(p.fx - a.lx)", f"({fy} - a.ly)"
    # sums over the line from the last point to the next, as in ``segment_sums``, without that point: it is the part's own
    lines = (
        f"({s} * a.ly + {d} * ({s} + 1) / 2) - {fy}",
        f"({s} * a.lx * a.ly + a.lx * {d} * ({s} + 1) / 2 + a.ly * {s} * ({s} + 1) / 2 + {d} * ({s} + 1) * (2 * {s} + 1) / 6) - p.fx * {fy}",
        f"({s} * a.ly * a.ly + a.ly * {d} * ({s} + 1) + {d} * {d} * ({s} + 1) * (2 * {s} + 1) / (6 * {s})) - {fy} * {fy}",
    )
    moved = (
        f"p.s0 + {n} * {shift}", f"p.s1 + {shift} * {n} * (p.fx + p.lx) / 2", f"p.s2 + 2 * {shift} * p.s0 + {n} * {shift} * {shift}"
    )
    sums = ", ".join(f"'s{i}', a.s{i} + {lines[i]} + {moved[i]}" for i in range(3))
    joined = f"named_struct('fx', a.fx, 'fy', a.fy, 'lx', p.lx, 'ly', p.ly + {shift}, 'ref', a.ref, 'points', a.points + p.points, {sums})"
    ordered = f"array_sort({parts})"
    return F.expr(f"aggregate(slice({ordered}, 2, greatest(size({parts}), 1)), get({ordered}, 0), (a, p) -> {joined})")


def part_level(part: str, limits: TrendLimits) -> Column:
    """Level of a series given the column of its part over x = 0..119; null without one.

    More than a fifth missing gives null. Below ``high`` the level is 0. Between the limits it is 1 when
    the whole prediction interval lies above the mean, else 0. From ``high_high`` on it is 2, or 1 when
    the interval lies below the mean. A series with a leading gap has no trend.
    """
    last, y = f"{part}.lx", f"{part}.ly"
    rest = f"({TREND_POINTS - 1}D - {last})"
    # the end of the series is kept at its last value
    s0 = f"({part}.s0 + {rest} * {y})"
    s1 = f"({part}.s1 + {y} * {rest} * ({last} + {TREND_POINTS}D) / 2)"
    s2 = f"({part}.s2 + {rest} * {y} * {y})"
    n = f"({TREND_POINTS}D - {part}.fx)"
    mean = f"({s0} / {n})"
    sxy = f"({s1} - {CENTRE}D * {s0})"
    residual = f"(greatest({s2} - {n} * {mean} * {mean} - {sxy} * {sxy} / {SXX}D, 0D) / {TREND_POINTS - 2}D)"
    predicted, half = f"({mean} + {TREND_TARGET - CENTRE}D * {sxy} / {SXX}D)", f"({T_QUANTILE}D * sqrt({residual} * {SPREAD}D))"
    rising = f"({part}.fx = 0 AND {predicted} - {half} >= {mean})"
    falling = f"({part}.fx = 0 AND {predicted} + {half} <= {mean} AND NOT {rising})"
    m = f"({part}.ref + {mean})"
    level = (
        f"CASE WHEN {m} < {float(limits.high)}D THEN 0 WHEN {m} < {float(limits.high_high)}D THEN CASE WHEN {rising} THEN 1 ELSE 0 END "
        f"WHEN {falling} THEN 1 ELSE 2 END"
    )
    return F.expr(f"CAST(CASE WHEN {part}.points >= {TREND_POINTS * (1 - MAX_MISSING_SHARE)}D THEN {level} END AS DOUBLE)")


def trend_levels(rows: DataFrame, keys: Sequence[str], x: str, value: str, limits: TrendLimits) -> DataFrame:
    """``(keys..., level)`` of every series that has a point."""
    found = part_of_points(rows, keys, x, value).select(*keys, F.struct(*PART).alias("_part"))
    return found.select(*keys, part_level("_part", limits).alias("level"))

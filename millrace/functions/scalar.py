"""Column expressions for text, flags, missing values and lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_text(col: Column) -> Column:
    """Lower case without leading and trailing spaces (spaces only, tabs stay)."""
    return F.trim(F.lower(col))


def split_list(col: Column) -> Column:
    """Comma text to a list of texts; null stays null."""
    return F.split(col, ",")


def strip_spaces(col: Column) -> Column:
    return F.replace(col, F.lit(" "), F.lit(""))


def null_if_nan(col: Column) -> Column:
    """Missing is null everywhere: Spark aggregates would treat NaN as a value."""
    return F.nanvl(col, F.lit(None).cast("double"))


def whole_threshold(col: Column) -> Column:
    """A threshold given as text, cut to its whole part; unreadable text gives null."""
    return F.trim(col).try_cast("double").cast("bigint")


def at_least_flag(col: Column, threshold: Column) -> Column:
    """1 where the value reaches the whole threshold, otherwise (also for null) 0."""
    return F.when(col >= threshold, 1).otherwise(0)


def mass_rate(flow_a: Column, density_a: Column, flow_b: Column, density_b: Column) -> Column:
    """First line's flow times density, or the second line's where the first is missing."""
    return F.coalesce(flow_a * density_a, flow_b * density_b)


def impute_when_up(col: Column, plant_up: Column, constant: Column) -> Column:
    """Fill nulls with the constant while the plant runs; a null constant leaves them."""
    return F.when(plant_up == 1, F.coalesce(col, constant)).otherwise(col)


def impute_list_when_up(col: Column, plant_up: Column, constant: Column) -> Column:
    """The same for every element of a list."""
    return F.when(plant_up == 1, F.transform(col, lambda x: F.coalesce(x, constant))).otherwise(col)


def list_mean(col: Column) -> Column:
    """Mean of a list's non-null elements; null when there are none."""
    held = F.filter(col, lambda x: x.isNotNull())
    total = F.aggregate(held, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(held) > 0, total / F.size(held))


def list_max(col: Column) -> Column:
    """Largest non-null element; null when there is none."""
    return F.array_max(col)


def list_item(col: Column, position: int) -> Column:
    """Element at a zero-based position; null beyond the end."""
    return F.get(col, F.lit(position))


def ordered_list(position: Column, value: Column) -> Column:
    """Aggregate to a list in position order that keeps null values (plain collection drops them)."""
    return F.transform(
        F.array_sort(F.collect_list(F.struct(position.alias("p"), value.alias("v")))), lambda x: x["v"]
    )


def ratio_or_null(numerator: Column, denominator: Column) -> Column:
    """Quotient; null where the denominator is 0 or missing."""
    return numerator / F.nullif(denominator, F.lit(0.0))

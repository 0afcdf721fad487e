"""Nested to long, long to wide and back, and column naming."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_structs(df: DataFrame, list_column: str) -> DataFrame:
    """One row per list element with the element's fields as columns; empty and null lists keep a row."""
    kept = [c for c in df.columns if c != list_column]
    return df.select(*kept, F.explode_outer(list_column).alias("_item")).select(*kept, "_item.*")


def explode_structs_in_order(df: DataFrame, list_column: str, position: str) -> DataFrame:
    """The same, with the element's place in its list (from 0; null for a row kept without one)."""
    kept = [c for c in df.columns if c != list_column]
    rows = df.select(*kept, F.posexplode_outer(list_column).alias(position, "_item"))
    return rows.select(*kept, position, "_item.*")


def nest_records(df: DataFrame, keys: Sequence[str], ident: str = "tag_id", value: str = "value") -> DataFrame:
    """One row per key with its readings as a list of ``{id, value}`` in id order."""
    record = F.struct(F.col(ident).alias("id"), F.col(value).alias("value"))
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(record)).alias("records"))


def pivot_tags(df: DataFrame, index: Sequence[str], tags: Sequence[str]) -> DataFrame:
    """Wide frame with one column per listed tag; the list keeps the schema fixed and saves a pass."""
    return df.groupBy(*index).pivot("tag_id", list(tags)).agg(F.first("value", ignorenulls=True))


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "id", value: str = "value") -> DataFrame:
    """Wide to long: one row per value column, nulls included."""
    return df.unpivot(list(ids), list(values), name, value)


def prefix_columns(df: DataFrame, columns: Iterable[str], prefix: str) -> DataFrame:
    """Rename the listed columns to ``PREFIX_column``; columns that are absent are ignored."""
    return df.withColumnsRenamed({c: f"{prefix}_{c}" for c in columns})


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def sorted_columns(df: DataFrame) -> DataFrame:
    """Columns in name order."""
    return df.select(*sorted(df.columns))


def keep_present(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def stack_rows(*frames: DataFrame, missing: bool = False) -> DataFrame:
    """Vertical concatenation by column name; ``missing`` fills absent columns with null.

    Spark 4.1 may take a union of equally partitioned inputs for partitioned itself although adaptive execution has changed an
    input, and then fails or skips a needed shuffle. ``session.use_utc`` and ``session.build_session`` switch that reading off;
    a session set up otherwise needs ``spark.sql.unionOutputPartitioning`` to be false.
    """
    first, *rest = frames
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=missing)
    return first


def aligned_values(records: Column, tags: Sequence[str]) -> Column:
    """Readings of the listed tags, in list order, as a compact array; tags without a reading are null.

    Of several readings of one tag the last counts (``repeated_readings`` reports them).
    """
    named = F.filter(records, lambda r: r["id"].isNotNull())
    ids = F.transform(named, lambda r: r["id"])
    last_only = F.filter(named, lambda r, i: ~F.exists(F.slice(named, i + 2, F.size(named)), lambda later: later["id"] == r["id"]))
    lookup = F.map_from_entries(F.when(F.size(F.array_distinct(ids)) < F.size(ids), last_only).otherwise(named))
    # one lookup per tag: inside a lambda the column would be invisible to the optimizer's constraints
    return F.array(*[F.try_element_at(lookup, F.lit(t)) for t in tags]).cast("array<double>")


def repeated_readings(events: DataFrame, keys: Sequence[str] = ("site_id", "ts")) -> DataFrame:
    """Tags that one event holds more than once: ``(keys..., tag_id, surplus)``."""
    long = events.select(*keys, F.explode("records").alias("_item")).select(*keys, F.col("_item.id").alias("tag_id"))
    return long.groupBy(*keys, "tag_id").agg((F.count("*") - 1).alias("surplus")).where("surplus > 0")

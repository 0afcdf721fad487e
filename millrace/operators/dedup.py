"""Duplicates, newest rows and live/historical unions.

Survivors are chosen by aggregation, not by a sorted window: copies collapse before the shuffle, so a
key with very many copies costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.reshape import stack_rows


def survivor_per_key(df: DataFrame, keys: Sequence[str], prefer: Column) -> DataFrame:
    """One row per key, the one with the greatest ``prefer``.

    A null ``prefer`` is below every other, so a key whose rows all lack it keeps one of them; rows with equal ``prefer`` are told
    apart by a hash of their other columns, so the result does not depend on their order.
    """
    rest = [c for c in df.columns if c not in keys]
    packed = F.max_by(F.struct(*rest), F.struct(prefer.alias("prefer"), F.xxhash64(*rest).alias("tie"))).alias("_row")
    return df.groupBy(*keys).agg(packed).select(*keys, "_row.*")


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of surplus rows."""
    return df.groupBy(*keys).agg((F.count("*") - 1).alias("surplus")).where("surplus > 0")


def newest_and_rest(events: DataFrame, site: str = "site_id", ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Per site the newest event, and all the others as its history.

    The newest instant per site comes from an aggregation; joining it back needs no per-site sort, so one
    site may hold most of the rows.
    """
    newest = events.groupBy(site).agg(F.max(ts).alias("_newest"))
    joined = events.join(newest, site)
    columns = events.columns
    return (
        joined.where(F.col(ts) == F.col("_newest")).select(*columns),
        joined.where(F.col(ts) < F.col("_newest")).select(*columns),
    )


def live_and_historical(live: DataFrame, historical: DataFrame, drop: Sequence[str] = ()) -> DataFrame:
    """Union by name, without surrogate ids, each distinct row once."""
    return stack_rows(live, historical, missing=True).drop(*drop).distinct()

"""Writing results and date-partitioned tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.dedup import survivor_per_key
from millrace.operators.reshape import stack_rows
from millrace.session import cut_lineage
from millrace.sources import folders


def write_result_text(results: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON text per line."""
    results.select("value").write.mode(mode).text(path)


def publish_results(results: DataFrame, fmt: str = "text", **options: str) -> None:
    """Send result texts to a sink: a folder by default, a message broker with its format and options."""
    writer = results.select("value").write.format(fmt).options(**options)
    writer.mode("append").save()


def merge_dates(df: DataFrame, path: str, keys: Sequence[str], partition: str = "field_date") -> list:
    """Merge rows by key into a table of date folders: known keys are replaced, wherever their old row lies, new ones added.

    Only the dates that hold an old or a new row of an incoming key are read and rewritten; their dates are returned. Of several
    incoming rows of a key the one with the latest date counts, ties by a hash of the row. Null keys match null keys.
    """
    spark = df.sparkSession
    incoming = cut_lineage(survivor_per_key(df, list(keys), F.col(partition)).select(*df.columns))
    target = spark.read.schema(df.schema).parquet(path) if folders.exists(spark, path) else spark.createDataFrame([], df.schema)
    named = [F.col(k).alias(f"_{k}") for k in keys]

    def same_key(rows: DataFrame) -> Column:
        pairs = [rows[k].eqNullSafe(F.col(f"_{k}")) for k in keys]
        return reduce(lambda a, b: a & b, pairs)

    old = target.select(*keys, partition)
    replaced = old.join(incoming.select(*named), same_key(old), "left_semi").select(partition)
    # as many rows as there are dates
    touched = sorted(r[0] for r in stack_rows(replaced, incoming.select(partition)).distinct().dropna().collect())
    there = target.where(F.col(partition).isin(touched) if touched else F.lit(False))
    stays = there.join(incoming.select(*named), same_key(there), "left_anti").select(*df.columns)
    # the dates are read before they are overwritten
    merged = cut_lineage(stack_rows(stays, incoming))
    overwrite_dates(merged, path, partition)
    left = {r[0] for r in merged.select(partition).distinct().collect()}
    for date in touched:
        if date not in left:
            folders.delete(spark, f"{path}/{partition}={date}")
    return touched


def overwrite_dates(df: DataFrame, path: str, partition: str = "field_date") -> None:
    """Replace only the date folders present in ``df``.

    Rows are gathered by date, and only dates of more than a partition's size are written by several tasks.
    """
    (
        df.hint("rebalance", F.col(partition))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )

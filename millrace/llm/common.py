"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps see one fixed copy and never recompute it."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def text_tie(text: Column) -> Column:
    """60 bits of the text's MD5 as a number that SQL engines agree on; -1 for null."""
    return F.coalesce(F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(-1).cast("long"))


def packed(docs: DataFrame) -> Column:
    """The whole row as one struct, so that its column names cannot clash with an operator's own."""
    return F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns])


def unpacked(df: DataFrame, row: str, columns: Iterable[str]) -> DataFrame:
    return df.select(*[F.col(row).getField(c).alias(c) for c in columns])


def offsets_before(totals: DataFrame, part: str, measures: list[str]) -> DataFrame:
    """Per partition number: ``<measure>_before``, summed over all lower numbers, and ``<measure>_all``, over all of them.

    ``totals`` has one row for each partition, so one task can order them.
    """
    below = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = [F.coalesce(F.sum(m).over(below), F.lit(0).cast("long")).alias(f"{m}_before") for m in measures]
    return totals.select(part, *before, *[F.sum(m).over(every).alias(f"{m}_all") for m in measures])

"""Compaction of the event log: the many small files of a type and day become few large ones.

A compaction writes a generation next to the log: the rows of all complete batches it covers, and a table of these batches. Readers
take the newest generation that was written to its end and add the batches it does not cover, so a running writer never disturbs
them, and a batch that is replayed after it was covered counts once. What a generation covers leaves the log one compaction later,
when no reader of an older generation is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.reshape import stack_rows
from millrace.sources import folders

#: What names a batch's rows of one type and day; the folders of the log.
BATCH = T.StructType(
    [
        T.StructField("eventtype", T.StringType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("stream", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def _base(path: str) -> str:
    return f"{path.rstrip('/')}-compacted"


def _rows_of(schema: T.StructType) -> T.StructType:
    named = set(BATCH.fieldNames())
    return T.StructType([f for f in schema.fields if f.name not in named])


def _raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*_rows_of(schema).fields, *BATCH.fields])
    return spark.read.schema(full).option("basePath", path).parquet(path) if folders.names(spark, path) else spark.createDataFrame([], full)


def _generation(spark: SparkSession, path: str, schema: T.StructType, number: int) -> tuple[DataFrame, DataFrame]:
    """Rows and covered batches of a generation."""
    at = f"{_base(path)}/generation={number}"
    full = T.StructType([*_rows_of(schema).fields, *BATCH.fields[:2]])
    return spark.read.schema(full).parquet(f"{at}/rows"), spark.read.schema(BATCH).parquet(f"{at}/covered")


def _uncovered(raw: DataFrame, covered: DataFrame) -> DataFrame:
    return raw.join(covered, BATCH.fieldNames(), "left_anti")


def read_compacted_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All events of the log, ``eventtype`` and ``event_date`` included, from the newest generation and the batches since."""
    wanted = [*_rows_of(schema).fieldNames(), *BATCH.fieldNames()[:2]]
    raw = _raw(spark, path, schema)
    found = folders.generations(spark, _base(path))
    if not found:
        return raw.select(*wanted)
    rows, covered = _generation(spark, path, schema, found[-1])
    return stack_rows(rows.select(*wanted), _uncovered(raw, covered).select(*wanted))


def compact_log(spark: SparkSession, path: str, schema: T.StructType) -> int | None:
    """Write the next generation and return its number; null when no batch has come since the last one.

    Only types and days with new batches are rewritten into files of the session's advisory partition size, each by as many tasks as
    its rows need; all others are carried over with them. Batches that the generation before covers are deleted from the log.
    """
    found = folders.generations(spark, _base(path))
    number = found[-1] + 1 if found else 0
    raw = _raw(spark, path, schema)
    batches = raw.select(*BATCH.fieldNames()).distinct()
    old = _generation(spark, path, schema, found[-1]) if found else None
    fresh = batches if old is None else _uncovered(batches, old[1])
    if fresh.isEmpty():
        return None
    at = f"{_base(path)}/generation={number}"
    wanted = [*_rows_of(schema).fieldNames(), *BATCH.fieldNames()[:2]]
    # the list is written first: a batch that comes meanwhile is in neither
    covered = fresh if old is None else stack_rows(old[1], fresh)
    covered.coalesce(1).write.mode("overwrite").parquet(f"{at}/covered")
    taken = spark.read.schema(BATCH).parquet(f"{at}/covered")
    rows = raw.join(taken if old is None else _uncovered(taken, old[1]), BATCH.fieldNames(), "left_semi").select(*wanted)
    if old is not None:
        rows = stack_rows(old[0].select(*wanted), rows)
    packed = rows.hint("rebalance", F.col("eventtype"), F.col("event_date"))
    packed.write.mode("overwrite").partitionBy("eventtype", "event_date").parquet(f"{at}/rows")
    folders.mark_complete(spark, at)
    if old is not None:
        _forget(spark, path, old[1])
        for n in found[:-1]:
            folders.delete(spark, f"{_base(path)}/generation={n}")
    return number


def _forget(spark: SparkSession, path: str, covered: DataFrame) -> None:
    """Delete the folders of covered batches, a bounded listing of which reaches the driver one after the other."""
    for b in covered.distinct().toLocalIterator():
        folders.delete(spark, f"{path}/eventtype={b['eventtype']}/event_date={b['event_date']}/stream={b['stream']}/batch_id={b['batch_id']}")

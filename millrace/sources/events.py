"""Reading and appending events: configuration files, JSON events and the partitioned event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scalar import null_if_nan
from millrace.functions.times import parse_event_time
from millrace.operators.quality import parse_with_reason, quarantine
from millrace.schemas import EVENT, FEATURES_CONFIG, PLANT_CONFIG, TAGS_CONFIG


def read_features_config(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FEATURES_CONFIG).json(path, multiLine=True)


def read_tags_config(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TAGS_CONFIG).json(path, multiLine=True)


def read_plant_config(spark: SparkSession, path: str) -> dict:
    """The one-row plant configuration as a dictionary."""
    rows = spark.read.schema(PLANT_CONFIG).json(path, multiLine=True).limit(2).collect()
    if len(rows) != 1:
        raise ValueError("the plant configuration must have exactly one row")
    return rows[0].asDict()


def read_table(spark: SparkSession, name: str, folder: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A laboratory table, from the catalog or from a folder of tables."""
    return spark.read.table(name) if folder is None else spark.read.format(fmt).load(f"{folder}/{name}")


def read_json_events(spark: SparkSession, path: str, schema: T.StructType = EVENT) -> DataFrame:
    """Newline-delimited JSON events; an empty folder gives an empty frame, and a line that is no JSON ends the job.

    ``read_checked_events`` sets broken lines aside instead.
    """
    return typed_events(spark.read.schema(schema).json(path, mode="FAILFAST"))


def events_from_text(df: DataFrame, column: str = "value", schema: T.StructType = EVENT) -> DataFrame:
    """Events carried as JSON text or bytes in a message column; a message that is no JSON ends the job (see ``checked_messages``)."""
    parsed = df.select(F.from_json(F.col(column).cast("string"), schema, {"mode": "FAILFAST"}).alias("_event"))
    return typed_events(parsed.select("_event.*"))


#: Fields without which a message is no event.
REQUIRED = ("site_id", "timestamp", "eventtype")


def checked_messages(raw: DataFrame, column: str = "value", schema: T.StructType = EVENT) -> tuple[DataFrame, DataFrame]:
    """Events of the messages that are valid, and the others as ``(column, reason)``.

    A message is rejected when it is not readable as the schema, lacks a required field or has a time that is none.
    """
    return split_checked(checked_lines(raw, column, schema), column)


def checked_lines(raw: DataFrame, column: str = "value", schema: T.StructType = EVENT) -> DataFrame:
    """Messages with ``parsed`` and the ``reason`` for which they are no event; null where they are one."""
    text = raw.withColumn(column, F.col(column).cast("string"))
    checks = {"unreadable timestamp": parse_event_time(F.col("parsed.timestamp")).isNotNull()}
    return parse_with_reason(text, column, schema, REQUIRED, checks)


def split_checked(checked: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    valid, rejected = quarantine(checked)
    return typed_events(valid.select("parsed.*")), rejected.select(column, "reason")


def read_checked_events(spark: SparkSession, path: str, schema: T.StructType = EVENT) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected lines of newline-delimited JSON; broken lines are reported, never read as empty events."""
    return checked_messages(spark.read.text(path), "value", schema)


def typed_events(raw: DataFrame) -> DataFrame:
    """Event text times to instants; readings that are not a number become null."""
    clean = F.transform(
        "records", lambda r: F.struct(r["id"].alias("id"), null_if_nan(r["value"]).alias("value"))
    )
    return raw.withColumns({"ts": parse_event_time(F.col("timestamp")), "records": clean}).drop("timestamp")


def append_events(events: DataFrame, path: str) -> None:
    """Append to the log, one folder per event type and day."""
    _log_rows(events).write.mode("append").partitionBy("eventtype", "event_date").parquet(path)


def running_stream(spark: SparkSession) -> str | None:
    """Inside a batch handler, the id of the stream; it is kept with the checkpoint, so restarts have the same one."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def write_batch(df: DataFrame, path: str, batch_id: int, partitions: tuple[str, ...] = (), stream: str | None = None) -> None:
    """Write one micro-batch to its own folders. A replayed batch overwrites itself, so nothing is doubled.

    Streams count their batches from 0, so a batch is named by its stream too: ``stream``, or else the running one. Stream and
    batch are the innermost folders: readers prune by the outer columns first.
    """
    name = stream or running_stream(df.sparkSession)
    if not name:
        raise ValueError("outside a stream, name the stream that the batch belongs to")
    marked = df.withColumns({"stream": F.lit(name), "batch_id": F.lit(batch_id)})
    writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions, "stream", "batch_id").parquet(path)


def append_event_batch(events: DataFrame, path: str, batch_id: int, stream: str | None = None) -> None:
    write_batch(_log_rows(events), path, batch_id, ("eventtype", "event_date"), stream)


def _log_rows(events: DataFrame) -> DataFrame:
    return events.withColumn("event_date", F.to_date("ts"))


def read_log(spark: SparkSession, path: str, schema: T.StructType, eventtype: str | None = None) -> DataFrame:
    """The event log, or one event type of it (only that type's folders are read)."""
    full = T.StructType(
        [f for f in schema.fields if f.name not in ("eventtype", "event_date")]
        + [T.StructField("eventtype", T.StringType()), T.StructField("event_date", T.DateType())]
    )
    log = spark.read.schema(full).option("basePath", path).parquet(path)
    return log if eventtype is None else log.where(F.col("eventtype") == eventtype)


def between_days(log: DataFrame, first: Column, last: Column) -> DataFrame:
    """Log rows of the given days; the partition column prunes folders."""
    return log.where(F.col("event_date").between(F.to_date(first), F.to_date(last)))


def newest_anchor(events: DataFrame) -> DataFrame:
    """The newest instant of each site as its anchor."""
    return events.groupBy("site_id").agg(F.max("ts").alias("anchor_ts"))

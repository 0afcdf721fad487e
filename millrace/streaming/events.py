"""Structured Streaming: unique events, quarantine, rollups, the event log and the live feature run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.config import StoreConfig
from millrace.operators.dedup import survivor_per_key
from millrace.operators.gate import GateFeatures, GateRules
from millrace.operators.results import result_json
from millrace.plans.feature_store import run, unique_events
from millrace.sources.events import append_event_batch, between_days, checked_messages, newest_anchor, read_log, running_stream, write_batch
from millrace.streaming.state import SiteState


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", pattern: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def unique_stream(events: DataFrame, keys: list[str], delay: str, ts: str = "ts") -> DataFrame:
    """First event per key; later copies within the watermark are dropped and state older than it is freed."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def changes_before(anchors: DataFrame, changes: DataFrame, delay: str, reach_seconds: int) -> DataFrame:
    """``site_id, anchor_ts, change_ts``: every change at most ``reach_seconds`` before an anchor of its site, from two streams.

    ``anchors(site_id, anchor_ts)`` and ``changes(site_id, ts)`` may come in any order within ``delay``; rows that no partner can reach
    any more leave the state. Together with ``newest_change`` this is the as-of look-up of the gate without reading a log: a change
    older than the gate's settling time decides nothing, so that time is reach enough.
    """
    left = anchors.withWatermark("anchor_ts", delay)
    right = changes.select(F.col("site_id").alias("_site"), F.col("ts").alias("change_ts")).withWatermark("change_ts", delay)
    reach = F.expr(f"INTERVAL {reach_seconds} SECONDS")
    near = (F.col("change_ts") <= F.col("anchor_ts")) & (F.col("change_ts") >= F.col("anchor_ts") - reach)
    return left.join(right, (F.col("site_id") == F.col("_site")) & near).select("site_id", "anchor_ts", "change_ts")


def newest_change(pairs: DataFrame, anchors: DataFrame) -> DataFrame:
    """``site_id, anchor_ts, change_ts`` of every anchor: the newest of its changes in ``pairs``, null without one."""
    newest = pairs.groupBy("site_id", "anchor_ts").agg(F.max("change_ts").alias("change_ts"))
    return anchors.join(newest, ["site_id", "anchor_ts"], "left")


def tumbling_rollup(events: DataFrame, delay: str, length: str, keys: list[str]) -> DataFrame:
    """Count, mean and maximum per key and fixed window.

    ``delay`` must cover the disorder of the source: an event later than that is not counted.
    """
    return (
        events.withWatermark("ts", delay)
        .groupBy(F.window("ts", length), *keys)
        .agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.max("value").alias("peak"))
        .select(*keys, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n", "mean", "peak")
    )


def sliding_rollup(events: DataFrame, delay: str, length: str, slide: str, keys: list[str]) -> DataFrame:
    """Mean per key over overlapping windows; ``delay`` as for ``tumbling_rollup``."""
    return (
        events.withWatermark("ts", delay)
        .groupBy(F.window("ts", length, slide), *keys)
        .agg(F.count("*").alias("n"), F.avg("value").alias("mean"))
        .select(*keys, F.col("window.start").alias("start"), "n", "mean")
    )


def drain(stream: DataFrame, checkpoint: str, write_to: str | None = None, each: Callable[[DataFrame, int], None] | None = None, mode: str = "append") -> StreamingQuery:
    """Process all available input and stop. Writes Parquet files, or hands every batch to ``each``."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = writer.foreachBatch(each).start() if each else writer.format("parquet").start(write_to)
    query.awaitTermination()
    return query


def version_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Batch handler for rollups in update mode: every batch's changed rows, in folders of that batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)

    return write


def newest_versions(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """Of every row that ``version_writer`` wrote the newest version, open windows included."""
    versions = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])).parquet(path)
    return survivor_per_key(versions.select(*schema.fieldNames(), "batch_id"), keys, F.col("batch_id")).select(*schema.fieldNames())


def log_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Batch handler that appends events to the log, safe to replay."""
    def append(batch: DataFrame, batch_id: int) -> None:
        append_event_batch(batch, path, batch_id)

    return append


def checked_log_writer(path: str, rejected_path: str, column: str = "value") -> Callable[[DataFrame, int], None]:
    """Batch handler for raw messages: valid ones reach the log as events, the others their own folder with the reason."""
    def append(batch: DataFrame, batch_id: int) -> None:
        valid, rejected = checked_messages(batch, column)
        write_batch(rejected, rejected_path, batch_id)
        append_event_batch(valid, path, batch_id)

    return append


def live_features(
    log_path: str,
    out_path: str,
    cfg: StoreConfig,
    ids: GateFeatures,
    rules: GateRules = GateRules(),
    telemetry: str = "eventtype1",
    change: str = "eventtype2",
    rejected_path: str | None = None,
    state_path: str | None = None,
    gate_path: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """Batch handler for the live run.

    Appends the batch to the log, takes each site's newest event as its anchor and computes features from what the longest slice
    can reach: with ``state_path`` from the table of recent events kept there (``streaming.state``), else from the log's days.
    Sites without any history are skipped. With ``rejected_path`` the batch is raw messages (``value``): invalid ones go there
    with their reason and never reach the log. ``gate_path`` gets each batch's gate decisions.
    """
    reach = max(cfg.long_slice_steps, cfg.switch_steps) * cfg.step_seconds
    # a change older than the settling time decides nothing
    state = None if state_path is None else SiteState(state_path, max(reach, int(rules.settle_seconds) + 1), telemetry)

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if rejected_path is not None:
            batch, rejected = checked_messages(batch)
            write_batch(rejected, rejected_path, batch_id)
        append_event_batch(batch, log_path, batch_id)
        touched = batch.where(F.col("eventtype") == telemetry)
        # a late event recomputes its site's newest anchor, which may lie after this batch
        if state is None:
            bounds = touched.agg(F.min("ts"), F.max("ts")).first()
            if bounds[1] is None:
                return
            first = F.lit(bounds[0]) - F.expr(f"INTERVAL {reach} SECONDS")
            recent = read_log(spark, log_path, batch.schema).where(F.col("event_date") >= F.to_date(first))
        else:
            recent = state.merge(batch, batch_id)
        sites = touched.select("site_id").distinct()
        mine = recent.join(sites, "site_id", "left_semi")
        events = unique_events(mine.where(F.col("eventtype") == telemetry).select("site_id", "ts", "plant_up", "records", "sequenceID"))
        counted = events.groupBy("site_id").agg(F.max("ts").alias("anchor_ts"), F.count("*").alias("n"))
        anchors = counted.where("n > 1").select("site_id", "anchor_ts")
        changes = mine.where(F.col("eventtype") == change).select("site_id", "ts")
        output = run(events, changes, anchors, cfg, ids, rules, materialise_gate=True, gate_name=f"gate-{running_stream(spark)}")
        if gate_path is not None:
            write_batch(output.gate, gate_path, batch_id)
        write_batch(result_json(output.results), out_path, batch_id)

    return process


__all__ = [
    "between_days", "changes_before", "checked_log_writer", "drain", "file_stream", "live_features", "log_writer", "newest_anchor", "newest_change",
    "newest_versions",
    "sliding_rollup", "tumbling_rollup", "unique_stream", "version_writer",
]

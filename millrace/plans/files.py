"""One run from files to result texts: configuration and events in, one line per answered site out, with its checks.

Checks do not read the data again: metrics are observed while the run writes, once where events are read and once where results are
written, and turned into errors or warnings afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators.gate import GateFeatures, GateRules
from millrace.operators.quality import FeatureMismatch
from millrace.operators.results import result_json
from millrace.plans import configs
from millrace.plans.feature_store import run, unique_events
from millrace.session import scratch_path
from millrace.sources import events as src
from millrace.sources.sinks import write_result_text


@dataclass
class Inputs:
    """Folders and files of one run. ``is_run_tag`` marks run tags among the tags; ``grid`` holds settings of ``StoreConfig``."""

    events: str
    features: str
    tags: str
    plant: str
    is_run_tag: Column
    telemetry: str = "eventtype1"
    change: str = "eventtype2"
    run_tags_on: str = "equipment"
    rules: GateRules = field(default_factory=GateRules)
    grid: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Report:
    """What the run saw: lines, broken lines, events, surplus copies, and of the results their number, and how many exceed null limits."""

    lines: int
    broken: int
    events: int
    copies: int
    results: int
    features: int
    too_many_nulls: int

    def warnings(self) -> list[str]:
        found = {
            f"{self.broken} broken lines were set aside": self.broken, f"{self.copies} copies of events were dropped": self.copies,
            f"{self.too_many_nulls} features have nulls more than the null threshold": self.too_many_nulls,
        }
        return [text for text, n in found.items() if n]


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(condition.cast("bigint")), F.lit(0).cast("bigint"))


def run_files(spark: SparkSession, given: Inputs, out_path: str, rejected_path: str) -> Report:
    """Answer each site's newest event and write the answers, one JSON text per line, to ``out_path``.

    Broken event lines go to ``rejected_path`` with their reason. An empty configuration, no event at all, results without features
    and results whose current and anticipated features differ end the run with an error, the latter two before anything is
    published: results are written to the shared folder first.
    """
    features_config = configs.require_rows(src.read_features_config(spark, given.features).where("size(features) > 0"), "Features config is empty")
    tags_config = configs.require_rows(src.read_tags_config(spark, given.tags).where("exists(sites, s -> size(s.tags) > 0)"), "ETL configuration (tags config) is empty")

    # events are read and checked once; everything after reads the written copy
    read, kept = Observation("read"), Observation("kept")
    lines = src.checked_lines(spark.read.text(given.events)).observe(read, F.count("*").alias("lines"), _count(F.col("reason").isNotNull()).alias("broken"))
    staged = scratch_path(spark, "events")
    events, rejected = src.split_checked(lines)
    rows = unique_events(events, keys=["site_id", "eventtype", "ts"]).observe(kept, F.count("*").alias("events"), _count(F.col("eventtype") == given.telemetry).alias("telemetry"))
    rows.write.partitionBy("eventtype").parquet(staged)
    n, k = read.get, kept.get
    if n["broken"]:
        src.split_checked(src.checked_lines(spark.read.text(given.events)))[1].write.mode("append").parquet(rejected_path)
    if not k["telemetry"]:
        raise ValueError("Event input is empty")

    known = spark.read.schema(rows.schema).parquet(staged)
    telemetry = known.where(F.col("eventtype") == given.telemetry).select("site_id", "ts", "plant_up", "records", "sequenceID")
    changes = known.where(F.col("eventtype") == given.change).select("site_id", "ts")
    present = telemetry.select(F.explode("records.id").alias("tag_id")).distinct()
    tags = configs.normalise_tags(tags_config, present)
    runs = configs.run_tag_pairs(tags, given.is_run_tag, given.run_tags_on)
    plant = src.read_plant_config(spark, given.plant)
    cfg = configs.resolve(configs.normalise_features(features_config), tags, runs, plant, **given.grid)
    ids = GateFeatures(plant["plantup_time"], plant["plantup_switch"], plant["moisture_feature"], plant["moisture_target_feature"])
    # a site without any history before its newest event is skipped
    newest = telemetry.groupBy("site_id").agg(F.max("ts").alias("anchor_ts"), F.count("*").alias("n")).where("n > 1")
    output = run(telemetry, changes, newest.select("site_id", "anchor_ts"), cfg, ids, given.rules, materialise_gate=True)

    seen = Observation("results")
    current, anticipated = (F.transform(c, lambda r: r["id"]) for c in ("currentFeatureRecords", "anticipatedFeatureRecords"))
    per_result = output.results.observe(
        seen, F.count("*").alias("results"), _count(F.size("currentFeatureRecords") == 0).alias("no_current"),
        _count(F.size("anticipatedFeatureRecords") == 0).alias("no_anticipated"), _count(current != anticipated).alias("mismatches"),
        F.coalesce(F.sum(F.size("currentFeatureRecords") + F.size("plantConditions")), F.lit(0)).cast("bigint").alias("features"),
        F.coalesce(F.sum("too_many_nulls"), F.lit(0)).cast("bigint").alias("too_many_nulls"),
    )
    answers = scratch_path(spark, "answers")
    result_json(per_result, with_site=True).write.parquet(answers)
    r = seen.get
    for name in ("current", "anticipated"):
        if r[f"no_{name}"]:
            raise ValueError(f"The {name} features is empty")
    if r["mismatches"]:
        raise FeatureMismatch(f"Features mismatch between currentFeatureRecords and anticipatedFeatureRecords: {r['mismatches']} results")
    write_result_text(spark.read.parquet(answers), out_path)
    surplus = n["lines"] - n["broken"] - k["events"]
    return Report(n["lines"], n["broken"], k["events"], surplus, r["results"], r["features"], r["too_many_nulls"])

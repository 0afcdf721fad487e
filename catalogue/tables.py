"""How the given tables stand in for plant telemetry, and the same views as SQL for the comparison.

A site is a group of 50 users, so the number of sites grows with the data while a site's density stays.
The grid step is an hour; tags are event types. ``error`` is an on/off run tag (1 from a mean of 10 on).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import Feature, StoreConfig
from millrace.operators.gate import GateFeatures, GateRules
from millrace.operators.optimal import long_to_events

STEP = 3600
TAGS = ["click", "error", "purchase", "signup", "view"]
RUN_TAGS_OF = {"purchase": ("error",), "signup": ("error",)}
SMOOTHED = ("click", "purchase", "view")
CHANGE_VALUE = 200.0
DIGITS = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame, *columns: str) -> DataFrame:
    """Instants back to zone-free timestamps, as the given tables store them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def shown(value) -> Column:
    """Nine digits for the comparison; the offset keeps exact ties from rounding by summation order."""
    return F.round((F.col(value) if isinstance(value, str) else value) + 3e-11, 9)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single readings: ``event_id, site_id, ts, tag_id, value``."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.expr("cast(user_id div 50 as int)").alias("site_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("tag_id"),
        "value",
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long telemetry, unique per ``(site_id, ts, tag_id)``, with the number of readings in ``n``."""
    hourly = raw_events(spark, sf_dir).groupBy(
        "site_id", F.date_trunc("hour", "ts").alias("ts"), "tag_id"
    ).agg(F.round(F.avg("value"), DIGITS).alias("mean"), F.count("*").alias("n"))
    value = F.when(F.col("tag_id") == "error", (F.col("mean") >= 10).cast("double")).otherwise(F.col("mean"))
    return hourly.select("site_id", "ts", "tag_id", value.alias("value"), "n")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested events ``site_id, ts, plant_up, records``; the plant is up unless a quarter are errors."""
    errors = F.sum(F.when(F.col("tag_id") == "error", F.col("n")).otherwise(0))
    record = F.struct(F.col("tag_id").alias("id"), F.col("value").alias("value"))
    return telemetry(spark, sf_dir).groupBy("site_id", "ts").agg(
        (4 * errors < F.sum("n")).cast("int").alias("plant_up"),
        F.array_sort(F.collect_list(record)).alias("records"),
    )


def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every midnight at which a site reported; the first ones have little or no history."""
    ts = F.date_trunc("hour", "ts")
    return raw_events(spark, sf_dir).where(ts == F.date_trunc("day", "ts")).select("site_id", ts.alias("anchor_ts")).distinct()


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events: purchases above a value."""
    return raw_events(spark, sf_dir).where((F.col("tag_id") == "purchase") & (F.col("value") > CHANGE_VALUE))


def nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_to_events(telemetry(spark, sf_dir))


FEATURES = (
    Feature(1, ("click", "view"), "mean", None, None, 0.5, "mean", "mean", 60),
    Feature(2, ("click", "purchase"), "max", 30, 0.0, 0.3, "mean", "mean", 60),
    Feature(3, (), "thickener_underflow_mass_rate", 5, None, 0.6, "mean", "mean", 60,
            ("click", " view", "purchase ", "signup")),
    Feature(4, (), "moisture_target", None, None, 0.5, "last", None, 60),
    Feature(5, ("view",), "greater", None, None, 0.5, "mean", "last", 60, ("30.7",)),
    Feature(6, ("click", "view"), "passthrough", 10, 0.0, 0.5, "ratio", None, 60),
    Feature(7, ("click", "purchase", "signup", "view"), "mean", None, None, 0.2, "torque", "mean", 120),
    Feature(8, ("view",), "mean", 90, None, 0.1, "mean_greater", "mean", 60, ("34",)),
    Feature(9, ("view", "click"), "mean", None, 7.0, 0.5, "mean", "mean", 288),
    Feature(10, ("click", "signup"), "max", 30, None, 0.5, "last", "mean", 288),
    Feature(11, ("plantup_time",), None, None, None, 0.5, "last", None, 60, (), True),
    Feature(12, ("plantup_switch",), None, None, None, 0.5, "mean", None, 60, (), True),
    Feature(13, ("plantup_minutes",), None, None, None, 0.5, "last", None, 60, (), True),
    Feature(14, ("view",), "mean", None, None, 0.5, None, None, 60),
)

CONFIG = StoreConfig(
    features=FEATURES,
    smoothed_tags=SMOOTHED,
    run_tags_of=RUN_TAGS_OF,
    critical_tags=("error",),
    optimal_tag="view",
    optimal_threshold=8.0,
    moisture_target=35.0,
    trigger_features=(1, 4, 11, 12),
    step_seconds=STEP,
    long_slice_steps=330,
    long_steps=288,
    trend_high=36.0,
    trend_high_high=40.0,
)
GATE_FEATURES = GateFeatures(plantup_time=11, plantup_switch=12, moisture=1, moisture_target=4)
GATE_RULES = GateRules(quiet_seconds=12 * 3600, settle_seconds=36 * 3600, moisture_gap=1.5)

# --- the same views in SQL -------------------------------------------------------------------------

SQL_RAW = """
raw AS (
  SELECT event_id, CAST(user_id // 50 AS INTEGER) AS site_id, ts, event_type AS tag_id, value FROM events
)"""
SQL_TELEMETRY = SQL_RAW + """,
hourly AS (
  SELECT site_id, date_trunc('hour', ts) AS ts, tag_id, round(avg(value), 6) AS mean, count(*) AS n
  FROM raw GROUP BY 1, 2, 3
),
telemetry AS (
  SELECT site_id, ts, tag_id,
         CASE WHEN tag_id = 'error' THEN CASE WHEN mean >= 10 THEN 1.0e0 ELSE 0.0e0 END ELSE mean END AS value, n
  FROM hourly
)"""
SQL_PLANT = """
plant AS (
  SELECT site_id, ts,
         CASE WHEN 4 * sum(CASE WHEN tag_id = 'error' THEN n ELSE 0 END) < sum(n) THEN 1 ELSE 0 END AS plant_up
  FROM telemetry GROUP BY 1, 2
)"""
SQL_ANCHORS = """
anchors AS (
  SELECT DISTINCT site_id, ts AS anchor_ts FROM telemetry
  WHERE ts = date_trunc('day', ts)
)"""
SQL_BASE = SQL_TELEMETRY + "," + SQL_PLANT + "," + SQL_ANCHORS
SQL_TAGS = "(VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) AS t(tag_id)"


def with_base(sql: str) -> str:
    return f"WITH {SQL_BASE} {sql}"


SQL_DENSE = SQL_BASE + f""",
spine AS (
  SELECT site_id, anchor_ts, CAST(k AS BIGINT) AS back, anchor_ts - to_hours(CAST(k AS INTEGER)) AS ts
  FROM anchors, range(0, 151) r(k)
),
dense AS (
  SELECT s.site_id, s.anchor_ts, s.back, s.ts, t.tag_id, e.value, coalesce(p.plant_up, 0) AS plant_up,
         p.ts IS NOT NULL AS present
  FROM spine s CROSS JOIN {SQL_TAGS}
  LEFT JOIN telemetry e ON e.site_id = s.site_id AND e.ts = s.ts AND e.tag_id = t.tag_id
  LEFT JOIN plant p ON p.site_id = s.site_id AND p.ts = s.ts
)"""


def with_dense(sql: str) -> str:
    return f"WITH {SQL_DENSE} {sql}"


def dense(spark: SparkSession, sf_dir: str, steps: int = 150) -> DataFrame:
    """Gap-free compact history of every anchor: ``site_id, anchor_ts, back, plant_up, cells``."""
    from millrace.functions.times import Grid
    from millrace.operators.history import compact_events, dense_history

    compact = compact_events(events(spark, sf_dir), TAGS)
    return dense_history(compact, anchors(spark, sf_dir), Grid(STEP), steps)


def dense_cells(spark: SparkSession, sf_dir: str, steps: int = 120) -> DataFrame:
    """The same as rows ``site_id, anchor_ts, ts, back, tag_id, value, plant_up``."""
    from millrace.functions.times import Grid

    names = F.array(*[F.lit(x) for x in TAGS])
    cells = F.coalesce("cells", F.array_repeat(F.lit(None).cast("double"), len(TAGS)))
    return dense(spark, sf_dir, steps).select(
        "site_id", "anchor_ts", Grid(STEP).earlier(F.col("anchor_ts"), F.col("back")).alias("ts"), "back", "plant_up",
        F.posexplode(cells).alias("_slot", "value"),
    ).withColumn("tag_id", F.get(names, F.col("_slot"))).drop("_slot")

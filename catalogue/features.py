"""Feature functions, null report, imputation and parity on dense cells."""

from pyspark.sql import functions as F

from catalogue import tables as t
from catalogue.registry import query
from millrace.functions.scalar import at_least_flag, impute_when_up, mass_rate, ordered_list, strip_spaces
from millrace.operators import quality

INSTANT = ["site_id", "anchor_ts", "ts"]
PAIRS = "('mean_flow', 0, 'click'), ('mean_flow', 1, 'view'), ('mixed', 0, 'purchase'), ('mixed', 1, 'signup'), ('mixed', 2, 'view')"
GROUPED = f", ops(feature, pos, tag_id) AS (VALUES {PAIRS}), c AS (SELECT * FROM dense JOIN ops USING (tag_id) WHERE back <= 120)"


def _pairs(spark):
    return spark.sql(f"SELECT * FROM VALUES {PAIRS} AS p(feature, pos, tag_id)")


def _operands(spark, sf):
    return t.dense_cells(spark, sf).join(_pairs(spark), "tag_id")


@query("feature_mean", t.with_dense(GROUPED + "SELECT site_id, anchor_ts, ts, feature, round(avg(value) + 3e-11, 9) AS value FROM c GROUP BY 1, 2, 3, 4"))
def feature_mean(spark, sf):
    means = _operands(spark, sf).groupBy(*INSTANT, "feature").agg(t.shown(F.avg("value")).alias("value"))
    return t.plain(means, "ts", "anchor_ts")


@query("feature_max", t.with_dense(GROUPED + "SELECT site_id, anchor_ts, ts, feature, max(value) AS value FROM c GROUP BY 1, 2, 3, 4"))
def feature_max(spark, sf):
    peaks = _operands(spark, sf).groupBy(*INSTANT, "feature").agg(F.max("value").alias("value"))
    return t.plain(peaks, "ts", "anchor_ts")


CUSTOM = "click, view ,purchase,signup"


@query("feature_mass_rate", t.with_dense("""
, w AS (SELECT site_id, anchor_ts, ts, max(CASE WHEN tag_id = 'click' THEN value END) AS c0, max(CASE WHEN tag_id = 'view' THEN value END) AS c1,
        max(CASE WHEN tag_id = 'purchase' THEN value END) AS c2, max(CASE WHEN tag_id = 'signup' THEN value END) AS c3
        FROM dense WHERE back <= 120 GROUP BY 1, 2, 3)
SELECT site_id, anchor_ts, ts, round(coalesce(c0 * c1, c2 * c3) + 3e-11, 9) AS value FROM w"""))
def feature_mass_rate(spark, sf):
    names = spark.sql(f"SELECT posexplode(split('{CUSTOM}', ',')) AS (pos, name)")
    slots = names.select("pos", strip_spaces(F.col("name")).alias("tag_id"))
    cells = t.dense_cells(spark, sf).join(slots, "tag_id", "left")
    parts = [F.max(F.when(F.col("pos") == i, F.col("value"))).alias(f"c{i}") for i in range(4)]
    rates = cells.groupBy(*INSTANT).agg(*parts)
    rate = mass_rate(*[F.col(f"c{i}") for i in range(4)])
    return t.plain(rates.select(*INSTANT, t.shown(rate).alias("value")), "ts", "anchor_ts")


@query("feature_greater", t.with_dense(
    "SELECT site_id, anchor_ts, ts, tag_id, CASE WHEN value >= 40 THEN 1 ELSE 0 END AS value FROM dense WHERE back <= 120"))
def feature_greater(spark, sf):
    flag = at_least_flag(F.col("value"), F.lit("40.9").try_cast("double").cast("bigint"))
    return t.plain(t.dense_cells(spark, sf).select(*INSTANT, "tag_id", flag.alias("value")), "ts", "anchor_ts")


@query("feature_target", t.with_dense(
    "SELECT DISTINCT site_id, anchor_ts, ts, 35.0e0 AS value FROM dense WHERE back <= 120"))
def feature_target(spark, sf):
    cells = t.dense_cells(spark, sf).select(*INSTANT).distinct()
    return t.plain(cells.withColumn("value", F.lit(t.CONFIG.moisture_target)), "ts", "anchor_ts")


@query("feature_passthrough", t.with_dense(GROUPED + """
SELECT site_id, anchor_ts, ts, feature, len(list(coalesce(value, -1))) AS n,
       string_agg(CASE WHEN value IS NULL THEN 'null' ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END, ',' ORDER BY pos) AS items
FROM c GROUP BY 1, 2, 3, 4"""))
def feature_passthrough(spark, sf):
    lists = _operands(spark, sf).groupBy(*INSTANT, "feature").agg(ordered_list(F.col("pos"), F.col("value")).alias("v"))
    shown = F.transform("v", lambda x: F.coalesce(F.round(x * 100).cast("bigint").cast("string"), F.lit("null")))
    return t.plain(
        lists.select(*INSTANT, "feature", F.size("v").cast("bigint").alias("n"), F.array_join(shown, ",").alias("items")), "ts", "anchor_ts"
    )


LIMITS = "('click', 0.3), ('error', 0.45), ('purchase', 0.5), ('signup', 0.9), ('view', NULL)"


@query("null_threshold", t.with_dense(f"""
, limits(tag_id, null_limit) AS (SELECT tag_id, CAST(l AS DOUBLE) FROM (VALUES {LIMITS}) v(tag_id, l))
SELECT site_id, anchor_ts, tag_id, round(avg(CASE WHEN value IS NULL THEN 1 ELSE 0 END), 8) AS null_share, max(null_limit) AS null_limit, 'error' AS severity
FROM dense JOIN limits USING (tag_id) WHERE back <= 120 GROUP BY 1, 2, 3
HAVING avg(CASE WHEN value IS NULL THEN 1 ELSE 0 END) > max(null_limit)"""))
def null_threshold(spark, sf):
    limits = spark.sql(f"SELECT tag_id, cast(l AS double) AS null_limit FROM VALUES {LIMITS} AS v(tag_id, l)")
    cells = t.dense_cells(spark, sf).join(limits, "tag_id")
    report = quality.null_share_report(cells, ["site_id", "anchor_ts", "tag_id"], F.col("null_limit"))
    return t.plain(report.withColumn("null_share", F.round("null_share", 8)), "anchor_ts")


@query("null_impute", t.with_dense("""
SELECT site_id, anchor_ts, ts, tag_id, CASE WHEN plant_up = 1 AND tag_id <> 'view' THEN coalesce(value, 0.5) ELSE value END AS value
FROM dense WHERE back <= 120"""))
def null_impute(spark, sf):
    constant = F.when(F.col("tag_id") != "view", F.lit(0.5))
    filled = impute_when_up(F.col("value"), F.col("plant_up"), constant)
    return t.plain(t.dense_cells(spark, sf).select(*INSTANT, "tag_id", filled.alias("value")), "ts", "anchor_ts")


@query("feature_parity", t.with_base("""
, c AS (SELECT DISTINCT site_id * 100 + extract(hour FROM ts) AS feature_id FROM telemetry WHERE tag_id = 'click' AND value > 40),
a AS (SELECT DISTINCT site_id * 100 + extract(hour FROM ts) AS feature_id FROM telemetry WHERE tag_id = 'view' AND value > 90)
SELECT CAST(coalesce(c.feature_id, a.feature_id) AS INTEGER) AS feature_id, CASE WHEN a.feature_id IS NULL THEN 'current' ELSE 'anticipated' END AS only_in
FROM c FULL JOIN a ON c.feature_id = a.feature_id WHERE a.feature_id IS NULL OR c.feature_id IS NULL"""))
def feature_parity(spark, sf):
    tele = t.telemetry(spark, sf).withColumn("feature_id", F.col("site_id") * 100 + F.hour("ts"))
    return quality.feature_mismatch(tele.where("tag_id = 'click' AND value > 40"), tele.where("tag_id = 'view' AND value > 90"))

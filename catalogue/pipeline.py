"""The whole feature run: features, gate and output events."""

import json

from pyspark.sql import functions as F

from catalogue import tables as t
from catalogue.registry import query
from catalogue.signals import SQL_MEDIAN, SQL_MEDIAN_WINDOW, TORQUE_TAIL
from catalogue.timing import UPTIME_SQL
from millrace.config import Feature
from millrace.operators import quality, results
from millrace.operators.features import operands
from millrace.plans import feature_store as store
from millrace.plans import files
from millrace.session import scratch_path
from millrace.sources import sinks

# Operands and steering values of the demonstration configuration, as SQL rows.
OPS = ", ".join(f"({f.id}, {i}, '{x}')" for f in t.FEATURES for i, x in enumerate(operands(f)))


def _sql(v):
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


CFG = ", ".join(
    f"({f.id}, {_sql(f.function)}, {f.lag or 0}, {f.lag - 60 if (f.lag or 0) > 60 else 0}, {_sql(f.null_impute)}, "
    f"{_sql(f.null_threshold)}, {f.steps}, {_sql(f.current)}, {_sql(f.anticipated)}, "
    f"{f.threshold if f.function == 'greater' or f.current == 'mean_greater' else 'NULL'}, {str(f.condition).lower()})"
    for f in t.FEATURES
)

SQL_STORE = t.SQL_BASE + ", " + f"""
cfg(feature_id, fn, lag, lag_ahead, impute, null_limit, steps, now_agg, ahead_agg, threshold, is_condition) AS (VALUES {CFG}),
ops(feature_id, pos, tag_id) AS (VALUES {OPS}),
tags AS (SELECT DISTINCT tag_id FROM ops WHERE tag_id NOT LIKE 'plantup%'),
low AS (SELECT DISTINCT site_id, ts FROM telemetry WHERE tag_id = 'view' AND coalesce(value, 0) <= 8),
state AS (SELECT p.site_id, p.ts, CASE WHEN low.ts IS NULL THEN 1 ELSE 0 END AS plant_up
          FROM plant p LEFT JOIN low ON p.site_id = low.site_id AND p.ts = low.ts),
cleared AS (SELECT e.site_id, e.ts, e.tag_id, CASE WHEN low.ts IS NULL OR e.tag_id = 'error' THEN e.value END AS value
            FROM telemetry e LEFT JOIN low ON e.site_id = low.site_id AND e.ts = low.ts),
masked AS (SELECT e.site_id, e.ts, e.tag_id, CASE WHEN e.tag_id NOT IN ('purchase', 'signup') OR r.value = 1 THEN e.value END AS value
           FROM cleared e LEFT JOIN cleared r ON e.site_id = r.site_id AND e.ts = r.ts AND r.tag_id = 'error'),
grid AS (
  SELECT a.site_id, a.anchor_ts, CAST(k AS BIGINT) AS back, a.anchor_ts - to_hours(CAST(k AS INTEGER)) AS ts,
         coalesce(s.plant_up, 0) AS plant_up
  FROM anchors a CROSS JOIN range(0, 151) r(k)
  LEFT JOIN state s ON s.site_id = a.site_id AND s.ts = a.anchor_ts - to_hours(CAST(k AS INTEGER))),
{UPTIME_SQL.format(source="grid")},
short_rows AS (SELECT site_id, anchor_ts, ts, back + 1 AS rank, plant_up, CAST(NULL AS BIGINT) AS tail_rows, 'short' AS horizon FROM grid WHERE back <= 120),
long_seen AS (
  SELECT a.site_id, a.anchor_ts, s.ts FROM anchors a JOIN state s ON s.site_id = a.site_id AND s.ts BETWEEN a.anchor_ts - INTERVAL 330 HOUR AND a.anchor_ts),
long_in AS (  -- an anchor without any earlier row has the empty short grid before it
  SELECT * FROM long_seen UNION ALL
  SELECT a.site_id, a.anchor_ts, a.anchor_ts - to_hours(CAST(k AS INTEGER)) AS ts FROM anchors a CROSS JOIN range(1, 121) r(k)
  WHERE NOT EXISTS (SELECT 1 FROM long_seen s WHERE s.site_id = a.site_id AND s.anchor_ts = a.anchor_ts AND s.ts < a.anchor_ts)),
long_rows AS (
  SELECT site_id, anchor_ts, ts, row_number() OVER (PARTITION BY site_id, anchor_ts ORDER BY ts DESC) AS rank,
         CAST(NULL AS INTEGER) AS plant_up, count(*) FILTER (ts > anchor_ts - INTERVAL 288 HOUR) OVER (PARTITION BY site_id, anchor_ts) AS tail_rows,
         'long' AS horizon
  FROM long_in),
instants AS (SELECT * FROM short_rows UNION ALL SELECT * FROM long_rows),
series AS (
  SELECT i.site_id, i.anchor_ts, i.ts, i.rank, i.horizon, t.tag_id, m.value
  FROM instants i CROSS JOIN tags t LEFT JOIN masked m ON m.site_id = i.site_id AND m.ts = i.ts AND m.tag_id = t.tag_id),
smooth AS (
  SELECT site_id, anchor_ts, ts, rank, horizon, tag_id,
         CASE WHEN tag_id IN ('click', 'purchase', 'view') THEN {SQL_MEDIAN} ELSE value END AS value
  FROM series {SQL_MEDIAN_WINDOW.replace("anchor_ts, tag_id", "anchor_ts, horizon, tag_id")}),
cells AS (
  SELECT site_id, anchor_ts, rank, horizon, tag_id, value FROM smooth
  UNION ALL SELECT site_id, anchor_ts, rank, horizon, 'plantup_time', plantup_time FROM short_rows JOIN uptime USING (site_id, anchor_ts)
  UNION ALL SELECT site_id, anchor_ts, rank, horizon, 'plantup_switch', plantup_switch FROM short_rows JOIN uptime USING (site_id, anchor_ts)
  UNION ALL SELECT site_id, anchor_ts, rank, horizon, 'plantup_minutes', plantup_minutes FROM short_rows JOIN uptime USING (site_id, anchor_ts)),
computed AS (
  SELECT i.site_id, i.anchor_ts, i.rank, c.feature_id, any_value(i.plant_up) AS plant_up, any_value(i.tail_rows) AS tail_rows,
         avg(x.value) AS mean, max(x.value) AS peak,
         max(x.value) FILTER (o.pos = 0) AS p0, max(x.value) FILTER (o.pos = 1) AS p1,
         max(x.value) FILTER (o.pos = 2) AS p2, max(x.value) FILTER (o.pos = 3) AS p3
  FROM instants i JOIN cfg c ON (c.steps = 288) = (i.horizon = 'long')
  LEFT JOIN ops o ON o.feature_id = c.feature_id
  LEFT JOIN cells x ON x.site_id = i.site_id AND x.anchor_ts = i.anchor_ts AND x.rank = i.rank AND x.horizon = i.horizon AND x.tag_id = o.tag_id
  GROUP BY 1, 2, 3, 4),
valued AS (
  SELECT k.*, c.* EXCLUDE (feature_id), CASE
    WHEN fn IS NULL THEN p0 WHEN fn = 'mean' THEN mean WHEN fn = 'max' THEN peak
    WHEN fn = 'thickener_underflow_mass_rate' THEN coalesce(p0 * p1, p2 * p3) WHEN fn = 'moisture_target' THEN 35.0e0
    WHEN fn = 'greater' THEN CASE WHEN p0 >= threshold THEN 1 ELSE 0 END WHEN fn = 'passthrough' THEN p0 END AS v0
  FROM computed k JOIN cfg c ON k.feature_id = c.feature_id),
imputed AS (
  SELECT *, CASE WHEN plant_up = 1 THEN coalesce(v0, impute) ELSE v0 END AS v,
         CASE WHEN plant_up = 1 THEN coalesce(p1, impute) ELSE p1 END AS second FROM valued),
lagged AS (
  SELECT *, lag(v, lag) OVER w AS now_v, lag(second, lag) OVER w AS now_second, lag(v, lag_ahead) OVER w AS ahead_v
  FROM imputed WINDOW w AS (PARTITION BY site_id, anchor_ts, feature_id ORDER BY rank DESC)),
totals AS (
  SELECT site_id, anchor_ts, feature_id, any_value(now_agg) AS now_agg, any_value(ahead_agg) AS ahead_agg,
         any_value(threshold) AS threshold, any_value(null_limit) AS null_limit, any_value(is_condition) AS is_condition,
         avg(now_v) FILTER (rank <= coalesce(tail_rows, steps)) AS now_mean,
         arg_min(now_v, rank) FILTER (now_v IS NOT NULL AND rank <= coalesce(tail_rows, steps)) AS now_last,
         avg(now_v) FILTER (rank <= steps) AS first_mean, avg(now_second) FILTER (rank <= steps) AS second_mean,
         avg(ahead_v) FILTER (rank <= coalesce(tail_rows, steps)) AS ahead_mean,
         arg_min(ahead_v, rank) FILTER (ahead_v IS NOT NULL AND rank <= coalesce(tail_rows, steps)) AS ahead_last,
         avg(CASE WHEN v0 IS NULL AND fn IS DISTINCT FROM 'passthrough' THEN 1 ELSE 0 END) AS null_share
  FROM lagged GROUP BY 1, 2, 3),
points AS (SELECT site_id, anchor_ts, CAST(120 - rank AS DOUBLE) AS x, now_v AS v FROM lagged WHERE feature_id = 7 AND rank <= 120)
""" + TORQUE_TAIL.format(high=36, high_high=40) + """,
feature_values AS (
  SELECT t.site_id, t.anchor_ts, feature_id, is_condition,
    CASE now_agg WHEN 'mean' THEN now_mean WHEN 'last' THEN now_last WHEN 'ratio' THEN first_mean / nullif(second_mean, 0)
      WHEN 'mean_greater' THEN CASE WHEN now_mean >= threshold THEN 1 ELSE 0 END WHEN 'torque' THEN level END AS current,
    CASE ahead_agg WHEN 'mean' THEN ahead_mean WHEN 'last' THEN ahead_last END AS anticipated,
    null_share, coalesce(null_share > null_limit, false) AS too_many_nulls
  FROM totals t LEFT JOIN levels l ON l.site_id = t.site_id AND l.anchor_ts = t.anchor_ts)
"""


def _store(spark, sf):
    return store.compute_features(t.events(spark, sf), t.anchors(spark, sf), t.CONFIG)


@query("feature_store", "WITH " + SQL_STORE + """
SELECT site_id, anchor_ts, feature_id, round(current + 3e-11, 9) AS current, round(anticipated + 3e-11, 9) AS anticipated,
       round(null_share + 3e-11, 9) AS null_share, too_many_nulls FROM feature_values""")
def feature_store(spark, sf):
    rounded = {c: t.shown(c) for c in ("current", "anticipated", "null_share")}
    return t.plain(_store(spark, sf).withColumns(rounded).drop("current_list", "anticipated_list"), "anchor_ts")


# A list of five tags, one of them masked by run status and two not smoothed, lagged by five steps.
FIVE = ("view", "click", "purchase", "signup", "error")
LIST_FEATURE = Feature(21, FIVE, "passthrough", 5, 0.0, 0.5, "mean", "last", 60)
SQL_LIST = t.SQL_BASE + f""",
tags(pos, tag_id) AS (VALUES {", ".join(f"({i}, '{x}')" for i, x in enumerate(FIVE))}),
low AS (SELECT DISTINCT site_id, ts FROM telemetry WHERE tag_id = 'view' AND coalesce(value, 0) <= 8),
cleared AS (SELECT e.site_id, e.ts, e.tag_id, CASE WHEN low.ts IS NULL OR e.tag_id = 'error' THEN e.value END AS value
            FROM telemetry e LEFT JOIN low ON e.site_id = low.site_id AND e.ts = low.ts),
masked AS (SELECT e.site_id, e.ts, e.tag_id, CASE WHEN e.tag_id NOT IN ('purchase', 'signup') OR r.value = 1 THEN e.value END AS value
           FROM cleared e LEFT JOIN cleared r ON e.site_id = r.site_id AND e.ts = r.ts AND r.tag_id = 'error'),
series AS (
  SELECT a.site_id, a.anchor_ts, a.anchor_ts - to_hours(CAST(k AS INTEGER)) AS ts, k + 1 AS rank, pos, t.tag_id, m.value,
         p.ts IS NOT NULL AND low.ts IS NULL AS up
  FROM anchors a CROSS JOIN range(0, 121) r(k) CROSS JOIN tags t
  LEFT JOIN masked m ON m.site_id = a.site_id AND m.ts = a.anchor_ts - to_hours(CAST(k AS INTEGER)) AND m.tag_id = t.tag_id
  LEFT JOIN plant p ON p.site_id = a.site_id AND p.ts = a.anchor_ts - to_hours(CAST(k AS INTEGER))
  LEFT JOIN low ON low.site_id = a.site_id AND low.ts = a.anchor_ts - to_hours(CAST(k AS INTEGER))),
smooth AS (
  SELECT site_id, anchor_ts, rank, pos, up, CASE WHEN tag_id IN ('click', 'purchase', 'view') THEN {SQL_MEDIAN} ELSE value END AS raw
  FROM series {SQL_MEDIAN_WINDOW}),
imputed AS (SELECT *, CASE WHEN up THEN coalesce(raw, 0) ELSE raw END AS v FROM smooth)"""


@query("passthrough_lists", "WITH " + SQL_LIST + """
SELECT site_id, anchor_ts, pos, round(avg(v) FILTER (rank BETWEEN 6 AND 65) + 3e-11, 9) AS current,
       round(arg_min(v, rank) FILTER (v IS NOT NULL AND rank <= 60) + 3e-11, 9) AS anticipated
FROM imputed GROUP BY 1, 2, 3""")
def passthrough_lists(spark, sf):
    """All elements of a list feature, each smoothed, imputed, lagged and aggregated by itself."""
    found = store.compute_features(t.events(spark, sf), t.anchors(spark, sf), t.CONFIG.subset((LIST_FEATURE,)))
    rows = found.select("site_id", "anchor_ts", F.posexplode(F.arrays_zip("current_list", "anticipated_list")).alias("pos", "e"))
    shown = rows.select("site_id", "anchor_ts", "pos", t.shown("e.current_list").alias("current"), t.shown("e.anticipated_list").alias("anticipated"))
    return t.plain(shown, "anchor_ts")


@query("long_horizon_features", "WITH " + SQL_STORE + """
SELECT site_id, anchor_ts, feature_id, round(current + 3e-11, 9) AS current, round(anticipated + 3e-11, 9) AS anticipated
FROM feature_values WHERE feature_id IN (9, 10)""")
def long_horizon_features(spark, sf):
    cfg = t.CONFIG.subset(t.CONFIG.long_features)
    found = store.compute_features(t.events(spark, sf), t.anchors(spark, sf), cfg)
    return t.plain(found.select("site_id", "anchor_ts", "feature_id", t.shown("current").alias("current"),
                                t.shown("anticipated").alias("anticipated")), "anchor_ts")


@query("null_violations", "WITH " + SQL_STORE + """
SELECT site_id, anchor_ts, feature_id, round(null_share + 3e-11, 9) AS null_share, 'error' AS severity FROM feature_values WHERE too_many_nulls""")
def null_violations(spark, sf):
    return t.plain(quality.null_violations(_store(spark, sf)).withColumn("null_share", t.shown("null_share")), "anchor_ts")


SQL_GATE = """,
gate_in AS (
  SELECT f.site_id, f.anchor_ts, max(current) FILTER (feature_id = 11) AS up, max(current) FILTER (feature_id = 12) AS switched,
         max(current) FILTER (feature_id = 1) AS moisture, max(current) FILTER (feature_id = 4) AS target
  FROM feature_values f GROUP BY 1, 2),
gate AS (
  SELECT g.site_id, g.anchor_ts, CASE WHEN up IS DISTINCT FROM 1 OR coalesce(age < 43200, false) THEN 0 ELSE 1 END AS trigger,
         CASE WHEN up IS DISTINCT FROM 1 OR coalesce(age < 43200, false) THEN NULL
              ELSE coalesce(age < 129600, false) OR coalesce(switched = 1, false) OR coalesce(abs(moisture - target) > 1.5, false) END AS flag
  FROM (SELECT g.*, (epoch_us(g.anchor_ts) - epoch_us(c.ts)) / 1e6 AS age FROM gate_in g
        ASOF LEFT JOIN (SELECT site_id, ts FROM raw WHERE tag_id = 'purchase' AND value > 200) c
        ON g.site_id = c.site_id AND g.anchor_ts >= c.ts) g)
"""


@query("trigger_gate", "WITH " + SQL_STORE + SQL_GATE + "SELECT site_id, anchor_ts, trigger, flag FROM gate")
def trigger_gate(spark, sf):
    return t.plain(store.gate_anchors(
        t.events(spark, sf), t.changes(spark, sf), t.anchors(spark, sf), t.CONFIG, t.GATE_FEATURES, t.GATE_RULES), "anchor_ts")


def _run(spark, sf):
    return store.run(
        t.events(spark, sf), t.changes(spark, sf), t.anchors(spark, sf), t.CONFIG, t.GATE_FEATURES, t.GATE_RULES,
        materialise_gate=True, materialise_inputs=True,
    )


RESULTS_SQL = "WITH " + SQL_STORE + SQL_GATE + """,
one AS (
  SELECT f.*, flag FROM feature_values f JOIN gate g ON f.site_id = g.site_id AND f.anchor_ts = g.anchor_ts WHERE trigger = 1)
SELECT site_id, strftime(anchor_ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp", flag, 'rtfsOutput' AS "eventType", part,
       CAST(feature_id AS SMALLINT) AS id, round(value + 3e-11, 9) AS value FROM (
  SELECT *, 'current' AS part, current AS value FROM one WHERE NOT is_condition
  UNION ALL SELECT *, 'anticipated', anticipated FROM one WHERE NOT is_condition
  UNION ALL SELECT *, 'conditions', current FROM one WHERE is_condition)"""


def _record_rows(nested):
    """One row per record of an output event."""
    names = {"current": "currentFeatureRecords", "anticipated": "anticipatedFeatureRecords", "conditions": "plantConditions"}
    parts = F.array(*[F.struct(F.lit(n).alias("part"), F.col(c).alias("records")) for n, c in names.items()])
    rows = nested.select("site_id", "timestamp", "flag", "eventType", F.explode(parts).alias("p"))
    rows = rows.select("site_id", "timestamp", "flag", "eventType", "p.part", F.explode("p.records").alias("r"))
    return rows.select("site_id", "timestamp", "flag", "eventType", "part", "r.id", t.shown("r.value").alias("value"))


@query("results_nested", RESULTS_SQL)
def results_nested(spark, sf):
    return _record_rows(_run(spark, sf).results)


@query("results_json_parsed", RESULTS_SQL)
def results_json_parsed(spark, sf):
    """The output texts written to files, one JSON text per line, and read back."""
    path = scratch_path(spark, "results")
    sinks.write_result_text(results.result_json(_run(spark, sf).results, with_site=True), path)
    return _record_rows(results.read_result_text(spark, path))


#: The demonstration configuration as configuration files; every tag has an equipment of its own, so none depends on a run tag.
NEWEST_STORE = ("WITH " + SQL_STORE).replace("""anchors AS (
  SELECT DISTINCT site_id, ts AS anchor_ts FROM telemetry
  WHERE ts = date_trunc('day', ts)
)""", "anchors AS (SELECT site_id, max(ts) AS anchor_ts FROM plant GROUP BY site_id HAVING count(*) > 1)").replace(
    "CASE WHEN e.tag_id NOT IN ('purchase', 'signup') OR r.value = 1 THEN e.value END AS value", "e.value")
KEYS = {"area": "a", "line": "l", "measure": "m", "position": "p"}


def _config_files(spark, sf, folder):
    """Tags from the events table, features and plant parameters from the demonstration configuration, as JSON files."""
    features = [
        {
            "id": f.id, "equipment": ", ".join(x.upper() for x in f.tags), "function": f.function, "lag": f.lag, "nullImpute": f.null_impute,
            "nullThreshold": f.null_threshold, "currentTimeAggregation": f.current, "anticipatedTimeAggregation": f.anticipated,
            "timeAggregationMinutes": f.steps, "customInput": ",".join(f.custom) or None, "plantCondition": str(f.condition).lower(), **KEYS,
        }
        for f in t.FEATURES
    ]
    spark.createDataFrame([(json.dumps({"features": features}),)], "value string").coalesce(1).write.text(f"{folder}/features")
    numeric, critical = F.col("event_type").isin(*t.SMOOTHED), F.col("event_type") == "error"
    names = t.table(spark, sf, "events").select("event_type").distinct()
    tags = names.select(F.struct(
        F.col("event_type").alias("enterpriseId"), F.when(numeric, "numeric").otherwise("discrete").alias("tagType"),
        F.when(critical, "Critical Run Status").otherwise("Normal").alias("criticality"), F.concat(F.lit(" "), F.col("event_type")).alias("equipment"),
        *[F.lit(v).alias(k) for k, v in KEYS.items()]).alias("tag"))
    whole = tags.agg(F.array(F.struct(F.sort_array(F.collect_list("tag")).alias("tags"))).alias("sites"))
    whole.select(F.to_json(F.struct("sites")).alias("value")).coalesce(1).write.text(f"{folder}/tags")
    plant = {
        "trigger_features": list(t.CONFIG.trigger_features), "plantup_time": 11, "plantup_switch": 12, "plantup_minutes": 13, "moisture_feature": 1,
        "moisture_target_feature": 4, "moisture_target": t.CONFIG.moisture_target, "skip_low_pass": [], "optimal_tag": "view", "optimal_threshold": 8.0,
    }
    spark.createDataFrame([(json.dumps(plant),)], "value string").coalesce(1).write.text(f"{folder}/plant")


def file_inputs(folder, events):
    grid = {k: getattr(t.CONFIG, k) for k in ("step_seconds", "long_slice_steps", "long_steps", "trend_high", "trend_high_high")}
    return files.Inputs(events, f"{folder}/features", f"{folder}/tags", f"{folder}/plant", F.col("criticality") == "Critical Run Status", rules=t.GATE_RULES, grid=grid)


@query("files_to_output", RESULTS_SQL.replace("WITH " + SQL_STORE, NEWEST_STORE))
def files_to_output(spark, sf):
    """From JSON files of configuration and events, copies and broken lines among them, to lines of results, in one run."""
    folder, out = scratch_path(spark, "configured"), scratch_path(spark, "lines")
    _config_files(spark, sf, folder)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    sequence = F.concat_ws("-", F.col("site_id").cast("string"), F.unix_seconds("ts").cast("string"))
    nested = t.events(spark, sf).select("site_id", stamp.alias("timestamp"), F.lit("eventtype1").alias("eventtype"), "plant_up", sequence.alias("sequenceID"), "records")
    changes = t.changes(spark, sf).select("site_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"), F.lit("eventtype2").alias("eventtype"))
    text = F.to_json(F.struct("*"))
    lines = nested.select(text.alias("value"))
    every = lines.unionByName(changes.select(text.alias("value"))).unionByName(lines.where("crc32(value) % 5 = 0")).unionByName(
        lines.where("crc32(value) % 7 = 0").select(F.substring("value", 1, 50).alias("value")))
    every.write.text(f"{folder}/events")
    files.run_files(spark, file_inputs(folder, f"{folder}/events"), out, scratch_path(spark, "rejected"))
    return _record_rows(results.read_result_text(spark, out))


@query("results_json")
def results_json(spark, sf):
    return t.plain(results.result_json(_run(spark, sf).results), "anchor_ts")

"""Time parsing, date windows, anchor slices, as-of lookups and gap-free history."""

from pyspark.sql import functions as F

from catalogue import tables as t
from catalogue.registry import query
from millrace.functions import times
from millrace.operators import dedup, filters, history, joins


@query("timestamp_roundtrip", """
SELECT event_id, ts AS parsed, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS shown, date_trunc('second', ts) AS parsed_short,
       CAST(NULL AS TIMESTAMP) AS parsed_bad FROM events""")
def timestamp_roundtrip(spark, sf):
    shown = times.format_event_time(F.col("ts"))
    short = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    raw = t.raw_events(spark, sf).select("event_id", shown.alias("shown"), short.alias("short"))
    return t.plain(raw.select(
        "event_id", times.parse_event_time(F.col("shown")).alias("parsed"), "shown",
        times.parse_event_time(F.col("short")).alias("parsed_short"),
        times.parse_event_time(F.concat(F.lit("x"), "shown")).alias("parsed_bad"),
    ), "parsed", "parsed_short", "parsed_bad")


@query("time_distance", f"""WITH {t.SQL_RAW}
SELECT event_id, abs(epoch_us(ts) - epoch_us(previous)) <= 60000000 AS near FROM (
  SELECT event_id, ts, date_trunc('hour', ts) AS previous FROM raw)""")
def time_distance(spark, sf):
    raw = t.raw_events(spark, sf)
    return raw.select("event_id", times.within_seconds(F.col("ts"), F.date_trunc("hour", "ts"), 60).alias("near"))


AS_OF = "1999-06-15"


def _window_sql(where):
    return f"SELECT o_orderkey, o_orderdate FROM orders {where}"


def _orders(spark, sf):
    return t.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")


@query("date_window_full", _window_sql(""))
def date_window_full(spark, sf):
    return filters.date_window(_orders(spark, sf), "full", F.lit(AS_OF), "o_orderdate")


@query("date_window_overwrite", _window_sql(f"WHERE o_orderdate BETWEEN DATE '{AS_OF}' - 1855 AND DATE '{AS_OF}'"))
def date_window_overwrite(spark, sf):
    return filters.date_window(_orders(spark, sf), "overwrite", F.lit(AS_OF), "o_orderdate")


@query("date_window_incremental", _window_sql(f"WHERE o_orderdate BETWEEN DATE '{AS_OF}' - 15 AND DATE '{AS_OF}'"))
def date_window_incremental(spark, sf):
    return filters.date_window(_orders(spark, sf), "incremental", F.lit(AS_OF), "o_orderdate")


@query("load_selection", _window_sql(""))
def load_selection(spark, sf):
    return filters.load_selection(_orders(spark, sf), "a_table_never_written", F.lit(AS_OF), "o_orderdate")


@query("load_selection_incremental", _window_sql(f"WHERE o_orderdate BETWEEN DATE '{AS_OF}' - 15 AND DATE '{AS_OF}'"))
def load_selection_incremental(spark, sf):
    """The target exists, so only the recent window is loaded."""
    _orders(spark, sf).createOrReplaceTempView("loaded_orders")
    return filters.load_selection(_orders(spark, sf), "loaded_orders", F.lit(AS_OF), "o_orderdate")


@query("anchor_slice", f"""WITH {t.SQL_BASE}
SELECT r.site_id, a.anchor_ts, r.event_id, r.ts, r.tag_id FROM raw r JOIN anchors a
  ON r.site_id = a.site_id AND r.ts >= a.anchor_ts - INTERVAL 30 HOUR AND r.ts < a.anchor_ts""")
def anchor_slice(spark, sf):
    raw = t.raw_events(spark, sf).select("site_id", "event_id", "ts", "tag_id")
    sliced = joins.anchor_slice(raw, t.anchors(spark, sf), times.Grid(t.STEP).span(30), include_anchor=False)
    return t.plain(sliced, "ts", "anchor_ts")


@query("anchor_rows", t.with_base(
    "SELECT a.site_id, a.anchor_ts, e.tag_id, e.value FROM anchors a JOIN telemetry e ON e.site_id = a.site_id AND e.ts = a.anchor_ts"))
def anchor_rows(spark, sf):
    tele = t.telemetry(spark, sf).select("site_id", F.col("ts").alias("anchor_ts"), "tag_id", "value")
    return t.plain(tele.join(t.anchors(spark, sf), history.ANCHOR, "left_semi"), "anchor_ts")


@query("event_asof", t.with_base(f"""
SELECT a.site_id, a.anchor_ts, c.ts AS found_ts, c.value AS change_value,
       coalesce(abs(epoch_us(a.anchor_ts) - epoch_us(c.ts)) <= {36 * 3600} * 1000000::BIGINT, false) AS recent
FROM anchors a ASOF LEFT JOIN (SELECT site_id, ts, value FROM raw WHERE tag_id = 'purchase' AND value > 200) c
  ON a.site_id = c.site_id AND a.anchor_ts >= c.ts"""))
def event_asof(spark, sf):
    found = joins.latest_before(
        t.changes(spark, sf), t.anchors(spark, sf), F.col("value"), "change_value", times.Grid(t.STEP).span(36)
    )
    near = times.within_seconds(F.col("anchor_ts"), F.col("found_ts"), 36 * 3600)
    return t.plain(found.withColumn("recent", F.coalesce(near, F.lit(False))), "anchor_ts", "found_ts")


@query("densified_history", t.with_dense(
    "SELECT site_id, anchor_ts, ts, back, tag_id, value, plant_up FROM dense"))
def densified_history(spark, sf):
    return t.plain(t.dense_cells(spark, sf, 150), "ts", "anchor_ts")


UPTIME_SQL = """
uptime AS (
  SELECT site_id, anchor_ts,
    CASE WHEN coalesce(avg(plant_up) FILTER (back BETWEEN 1 AND 60), 0) > 0.8
          AND coalesce(avg(plant_up) FILTER (back BETWEEN 61 AND 120), 0) > 0.8 THEN 1 ELSE 0 END AS plantup_time,
    CASE WHEN coalesce(avg(plant_up) FILTER (back BETWEEN 121 AND 150), 0) < 0.2 THEN 1 ELSE 0 END AS plantup_switch,
    CAST(coalesce(sum(plant_up) FILTER (back BETWEEN 1 AND 60), 0) AS BIGINT) AS plantup_minutes
  FROM {source} GROUP BY site_id, anchor_ts
)"""


@query("plant_uptime", t.with_dense(", " + UPTIME_SQL.format(source="(SELECT DISTINCT site_id, anchor_ts, back, plant_up FROM dense)") + """
SELECT site_id, anchor_ts, plantup_time, plantup_switch, plantup_minutes FROM uptime"""))
def plant_uptime(spark, sf):
    cfg = t.CONFIG
    rows = history.plant_conditions(
        t.dense(spark, sf), cfg.hour_steps, cfg.slice_steps, cfg.switch_steps, cfg.up_share, cfg.switch_share
    )
    return t.plain(rows.where("back = 0").select("site_id", "anchor_ts", *history.PLANT_SERIES), "anchor_ts")


@query("history_warnings", t.with_dense("""
, steps AS (SELECT DISTINCT site_id, anchor_ts, back, plant_up, present FROM dense WHERE back > 0),
shares AS (
  SELECT site_id, anchor_ts, count(*) FILTER (NOT present) AS missing_steps, count(*) FILTER (present) AS held,
         avg(plant_up) FILTER (back <= 60) AS up1, avg(plant_up) FILTER (back BETWEEN 61 AND 120) AS up2
  FROM steps GROUP BY 1, 2),
dups AS (
  SELECT site_id, CAST(sum(c - 1) AS BIGINT) AS duplicate_rows FROM (
    SELECT site_id, date_trunc('hour', ts) AS h, tag_id, count(*) AS c FROM raw GROUP BY 1, 2, 3 HAVING count(*) > 1)
  GROUP BY 1)
SELECT s.site_id, anchor_ts, coalesce(duplicate_rows, 0) AS duplicate_rows, missing_steps, held = 0 AS no_history,
       missing_steps > 0 AND held > 0 AS has_gaps, round(up1 + 3e-11, 9) AS up_last_hour, round(up2 + 3e-11, 9) AS up_hour_before,
       up1 <= 0.8 AS low_last_hour, up2 <= 0.8 AS low_hour_before
FROM shares s LEFT JOIN dups d ON s.site_id = d.site_id"""))
def history_warnings(spark, sf):
    raw = t.raw_events(spark, sf).withColumn("ts", F.date_trunc("hour", "ts"))
    copies = dedup.duplicate_counts(raw, ["site_id", "ts", "tag_id"])
    report = history.history_warnings(t.dense(spark, sf), copies, t.anchors(spark, sf), t.CONFIG.hour_steps, t.CONFIG.up_share)
    return t.plain(report.withColumns({c: t.shown(c) for c in ("up_last_hour", "up_hour_before")}), "anchor_ts")

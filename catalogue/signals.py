"""Smoothing, lags, tail aggregation, ratio, interpolation and trend."""

from pyspark.sql import functions as F

from catalogue import tables as t
from catalogue.registry import query
from millrace.functions.scalar import at_least_flag, ratio_or_null
from millrace.functions.times import Grid
from millrace.operators import signals, trend

GRID = Grid(t.STEP)
SERIES = ["site_id", "anchor_ts", "tag_id"]
SQL_MEDIAN = """CASE WHEN count(value) OVER w >= 7 THEN median(value) OVER w END"""
SQL_MEDIAN_WINDOW = """WINDOW w AS (PARTITION BY site_id, anchor_ts, tag_id ORDER BY ts
                       RANGE BETWEEN INTERVAL 26999999999 MICROSECOND PRECEDING AND INTERVAL 27000 SECOND FOLLOWING)"""


@query("low_pass", t.with_dense(f"""
SELECT site_id, anchor_ts, ts, tag_id,
       round(CASE WHEN tag_id IN ('click', 'purchase', 'view') THEN {SQL_MEDIAN} ELSE value END + 3e-11, 9) AS value
FROM dense WHERE back <= 120 {SQL_MEDIAN_WINDOW}"""))
def low_pass(spark, sf):
    cells = t.dense_cells(spark, sf)
    smooth = signals.low_pass(cells, SERIES, F.col("tag_id").isin(*t.SMOOTHED), GRID)
    return t.plain(smooth.select("site_id", "anchor_ts", "ts", "tag_id", t.shown("value").alias("value")), "ts", "anchor_ts")


LAGS = {"click": 30, "error": 61, "purchase": None, "signup": -10, "view": 100}


def _lag_table(spark):
    rows = ", ".join(f"('{k}', {'CAST(NULL AS INT)' if v is None else v})" for k, v in LAGS.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS l(tag_id, lag)")


def _lag_sql(expr):
    rows = ", ".join(f"('{k}', {'NULL' if v is None else v})" for k, v in LAGS.items())
    return t.with_dense(f""", lags(tag_id, lag) AS (VALUES {rows}),
    a AS (SELECT d.*, {expr} AS n FROM dense d JOIN lags USING (tag_id) WHERE back <= 120)
    SELECT site_id, anchor_ts, ts, tag_id,
           CASE WHEN n >= 0 THEN lag(value, n) OVER w ELSE lead(value, -n) OVER w END AS value
    FROM a WINDOW w AS (PARTITION BY site_id, anchor_ts, tag_id ORDER BY ts)""")


def _shifted(spark, sf, amount):
    cells = t.dense_cells(spark, sf).join(_lag_table(spark), "tag_id")
    return signals.shift_rows(cells, SERIES, "ts", amount(F.col("lag")), sorted({amount_of(amount, v) for v in LAGS.values()}))


def amount_of(amount, lag):
    """The same rule on the driver, for the few configured lags."""
    if amount is current_lag:
        return lag or 0
    return lag - 60 if lag is not None and lag > 60 else 0


def current_lag(lag):
    return F.coalesce(lag, F.lit(0))


def anticipated_lag(lag):
    return F.when(lag > 60, lag - 60).otherwise(0)


@query("lag_current", _lag_sql("coalesce(lag, 0)"))
def lag_current(spark, sf):
    return t.plain(_shifted(spark, sf, current_lag).select("site_id", "anchor_ts", "ts", "tag_id", "value"), "ts", "anchor_ts")


@query("lag_anticipated", _lag_sql("CASE WHEN lag > 60 THEN lag - 60 ELSE 0 END"))
def lag_anticipated(spark, sf):
    return t.plain(_shifted(spark, sf, anticipated_lag).select("site_id", "anchor_ts", "ts", "tag_id", "value"), "ts", "anchor_ts")


def _recent():
    return F.col("back") < 60


def _tail(spark, sf, **aggregates):
    cells = t.dense_cells(spark, sf)
    return t.plain(cells.groupBy(*SERIES).agg(*[c.alias(n) for n, c in aggregates.items()]), "anchor_ts")


@query("tail_mean", t.with_dense("""
SELECT site_id, anchor_ts, tag_id, round(avg(value) FILTER (ts > anchor_ts - INTERVAL 60 HOUR) + 3e-11, 9) AS value
FROM dense WHERE back <= 120 GROUP BY ALL"""))
def tail_mean(spark, sf):
    return _tail(spark, sf, value=t.shown(F.avg(F.when(_recent(), F.col("value")))))


@query("tail_last", t.with_dense("""
SELECT site_id, anchor_ts, tag_id,
       arg_max(value, ts) FILTER (value IS NOT NULL AND ts > anchor_ts - INTERVAL 60 HOUR) AS value
FROM dense WHERE back <= 120 GROUP BY ALL"""))
def tail_last(spark, sf):
    return _tail(spark, sf, value=F.max_by("value", F.when(_recent() & F.col("value").isNotNull(), F.col("ts"))))


@query("tail_mean_greater", t.with_dense("""
SELECT site_id, anchor_ts, tag_id, CASE WHEN avg(value) FILTER (back < 60) >= 50 THEN 1 ELSE 0 END AS value
FROM dense WHERE back <= 120 GROUP BY ALL"""))
def tail_mean_greater(spark, sf):
    return _tail(spark, sf, value=at_least_flag(F.avg(F.when(_recent(), F.col("value"))), F.lit("50.9").try_cast("double").cast("bigint")))


@query("ratio", t.with_dense("""
, newest AS (
  SELECT site_id, anchor_ts, tag_id, value, row_number() OVER (PARTITION BY site_id, anchor_ts, tag_id ORDER BY ts DESC) AS rn
  FROM dense WHERE back <= 120)
SELECT site_id, anchor_ts, round(avg(value) FILTER (tag_id = 'click')
       / nullif(avg(value) FILTER (tag_id = 'error'), 0) + 3e-11, 9) AS ratio
FROM newest WHERE rn <= 45 GROUP BY 1, 2"""))
def ratio(spark, sf):
    newest = signals.last_rows(t.dense_cells(spark, sf), SERIES, "ts", 45)
    tag, value = F.col("tag_id"), F.col("value")
    quotient = ratio_or_null(F.avg(F.when(tag == "click", value)), F.avg(F.when(tag == "error", value)))
    return t.plain(newest.groupBy("site_id", "anchor_ts").agg(t.shown(quotient).alias("ratio")), "anchor_ts")


@query("interpolate", t.with_dense("""
, sided AS (
  SELECT *, last_value(CASE WHEN value IS NOT NULL THEN back END IGNORE NULLS) OVER past AS lb,
         last_value(value IGNORE NULLS) OVER past AS lv,
         first_value(CASE WHEN value IS NOT NULL THEN back END IGNORE NULLS) OVER future AS rb,
         first_value(value IGNORE NULLS) OVER future AS rv
  FROM dense WHERE back <= 120
  WINDOW past AS (PARTITION BY site_id, anchor_ts, tag_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         future AS (PARTITION BY site_id, anchor_ts, tag_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT site_id, anchor_ts, ts, tag_id, round(CASE WHEN value IS NOT NULL THEN value WHEN lv IS NULL THEN NULL
       WHEN rv IS NULL THEN lv ELSE lv + (rv - lv) * (lb - back) / (lb - rb) END + 3e-11, 9) AS value
FROM sided"""))
def interpolate(spark, sf):
    cells = t.dense_cells(spark, sf).withColumn("x", -F.col("back"))
    filled = signals.interpolate(cells, SERIES, "x", "value")
    return t.plain(filled.select("site_id", "anchor_ts", "ts", "tag_id", t.shown("value").alias("value")), "ts", "anchor_ts")


@query("regular_means", f"""WITH {t.SQL_RAW},
m AS (SELECT site_id, date_trunc('hour', ts) AS ts, avg(value) AS v FROM raw GROUP BY 1, 2),
span AS (SELECT site_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM m GROUP BY site_id)
SELECT s.site_id, s.ts, round(v, 8) AS value FROM span s LEFT JOIN m ON s.site_id = m.site_id AND s.ts = m.ts""")
def regular_means(spark, sf):
    regular = signals.regularise(t.raw_events(spark, sf), ["site_id"], GRID)
    return t.plain(regular.select("site_id", "ts", F.round("value", 8).alias("value")), "ts")


TORQUE_TAIL = """
, sided AS (
  SELECT *, last_value(CASE WHEN v IS NOT NULL THEN x END IGNORE NULLS) OVER past AS lx,
         last_value(v IGNORE NULLS) OVER past AS lv,
         first_value(CASE WHEN v IS NOT NULL THEN x END IGNORE NULLS) OVER future AS rx,
         first_value(v IGNORE NULLS) OVER future AS rv
  FROM points
  WINDOW past AS (PARTITION BY site_id, anchor_ts ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         future AS (PARTITION BY site_id, anchor_ts ORDER BY x ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (
  SELECT site_id, anchor_ts, x, v, CASE WHEN v IS NOT NULL THEN v WHEN lv IS NULL THEN NULL WHEN rv IS NULL THEN lv
         ELSE lv + (rv - lv) * (x - lx) / (rx - lx) END AS y FROM sided),
fit AS (
  SELECT site_id, anchor_ts, count(v) AS seen, count(y) AS n, avg(y) AS m, regr_intercept(y, x) AS a, regr_slope(y, x) AS b,
         (regr_syy(y, x) - regr_sxy(y, x) * regr_sxy(y, x) / regr_sxx(y, x)) / 118 AS s2
  FROM filled GROUP BY 1, 2),
bounds AS (
  SELECT *, a + 180 * b - 1.9802722 * sqrt(greatest(s2, 0) * (1 + 1.0/120 + 120.5 * 120.5 / 143990)) AS lo,
            a + 180 * b + 1.9802722 * sqrt(greatest(s2, 0) * (1 + 1.0/120 + 120.5 * 120.5 / 143990)) AS hi FROM fit),
levels AS (
  SELECT site_id, anchor_ts, CAST(CASE
    WHEN seen < 96 OR m IS NULL THEN NULL WHEN m < {high} THEN 0
    WHEN m < {high_high} THEN CASE WHEN n = 120 AND lo >= m THEN 1 ELSE 0 END
    ELSE CASE WHEN n = 120 AND NOT lo >= m AND hi <= m THEN 1 ELSE 2 END END AS DOUBLE) AS level
  FROM bounds)
"""


@query("torque_level", t.with_dense("""
, means AS (SELECT site_id, anchor_ts, back, avg(value) FILTER (tag_id <> 'error') AS v FROM dense WHERE back < 120 GROUP BY 1, 2, 3),
points AS (SELECT site_id, anchor_ts, CAST(119 - back AS DOUBLE) AS x, v FROM means)
""" + TORQUE_TAIL.format(high=48, high_high=52) + "SELECT site_id, anchor_ts, level FROM levels"))
def torque_level(spark, sf):
    cells = t.dense_cells(spark, sf, 119).where("tag_id <> 'error'")
    means = cells.groupBy("site_id", "anchor_ts", (F.lit(119) - F.col("back")).alias("x")).agg(F.avg("value").alias("value"))
    anchors = means.select("site_id", "anchor_ts").distinct()
    levels = trend.trend_levels(means, ["site_id", "anchor_ts"], "x", "value", trend.TrendLimits(48.0, 52.0))
    return t.plain(anchors.join(levels, ["site_id", "anchor_ts"], "left"), "anchor_ts")

"""Projection, rename, reshape, scope and duplicate queries."""

from pyspark.sql import functions as F

from catalogue import tables as t
from catalogue.registry import query
from millrace.functions.scalar import list_item, list_max, list_mean, impute_list_when_up
from millrace.operators import dedup, filters, optimal, reshape


@query("telemetry_explode", t.with_base(
    "SELECT site_id, ts, plant_up, tag_id, value FROM telemetry JOIN plant USING (site_id, ts)"))
def telemetry_explode(spark, sf):
    return t.plain(optimal.records_to_long(t.events(spark, sf)), "ts")


@query("records_nested", t.with_base("""
SELECT site_id, ts, string_agg(tag_id || '=' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), ';' ORDER BY tag_id) AS readings
FROM telemetry GROUP BY site_id, ts"""))
def records_nested(spark, sf):
    shown = F.transform("records", lambda r: F.concat(r["id"], F.lit("="), F.round(r["value"] * 100).cast("bigint").cast("string")))
    return t.plain(t.nested(spark, sf).select("site_id", "ts", F.array_join(shown, ";").alias("readings")), "ts")


PIVOT = ", ".join(f"max(CASE WHEN tag_id = '{x}' THEN value END) AS {x}" for x in t.TAGS)


@query("tag_pivot", t.with_base(f"SELECT site_id, ts, {PIVOT} FROM telemetry GROUP BY site_id, ts"))
def tag_pivot(spark, sf):
    return t.plain(reshape.pivot_tags(t.telemetry(spark, sf), ["site_id", "ts"], t.TAGS), "ts")


@query("feature_unpivot", t.with_base(f"""
, wide AS (SELECT site_id, ts, {PIVOT} FROM telemetry GROUP BY site_id, ts)
""" + " UNION ALL ".join(f"SELECT site_id, ts, '{x}' AS id, {x} AS value FROM wide" for x in t.TAGS)))
def feature_unpivot(spark, sf):
    wide = reshape.pivot_tags(t.telemetry(spark, sf), ["site_id", "ts"], t.TAGS)
    return t.plain(reshape.melt(wide, ["site_id", "ts"], t.TAGS), "ts")


@query("prefix_rename", """
SELECT l_orderkey AS "TEST_SAMPLE_ID", l_linenumber AS "TEST_line", l_discount AS "TEST_l_discount",
       l_quantity AS "TEST_l_quantity", l_tax AS "TEST_l_tax" FROM lineitem""")
def prefix_rename(spark, sf):
    li = reshape.keep_present(
        t.table(spark, sf, "lineitem"), ["l_tax", "l_quantity", "no_such_column", "l_orderkey", "l_linenumber", "l_discount"]
    )
    named = reshape.prefix_columns(li, ["l_quantity", "l_discount", "l_tax", "absent"], "TEST")
    return reshape.sorted_columns(reshape.rename(named, {"l_orderkey": "TEST_SAMPLE_ID", "l_linenumber": "TEST_line"}))


@query("stacked_rows", t.with_base("""
SELECT site_id, ts, tag_id, value FROM telemetry
UNION ALL SELECT site_id, ts, 'constant' AS tag_id, 35.0e0 AS value FROM plant"""))
def stacked_rows(spark, sf):
    tele = t.telemetry(spark, sf)
    readings = tele.select("site_id", "ts", "tag_id", "value")
    constant = tele.select("ts", "site_id").distinct().withColumns({"value": F.lit(35.0), "tag_id": F.lit("constant")})
    return t.plain(reshape.stack_rows(readings, constant), "ts")


@query("list_functions", """
SELECT vec_id, label, round(list_avg(e), 8) AS mean, list_max(e) AS peak, CAST(e[1] AS DOUBLE) AS first_item,
       CAST(e[2000] AS DOUBLE) AS beyond, len(e) AS n_items
FROM (SELECT vec_id, label, list_transform(embedding, lambda x: CASE WHEN x < 0 THEN NULL ELSE CAST(x AS DOUBLE) END) AS e
      FROM embeddings)""")
def list_functions(spark, sf):
    items = F.transform("embedding", lambda x: F.when(x >= 0, x.cast("double")))
    e = t.table(spark, sf, "embeddings").select("vec_id", "label", items.alias("e"))
    return e.select(
        "vec_id", "label", F.round(list_mean(F.col("e")), 8).alias("mean"), list_max(F.col("e")).alias("peak"),
        list_item(F.col("e"), 0).alias("first_item"), list_item(F.col("e"), 1999).alias("beyond"),
        F.size("e").cast("bigint").alias("n_items"),
    )


@query("null_impute_list", """
SELECT vec_id, round(list_sum(e), 6) AS total, len(list_filter(e, lambda x: x IS NULL)) AS nulls_left
FROM (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x < 0 THEN CASE WHEN label % 2 = 1 THEN 0.25e0 END
                                                         ELSE CAST(x AS DOUBLE) END) AS e FROM embeddings)""")
def null_impute_list(spark, sf):
    e = t.table(spark, sf, "embeddings")
    items = F.transform("embedding", lambda x: F.when(x >= 0, x.cast("double")))
    filled = e.select("vec_id", impute_list_when_up(items, F.col("label") % 2, F.lit(0.25)).alias("e"))
    held = F.filter("e", lambda x: x.isNotNull())
    return filled.select(
        "vec_id",
        F.round(F.aggregate(held, F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
        (F.size("e") - F.size(held)).cast("bigint").alias("nulls_left"),
    )


@query("tags_in_scope", t.with_base(
    "SELECT site_id, ts, tag_id, value FROM telemetry WHERE tag_id IN (SELECT event_type FROM events GROUP BY 1 HAVING avg(value) > 50)"))
def tags_in_scope(spark, sf):
    return t.plain(filters.in_scope(t.telemetry(spark, sf), _busy_tags(spark, sf)).select("site_id", "ts", "tag_id", "value"), "ts")


@query("tags_out_of_scope", t.with_base(
    "SELECT site_id, ts, tag_id, value FROM telemetry WHERE tag_id NOT IN (SELECT event_type FROM events GROUP BY 1 HAVING avg(value) > 50)"))
def tags_out_of_scope(spark, sf):
    return t.plain(filters.out_of_scope(t.telemetry(spark, sf), _busy_tags(spark, sf)).select("site_id", "ts", "tag_id", "value"), "ts")


def _busy_tags(spark, sf):
    return t.raw_events(spark, sf).groupBy("tag_id").agg(F.avg("value").alias("m")).where("m > 50").select("tag_id")


@query("predicate_split", """
SELECT returned, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM (
  SELECT CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'run' ELSE 'other' END AS returned, l_quantity
  FROM lineitem WHERE (l_returnflag = 'R' AND l_linestatus = 'F') IS NOT NULL) GROUP BY 1""")
def predicate_split(spark, sf):
    li = t.table(spark, sf, "lineitem")
    yes, no = filters.split_by(li, (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
    both = yes.select(F.lit("run").alias("returned"), "l_quantity").unionByName(no.select(F.lit("other").alias("returned"), "l_quantity"))
    return both.groupBy("returned").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("dedup_latest", f"""WITH {t.SQL_RAW}
SELECT site_id, ts, tag_id, value, event_id FROM (
  SELECT site_id, date_trunc('hour', ts) AS ts, tag_id, value, event_id,
         row_number() OVER (PARTITION BY site_id, date_trunc('hour', ts), tag_id ORDER BY event_id DESC) AS rn FROM raw)
WHERE rn = 1""")
def dedup_latest(spark, sf):
    raw = t.raw_events(spark, sf).withColumn("ts", F.date_trunc("hour", "ts"))
    return t.plain(dedup.survivor_per_key(raw, ["site_id", "ts", "tag_id"], F.col("event_id")), "ts")


@query("duplicate_report", f"""WITH {t.SQL_RAW}
SELECT site_id, date_trunc('hour', ts) AS ts, tag_id, count(*) - 1 AS surplus FROM raw GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def duplicate_report(spark, sf):
    raw = t.raw_events(spark, sf).withColumn("ts", F.date_trunc("hour", "ts"))
    return t.plain(dedup.duplicate_counts(raw, ["site_id", "ts", "tag_id"]), "ts")


@query("newest_split", t.with_base("""
SELECT site_id, ts, plant_up, CASE WHEN ts = max(ts) OVER (PARTITION BY site_id) THEN 'trigger' ELSE 'history' END AS part FROM plant"""))
def newest_split(spark, sf):
    newest, rest = dedup.newest_and_rest(t.events(spark, sf).select("site_id", "ts", "plant_up"))
    return t.plain(newest.withColumn("part", F.lit("trigger")).unionByName(rest.withColumn("part", F.lit("history"))), "ts")


@query("optimal_state", t.with_base("""
, low AS (SELECT DISTINCT site_id, ts FROM telemetry WHERE tag_id = 'view' AND coalesce(value, 0) <= 8)
SELECT e.site_id, e.ts, CASE WHEN low.ts IS NULL THEN 1 ELSE 0 END AS plant_up, e.tag_id,
       CASE WHEN low.ts IS NULL OR e.tag_id = 'error' THEN e.value END AS value
FROM telemetry e LEFT JOIN low ON e.site_id = low.site_id AND e.ts = low.ts"""))
def optimal_state(spark, sf):
    cfg = t.CONFIG
    state = optimal.optimal_state(t.events(spark, sf), cfg.optimal_tag, cfg.optimal_threshold, cfg.critical_tags)
    return t.plain(optimal.records_to_long(state), "ts")


RUN_MASK = t.with_base("""
SELECT e.site_id, e.ts, e.tag_id,
       CASE WHEN e.tag_id NOT IN ('purchase', 'signup') OR r.value = 1 THEN e.value END AS value
FROM telemetry e LEFT JOIN telemetry r ON e.site_id = r.site_id AND e.ts = r.ts AND r.tag_id = 'error'""")


@query("run_status_mask", RUN_MASK)
def run_status_mask(spark, sf):
    masked = optimal.mask_stopped_equipment(t.events(spark, sf), t.RUN_TAGS_OF)
    return t.plain(optimal.records_to_long(masked, ["site_id", "ts"]), "ts")


@query("run_status_mask_long", RUN_MASK)
def run_status_mask_long(spark, sf):
    pairs = spark.sql("SELECT * FROM VALUES ('purchase', 'error'), ('signup', 'error') AS m(tag_id, run_tag)")
    tele = t.telemetry(spark, sf).select("site_id", "ts", "tag_id", "value")
    return t.plain(optimal.mask_stopped_equipment_long(tele, pairs), "ts")

"""Readers, the event log, sinks, quarantine and synthetic events."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue import tables as t
from catalogue.registry import query
from millrace.operators import optimal, quality
from millrace.plans import synthetic
from millrace.session import scratch_path
from millrace.sources import compaction
from millrace.sources import events as src
from millrace.sources import sinks

EVENTS_SQL = t.with_base("SELECT site_id, ts, plant_up, tag_id, value FROM telemetry JOIN plant USING (site_id, ts)")
TEXT_TIME = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def as_messages(spark, sf):
    """Nested events with text times, as a producer would send them; even hours are change events."""
    kind = F.when(F.hour("ts") % 2 == 0, "eventtype2").otherwise("eventtype1")
    sequence = F.concat_ws("-", F.col("site_id").cast("string"), F.unix_seconds("ts").cast("string"))
    return t.events(spark, sf).select(
        "site_id", F.date_format("ts", TEXT_TIME).alias("timestamp"), kind.alias("eventtype"), "plant_up",
        sequence.alias("sequenceID"), "records",
    )


@query("json_roundtrip", EVENTS_SQL)
def json_roundtrip(spark, sf):
    path = scratch_path(spark, "json")
    as_messages(spark, sf).write.json(path)
    return t.plain(optimal.records_to_long(src.read_json_events(spark, path)), "ts")


@query("message_parse", EVENTS_SQL)
def message_parse(spark, sf):
    messages = as_messages(spark, sf)
    sent = messages.select(F.to_json(F.struct(*messages.columns)).cast("binary").alias("value"))
    return t.plain(optimal.records_to_long(src.events_from_text(sent)), "ts")


@query("partitioned_log_roundtrip", t.with_base(
    "SELECT site_id, ts, plant_up, tag_id, value FROM telemetry JOIN plant USING (site_id, ts) WHERE extract(hour FROM ts) % 2 = 0"))
def partitioned_log_roundtrip(spark, sf):
    """First batches of two streams, the second replayed, then one event type read back."""
    path = scratch_path(spark, "log")
    events = src.typed_events(as_messages(spark, sf))
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp")
    src.append_event_batch(events.where(early), path, 0, "first")
    src.append_event_batch(events.where(~early), path, 0, "second")
    src.append_event_batch(events.where(~early), path, 0, "second")
    return t.plain(optimal.records_to_long(src.read_log(spark, path, events.schema, "eventtype2")), "ts")


@query("appended_log", t.with_base("SELECT site_id, ts, plant_up FROM plant WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13'"))
def appended_log(spark, sf):
    """Plain appends per event type and day; a range of days is read back."""
    path = scratch_path(spark, "append")
    events = src.typed_events(as_messages(spark, sf))
    early = F.col("ts") < F.lit("2024-01-11").cast("timestamp")
    src.append_events(events.where(early), path)
    src.append_events(events.where(~early), path)
    days = src.between_days(src.read_log(spark, path, events.schema), F.lit("2024-01-10"), F.lit("2024-01-12"))
    return t.plain(days.select("site_id", "ts", "plant_up"), "ts")


@query("newest_anchor", t.with_base("SELECT site_id, max(ts) AS anchor_ts FROM plant GROUP BY 1"))
def newest_anchor(spark, sf):
    return t.plain(src.newest_anchor(t.events(spark, sf)), "anchor_ts")


@query("date_partition_overwrite", """
SELECT o_orderkey, CASE WHEN o_orderdate >= DATE '2000-01-01' AND o_orderdate < DATE '2000-03-01' THEN 'new' ELSE 'old' END AS state,
       CAST(o_orderdate AS DATE) AS field_date FROM orders""")
def date_partition_overwrite(spark, sf):
    path = scratch_path(spark, "dates")
    orders = t.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("field_date"))
    first = orders.withColumn("state", F.lit("old"))
    again = orders.where("field_date >= '2000-01-01' AND field_date < '2000-03-01'").withColumn("state", F.lit("new"))
    sinks.overwrite_dates(first, path)
    sinks.overwrite_dates(again, path)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("state", T.StringType()), T.StructField("field_date", T.DateType())])
    return spark.read.schema(schema).parquet(path)


@query("compacted_log", t.with_base("""
SELECT site_id, ts, plant_up, tag_id, value, true AS few_files FROM telemetry JOIN plant USING (site_id, ts)"""))
def compacted_log(spark, sf):
    """Twenty batches, compacted after the twelfth and after the last; a covered batch is replayed in between."""
    path = scratch_path(spark, "log")
    events = src.typed_events(as_messages(spark, sf))
    part = F.pmod(F.xxhash64("site_id", "ts"), F.lit(20))
    for i in range(20):
        src.append_event_batch(events.where(part == i), path, i, "stream")
        if i == 11:
            compaction.compact_log(spark, path, events.schema)
            src.append_event_batch(events.where(part == 3), path, 3, "stream")
    newest = compaction.compact_log(spark, path, events.schema)
    rows = spark.read.option("recursiveFileLookup", "true").schema("site_id int").parquet(f"{path}-compacted/generation={newest}/rows")
    per_day = rows.select(F.input_file_name().alias("f")).distinct().groupBy(F.regexp_extract("f", "eventtype=.*event_date=[^/]*", 0)).count()
    few = per_day.agg((F.max("count") <= 2).alias("few_files"))
    read = optimal.records_to_long(compaction.read_compacted_log(spark, path, events.schema))
    return t.plain(read.join(F.broadcast(few)).select("site_id", "ts", "plant_up", "tag_id", "value", "few_files"), "ts")


@query("merged_dates", """
WITH o AS (SELECT o_orderkey, o_totalprice, CAST(date_trunc('month', o_orderdate) AS DATE) AS field_date FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 77 = 0 THEN CAST(field_date + INTERVAL 3 MONTH AS DATE) ELSE field_date END AS field_date
FROM o WHERE o_orderkey % 5 <> 0 OR o_orderkey % 11 = 0 OR field_date >= DATE '2000-01-01'""")
def merged_dates(spark, sf):
    """A target by month without some orders; then corrections of old months, some of which move an order to another, and a late load."""
    path = scratch_path(spark, "merged")
    orders = t.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.trunc("o_orderdate", "month").alias("field_date"))
    known = orders.where("o_orderkey % 5 <> 0 AND field_date < '2000-01-01'")
    sinks.overwrite_dates(known, path)
    corrected = orders.where("o_orderkey % 11 = 0").select(
        "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"),
        F.when(F.col("o_orderkey") % 77 == 0, F.add_months("field_date", 3)).otherwise(F.col("field_date")).alias("field_date"))
    late = orders.where("field_date >= '2000-01-01' AND o_orderkey % 11 <> 0")
    sinks.merge_dates(corrected, path, ["o_orderkey"])
    sinks.merge_dates(late, path, ["o_orderkey"])
    return spark.read.schema(orders.schema).parquet(path)


@query("text_sink", t.with_base("""SELECT '{"site_id":' || site_id || ',"plant_up":' || plant_up || ',"n":null}' AS value FROM plant"""))
def text_sink(spark, sf):
    path = scratch_path(spark, "text")
    body = F.to_json(F.struct("site_id", "plant_up", F.lit(None).cast("int").alias("n")), {"ignoreNullFields": "false"})
    sinks.publish_results(t.events(spark, sf).select(body.alias("value")), path=path)
    return spark.read.text(path)


PROPS = T.StructType([T.StructField("k", T.IntegerType())])


def checked_events(raw):
    """Reasons against ``{"k": n}`` with n from 10 to 89; every seventh text is cut short, every eleventh renamed."""
    damaged = (
        F.when(F.col("event_id") % 7 == 0, F.substring("props", 1, 5))
        .when(F.col("event_id") % 11 == 0, F.replace("props", F.lit('"k"'), F.lit('"j"')))
        .otherwise(F.col("props"))
    )
    rows = raw.select("event_id", damaged.alias("props"))
    return quality.parse_with_reason(rows, "props", PROPS, ["k"], {"k out of range": F.col("parsed.k").between(10, 89)})


QUARANTINE_SQL = """
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN NULL ELSE k END AS k,
       CASE WHEN event_id % 7 = 0 THEN 'unreadable' WHEN event_id % 11 = 0 THEN 'missing k' WHEN NOT k BETWEEN 10 AND 89 THEN 'k out of range' END AS reason
FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)"""


@query("schema_quarantine", QUARANTINE_SQL)
def schema_quarantine(spark, sf):
    valid, rejected = quality.quarantine(checked_events(t.table(spark, sf, "events")))
    both = valid.withColumn("reason", F.lit(None).cast("string")).unionByName(rejected)
    return both.select("event_id", "parsed.k", "reason")


SPEC = synthetic.EventSpec(
    fields={"timestamp": "timestamp", "p_Up": "int", "batch": "string", "closed": "fbool", "level": "decimal", "stage": "number", "share": "discrete", "odd": "unheard-of"},
    ids=[str(i) for i in range(1, 16)],
    value_type="float",
    allowed={**{str(i): [0.0, 1.0] for i in range(1, 11)}, "p_Up": [0, 1]},
    nullable=["value", "level"],
    float_range=(10.0, 100.0),
    int_range=(10, 100),
)


def synthetic_table(spark, sf):
    """For every site of the input, an event per hour of its reporting span."""
    spans = t.telemetry(spark, sf).groupBy("site_id").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    grid = synthetic.time_grid(spans, F.col("lo"), F.col("hi"), 3600)
    made = synthetic.synthetic_events(grid, SPEC)
    index = (F.unix_seconds("ts") - F.unix_seconds(F.lit("2024-01-01").cast("timestamp"))).cast("bigint")
    return synthetic.number_events(made, F.col("site_id").cast("bigint"), 10_000_000, index)


def _sql_draw(state, number):
    """One draw as SQL; the step before it occurs twice in the text, so chains go through a CTE."""
    step = f"((({state}) + ({number}) + 1) * {synthetic.FACTOR} % {synthetic.MODULUS})"
    return f"(xor({step}, {step} >> {synthetic.SHIFT}) % {synthetic.MODULUS})"


def _sql_scaled(draw, size):
    return f"(({draw}) * {size}::BIGINT // {synthetic.MODULUS})"


def _sql_named(name):
    return _sql_draw("k", synthetic.number_of(name))


def _sql_held(value, draw):
    null = _sql_draw(draw, synthetic.number_of("null"))
    return f"CASE WHEN {null} >= {int(synthetic.NULL_SHARE * synthetic.MODULUS)} THEN {value} END"


_NUMBERS = ", ".join(f"({i}, {synthetic.number_of(str(i))})" for i in range(1, 16))
SYNTHETIC_SQL = t.with_base(f"""
, spans AS (SELECT site_id, min(ts) AS lo, max(ts) AS hi FROM telemetry GROUP BY 1),
instants AS (SELECT site_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM spans),
first AS (SELECT *, {_sql_draw(str(SPEC.seed), "site_id::BIGINT")} AS k0 FROM instants),
keyed AS (SELECT *, {_sql_draw("k0", "epoch(ts)::BIGINT % " + str(synthetic.MODULUS))} AS k FROM first),
events_made AS (
  SELECT *, {_sql_named("p_Up")} AS d_up, {_sql_named("batch")} AS d_batch, {_sql_named("level")} AS d_level, {_sql_named("stage")} AS d_stage, {_sql_named("share")} AS d_share
  FROM keyed),
ids(id, number) AS (VALUES {_NUMBERS}),
records AS (SELECT e.*, i.id, {_sql_draw("e.k", "i.number")} AS d FROM events_made e CROSS JOIN ids i)
SELECT site_id, ts, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS "timestamp", {_sql_scaled("d_up", 2)}::INTEGER AS "p_Up",
       list_aggregate(list_transform(range(1, 11), lambda i: substr('{synthetic.LETTERS}', ({_sql_scaled(_sql_draw("d_batch", "i"), 52)} + 1)::INTEGER, 1)), 'string_agg', '') AS batch,
       false AS closed, {_sql_held(f"(-400000000 + {_sql_scaled('d_level', 1400000000)}) / 1e6", "d_level")} AS level,
       {_sql_scaled("d_stage", 2)}::INTEGER AS stage, {_sql_scaled("d_share", 100000000)} / 1e6 AS share, '' AS odd,
       lpad((1000000000000000 + site_id::BIGINT * 10000000 + epoch(ts)::BIGINT - epoch(TIMESTAMP '2024-01-01')::BIGINT)::VARCHAR, 16, '0') AS "sequenceID",
       id::VARCHAR AS id, CASE WHEN id <= 10 THEN {_sql_scaled("d", 2)}::DOUBLE ELSE {_sql_held(f"(10000000 + {_sql_scaled('d', 90000000)}) / 1e6", "d")} END AS value
FROM records""")


@query("synthetic_events", SYNTHETIC_SQL)
def synthetic_events(spark, sf):
    """Every generated value, one row per record."""
    made = synthetic_table(spark, sf)
    others = [c for c in made.columns if c != "records"]
    return t.plain(made.select(*others, F.explode("records").alias("r")).select(*others, "r.id", "r.value"), "ts")


GENERATED = {
    "schema": {"timestamp": "timestamp", "p_Up": "int", "records": [{"id": "string", "value": "float"}]},
    "ids": [1, 2, 3], "columns_with_none": ["value"], "f_min_value": 10.0, "f_max_value": 100.0,
    "start_time": "2024-01-01T00:00:00", "end_time": "2024-01-01T08:00:00",
}


@query("generated_events", t.with_base("""
, kinds(eventtype, seconds) AS (VALUES ('eventtype1', 600), ('eventtype2', 3600)), sites AS (SELECT DISTINCT site_id FROM telemetry),
instants AS (SELECT eventtype, site_id, epoch(TIMESTAMP '2024-01-01')::BIGINT + seconds * unnest(range(28800 // seconds + 1)) AS s FROM kinds CROSS JOIN sites),
first AS (SELECT *, """ + _sql_draw(str(synthetic.EventSpec({}).seed), "site_id::BIGINT") + """ AS k0 FROM instants),
keyed AS (SELECT *, """ + _sql_draw("k0", f"s % {synthetic.MODULUS}") + """ AS k FROM first),
ids(number) AS (VALUES """ + ", ".join(f"({synthetic.number_of(str(i))})" for i in (1, 2, 3)) + """),
made AS (SELECT eventtype, site_id, s, """ + _sql_draw("k", "number") + """ AS d FROM keyed CROSS JOIN ids),
valued AS (SELECT eventtype, site_id, s, """ + _sql_held(f"(10000000 + {_sql_scaled('d', 90000000)})", "d") + """ AS micro FROM made),
every AS (SELECT * FROM valued UNION ALL SELECT 'all', site_id + 1000000 * (eventtype = 'eventtype2')::INTEGER, s, micro FROM valued)
SELECT eventtype, count(DISTINCT (site_id, s)) AS n_events, count(DISTINCT (site_id, s)) AS n_sequences, count(*) AS n_records, true AS in_range,
       count(*) - count(micro) AS n_nulls, sum(micro)::BIGINT AS micro_total FROM every GROUP BY eventtype"""))
def generated_events(spark, sf):
    """A configured run of the generator for all sites, two event types, written to files and read back."""
    path = scratch_path(spark, "generated")
    kinds = {name: GENERATED | {"interval_seconds": seconds} for name, seconds in (("eventtype1", 600), ("eventtype2", 3600))}
    synthetic.generate(t.telemetry(spark, sf).select("site_id").distinct(), {"event_types": kinds}, path)
    made = spark.read.schema("site_id int, eventtype string, sequenceID string, records array<struct<id:string,value:double>>").json(path)
    values = F.transform("records", lambda r: r["value"])
    inside = F.forall(values, lambda v: v.isNull() | v.between(10, 100))
    nulls = F.sum(F.size(F.filter(values, lambda v: v.isNull())).cast("bigint"))
    micros = F.aggregate(values, F.lit(0).cast("bigint"), lambda total, v: total + F.coalesce(F.round(v * 1e6).cast("bigint"), F.lit(0)))
    every = made.withColumn("eventtype", F.explode(F.array("eventtype", F.lit("all"))))
    return every.groupBy("eventtype").agg(
        F.count("*").alias("n_events"), F.count_distinct("sequenceID").alias("n_sequences"), F.sum(F.size("records")).alias("n_records"),
        F.bool_and(inside).alias("in_range"), nulls.alias("n_nulls"), F.sum(micros).alias("micro_total"),
    )


@query("synthetic_properties", t.with_base("""
, spans AS (SELECT site_id, min(ts) AS lo, max(ts) AS hi FROM telemetry GROUP BY 1)
SELECT site_id, CAST(date_diff('hour', lo, hi) + 1 AS BIGINT) AS n_events, CAST(date_diff('hour', lo, hi) + 1 AS BIGINT) AS n_sequences,
       true AS ids_16_long, true AS texts_10_long, true AS in_range, true AS choices_ok, true AS times_match, CAST(15 AS INTEGER) AS n_records FROM spans"""))
def synthetic_properties(spark, sf):
    made = synthetic_table(spark, sf)
    free = F.filter("records", lambda r: r["id"].cast("int") > 10)
    fixed = F.filter("records", lambda r: r["id"].cast("int") <= 10)
    return made.groupBy("site_id").agg(
        F.count("*").alias("n_events"),
        F.count_distinct("sequenceID").alias("n_sequences"),
        F.bool_and(F.length("sequenceID") == 16).alias("ids_16_long"),
        F.bool_and(F.length("batch") == 10).alias("texts_10_long"),
        F.bool_and(F.forall(free, lambda r: r["value"].isNull() | r["value"].between(10, 100))).alias("in_range"),
        F.bool_and(F.forall(fixed, lambda r: r["value"].isin(0.0, 1.0)) & F.col("p_Up").isin(0, 1)).alias("choices_ok"),
        F.bool_and(F.col("timestamp").cast("timestamp") == F.col("ts")).alias("times_match"),
        F.max(F.size("records")).alias("n_records"),
    )

"""Configuration processing, with parts as features and suppliers as tags, ten suppliers to a unit."""

from pyspark.sql import functions as F

from catalogue import tables as t
from catalogue.registry import query
from millrace.plans import configs


def features_config(spark, sf):
    """Parts nested by brand as a features configuration; texts come in mixed case with stray spaces."""
    key, size = F.col("p_partkey"), F.col("p_size")
    unit = F.expr("cast(p_partkey div 200 as string)")
    second = F.expr("cast(p_partkey div 200 + 1 as string)")
    functions = F.when(size % 4 == 0, " MEAN ").when(size % 4 == 1, "Max").when(size % 4 == 2, "Greater ")
    feature = F.struct(
        key.cast("int").alias("id"),
        F.concat(F.lit(" Unit"), unit, F.lit(", UNIT"), second, F.lit(" ")).alias("equipment"),
        functions.alias("function"),
        F.when(size % 2 == 0, size).alias("lag"),
        F.when(size % 5 == 0, F.lit(0.0)).alias("nullImpute"),
        (size / 100).alias("nullThreshold"),
        F.lit("Mean").alias("currentTimeAggregation"),
        F.when(size % 3 == 0, "Last").alias("anticipatedTimeAggregation"),
        F.when(size % 10 == 0, 2880).otherwise(60).alias("timeAggregationMinutes"),
        F.concat_ws(",", size.cast("string"), "p_brand").alias("customInput"),
        F.when(size == 1, "true").otherwise("false").alias("plantCondition"),
        F.concat(F.lit("Area"), (key % 2).cast("string")).alias("area"),
        F.concat(F.lit("LINE"), (key % 5).cast("string")).alias("line"),
        F.lit("Flow ").alias("measure"),
        F.concat(F.lit("P"), (key % 2).cast("string")).alias("position"),
    )
    return t.table(spark, sf, "part").groupBy("p_brand").agg(F.collect_list(feature).alias("features")).select("features")


def tags_config(spark, sf):
    """Suppliers nested by nation as a tags configuration: nations by region, suppliers from the last to the first."""
    key = F.col("s_suppkey")
    tag = F.struct(
        key.cast("string").alias("enterpriseId"),
        F.when(key % 3 == 0, "discrete").otherwise("numeric").alias("tagType"),
        F.when(key % 5 == 0, "Critical Run Status").otherwise("Normal").alias("criticality"),
        F.concat(F.lit("UNIT"), F.expr("cast(s_suppkey div 10 as string)")).alias("equipment"),
        F.concat(F.lit("AREA"), (key % 2).cast("string"), F.lit(" ")).alias("area"),
        F.concat(F.lit("Line"), (key % 5).cast("string")).alias("line"),
        F.lit("flow").alias("measure"),
        F.concat(F.lit(" p"), (key % 2).cast("string")).alias("position"),
    )
    suppliers = t.table(spark, sf, "supplier").join(t.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    ordered = F.array_sort(F.collect_list(F.struct((-key).alias("place"), tag.alias("tag"))))
    nations = suppliers.groupBy("n_regionkey", "n_nationkey").agg(F.transform(ordered, lambda x: x["tag"]).alias("tags"))
    sites = F.array_sort(F.collect_list(F.struct("n_regionkey", "n_nationkey", F.struct("tags").alias("site"))))
    return nations.agg(F.transform(sites, lambda x: x["site"]).alias("sites"))


def present_tags(spark, sf):
    """Tags that occur in the input: suppliers that delivered items at a high discount."""
    return t.table(spark, sf, "lineitem").where("l_discount >= 0.05").select(F.col("l_suppkey").cast("string").alias("tag_id"))


def is_run_tag():
    return F.col("criticality") == "Critical Run Status"


def _parts(spark, sf):
    features = configs.normalise_features(features_config(spark, sf))
    tags = configs.normalise_tags(tags_config(spark, sf), present_tags(spark, sf))
    return features, tags, configs.run_tag_pairs(tags, is_run_tag())


SQL_CONFIG = """
features AS (
  SELECT CAST(p_partkey AS INTEGER) AS id, u.equipment,
    CASE p_size % 4 WHEN 0 THEN 'mean' WHEN 1 THEN 'max' WHEN 2 THEN 'greater' END AS function,
    CASE WHEN p_size % 2 = 0 THEN p_size END AS lag, CASE WHEN p_size % 5 = 0 THEN 0.0e0 END AS "nullImpute",
    p_size / 100 AS "nullThreshold", 'mean' AS "currentTimeAggregation",
    CASE WHEN p_size % 3 = 0 THEN 'last' END AS "anticipatedTimeAggregation",
    CASE WHEN p_size % 10 = 0 THEN 2880 ELSE 60 END AS "timeAggregationMinutes", p_size || ',' || p_brand AS "customInput",
    CASE WHEN p_size = 1 THEN 'true' ELSE 'false' END AS "plantCondition",
    'area' || (p_partkey % 2) AS area, 'line' || (p_partkey % 5) AS line, 'flow' AS measure, 'p' || (p_partkey % 2) AS position
  FROM part, unnest(['unit' || (p_partkey // 200), 'unit' || (p_partkey // 200 + 1)]) u(equipment)),
tags AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS "enterpriseId", CASE WHEN s_suppkey % 3 = 0 THEN 'discrete' ELSE 'numeric' END AS "tagType",
    CASE WHEN s_suppkey % 5 = 0 THEN 'Critical Run Status' ELSE 'Normal' END AS criticality, 'unit' || (s_suppkey // 10) AS equipment,
    'area' || (s_suppkey % 2) AS area, 'line' || (s_suppkey % 5) AS line, 'flow' AS measure, 'p' || (s_suppkey % 2) AS position
  FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_discount >= 0.05)),
runs AS (
  SELECT r."enterpriseId" AS run_tag, o."enterpriseId" AS tag_id FROM tags o JOIN tags r ON o.equipment = r.equipment
  WHERE r.criticality = 'Critical Run Status' AND o.criticality <> 'Critical Run Status'),
pairs AS (
  SELECT f.id, f.function, f.lag, f."nullImpute", f."nullThreshold", f."currentTimeAggregation", f."anticipatedTimeAggregation",
         f."timeAggregationMinutes", f."customInput", t."enterpriseId" AS tag_id
  FROM features f LEFT JOIN tags t USING (equipment, area, line, measure, position))
"""


@query("config_normalise", "WITH " + SQL_CONFIG + "SELECT * FROM features")
def config_normalise(spark, sf):
    return configs.normalise_features(features_config(spark, sf)).drop("equipment_place")


@query("plant_condition_ids", "WITH " + SQL_CONFIG + """SELECT DISTINCT id FROM features WHERE "plantCondition" = 'true'""")
def plant_condition_ids(spark, sf):
    return configs.condition_features(configs.normalise_features(features_config(spark, sf)), "true")


@query("tag_config", "WITH " + SQL_CONFIG + "SELECT * FROM tags")
def tag_config(spark, sf):
    return configs.normalise_tags(tags_config(spark, sf), present_tags(spark, sf)).drop("place")


@query("run_tag_config", "WITH " + SQL_CONFIG + "SELECT * FROM runs")
def run_tag_config(spark, sf):
    return _parts(spark, sf)[2]


def _shown(pairs):
    return pairs.withColumn("customInput", F.array_join("customInput", "|"))


@query("feature_tag_config", "WITH " + SQL_CONFIG + """
SELECT id, function, lag, "nullImpute", "nullThreshold", "currentTimeAggregation", "anticipatedTimeAggregation",
       "timeAggregationMinutes", replace("customInput", ',', '|') AS "customInput",
       coalesce(string_agg(tag_id, '|' ORDER BY s_suppkey // 10 - id // 200, n_regionkey, n_nationkey, s_suppkey DESC), '') AS tags
FROM pairs LEFT JOIN supplier ON tag_id = CAST(s_suppkey AS VARCHAR) LEFT JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""")
def feature_tag_config(spark, sf):
    features, tags, _ = _parts(spark, sf)
    lists = configs.feature_tag_lists(configs.feature_tags(features, tags))
    return _shown(lists).withColumn("tags", F.array_join("tags", "|"))


@query("trigger_scope", "WITH " + SQL_CONFIG + """,
chosen AS (SELECT id, tag_id FROM pairs WHERE id IN (SELECT p_partkey FROM part WHERE p_size >= 45)),
needed_runs AS (SELECT DISTINCT run_tag FROM runs WHERE tag_id IN (SELECT tag_id FROM chosen WHERE tag_id IS NOT NULL))
SELECT tag_id AS name FROM chosen WHERE tag_id IS NOT NULL UNION SELECT run_tag FROM needed_runs UNION SELECT CAST(id AS VARCHAR) FROM chosen""")
def trigger_scope(spark, sf):
    features, tags, runs = _parts(spark, sf)
    chosen = t.table(spark, sf, "part").where("p_size >= 45").select(F.col("p_partkey").cast("int").alias("id"))
    scope = configs.scope_for(chosen, features, configs.feature_tags(features, tags), tags, runs)
    return configs.scope_columns(scope).toDF("name")


@query("trigger_run_tags", "WITH " + SQL_CONFIG + """,
chosen AS (SELECT tag_id FROM pairs WHERE id IN (SELECT p_partkey FROM part WHERE p_size >= 45))
SELECT run_tag, tag_id FROM runs WHERE run_tag IN (SELECT run_tag FROM runs WHERE tag_id IN (SELECT tag_id FROM chosen WHERE tag_id IS NOT NULL))""")
def trigger_run_tags(spark, sf):
    features, tags, runs = _parts(spark, sf)
    chosen = t.table(spark, sf, "part").where("p_size >= 45").select(F.col("p_partkey").cast("int").alias("id"))
    return configs.scope_for(chosen, features, configs.feature_tags(features, tags), tags, runs).run_tags.select("run_tag", "tag_id")


@query("horizon_split", "WITH " + SQL_CONFIG + """
SELECT CASE WHEN "timeAggregationMinutes" = 2880 THEN 'long' ELSE 'short' END AS horizon, id, tag_id FROM pairs""")
def horizon_split(spark, sf):
    features, tags, _ = _parts(spark, sf)
    long, short = configs.split_horizon(configs.feature_tags(features, tags), 2880)
    return long.select(F.lit("long").alias("horizon"), "id", "tag_id").unionByName(short.select(F.lit("short").alias("horizon"), "id", "tag_id"))

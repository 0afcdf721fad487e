"""Explicit schemas of every input and output; nothing is inferred."""

from pyspark.sql import types as T

RECORD = T.StructType([T.StructField("id", T.StringType()), T.StructField("value", T.DoubleType())])

EVENT = T.StructType(
    [
        T.StructField("site_id", T.IntegerType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("eventtype", T.StringType()),
        T.StructField("plant_up", T.IntegerType()),
        T.StructField("sequenceID", T.StringType()),
        T.StructField("records", T.ArrayType(RECORD)),
    ]
)

FEATURE = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("equipment", T.StringType()),
        T.StructField("function", T.StringType()),
        T.StructField("lag", T.IntegerType()),
        T.StructField("nullImpute", T.DoubleType()),
        T.StructField("nullThreshold", T.DoubleType()),
        T.StructField("currentTimeAggregation", T.StringType()),
        T.StructField("anticipatedTimeAggregation", T.StringType()),
        T.StructField("timeAggregationMinutes", T.IntegerType()),
        T.StructField("customInput", T.StringType()),
        T.StructField("plantCondition", T.StringType()),
        T.StructField("area", T.StringType()),
        T.StructField("line", T.StringType()),
        T.StructField("measure", T.StringType()),
        T.StructField("position", T.StringType()),
    ]
)
FEATURES_CONFIG = T.StructType([T.StructField("features", T.ArrayType(FEATURE))])

TAG = T.StructType(
    [
        T.StructField("enterpriseId", T.StringType()),
        T.StructField("tagType", T.StringType()),
        T.StructField("criticality", T.StringType()),
        T.StructField("equipment", T.StringType()),
        T.StructField("area", T.StringType()),
        T.StructField("line", T.StringType()),
        T.StructField("measure", T.StringType()),
        T.StructField("position", T.StringType()),
    ]
)
TAGS_CONFIG = T.StructType(
    [T.StructField("sites", T.ArrayType(T.StructType([T.StructField("tags", T.ArrayType(TAG))])))]
)

PLANT_CONFIG = T.StructType(
    [
        T.StructField("trigger_features", T.ArrayType(T.IntegerType())),
        T.StructField("plantup_time", T.IntegerType()),
        T.StructField("plantup_switch", T.IntegerType()),
        T.StructField("plantup_minutes", T.IntegerType()),
        T.StructField("moisture_feature", T.IntegerType()),
        T.StructField("moisture_target_feature", T.IntegerType()),
        T.StructField("moisture_target", T.DoubleType()),
        T.StructField("skip_low_pass", T.ArrayType(T.StringType())),
        T.StructField("optimal_tag", T.StringType()),
        T.StructField("optimal_threshold", T.DoubleType()),
    ]
)

#: Columns on which features find their tags, and the key on which tags find their run tag.
MATCH_KEYS = ["equipment", "area", "line", "measure", "position"]

OUTPUT_RECORD = T.StructType([T.StructField("id", T.ShortType()), T.StructField("value", T.DoubleType())])
OUTPUT_EVENT = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("flag", T.BooleanType()),
        T.StructField("eventType", T.StringType()),
        T.StructField("currentFeatureRecords", T.ArrayType(OUTPUT_RECORD)),
        T.StructField("anticipatedFeatureRecords", T.ArrayType(OUTPUT_RECORD)),
        T.StructField("plantConditions", T.ArrayType(OUTPUT_RECORD)),
    ]
)

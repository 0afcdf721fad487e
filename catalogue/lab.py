"""Laboratory conforming over orders (samples), lineitem (tests and results), part (analyses), supplier (goals)."""

from pyspark.sql import functions as F

from catalogue import tables as t
from catalogue.registry import query
from millrace.operators import dedup
from millrace.plans import lab
from millrace.sources import events as src

CUT = "1999-01-01"
OVERLAP = "1998-07-01"

TEST = lab.TableNames("TEST", ["quantity", "flag", "status"], {"SAMPLE_ID": "TEST_SAMPLE_ID", "shipped": "TEST_shipped"})
RESULT = lab.TableNames("RESULT", ["price", "discount"], {"TEST_ID": "RESULT_TEST_ID", "aid": "RESULT_aid"})
ANALYSIS = lab.TableNames("ANALYSIS", ["name", "size"], {"aid": "ANALYSIS_aid"})
GOAL = lab.TableNames("GOAL", ["name", "balance"], {"id": "GOAL_id"})
KEYS = lab.LabKeys("SAMPLE_ID", "TEST_SAMPLE_ID", "test_id", "RESULT_TEST_ID", "RESULT_aid", "ANALYSIS_aid", ["supplier_id", "lane_id"])


def _tables(spark, sf):
    """Live and historical halves of lineitem overlap for half a year; the overlap must appear once."""
    li = t.table(spark, sf, "lineitem").withColumn("test_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    tests = li.select(
        F.col("l_orderkey").alias("SAMPLE_ID"), "test_id", F.col("l_quantity").alias("quantity"), F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"), F.col("l_shipdate").alias("shipped"),
    )
    results = li.select(
        F.col("test_id").alias("TEST_ID"), F.col("l_partkey").alias("aid"), F.col("l_suppkey").alias("supplier_id"),
        (F.col("l_suppkey") % 5).alias("lane_id"), F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"), "l_shipdate",
    )
    live, old = F.lit(OVERLAP).cast("timestamp_ntz"), F.lit(CUT).cast("timestamp_ntz")
    return {
        "sample": t.table(spark, sf, "orders").select(
            F.col("o_orderkey").alias("SAMPLE_ID"), F.col("o_orderdate").alias("sample_date"), F.col("o_orderstatus").alias("state")),
        "test": lab.conform_pair(
            tests.where(F.col("shipped") >= live).withColumn("row_id", F.lit(1)), tests.where(F.col("shipped") < old).withColumn("row_id", F.lit(2)), TEST, ["row_id"]),
        "result": lab.conform_pair(
            results.where(F.col("l_shipdate") >= live).withColumn("row_id", F.lit(1)), results.where(F.col("l_shipdate") < old).withColumn("row_id", F.lit(2)),
            RESULT, ["row_id", "l_shipdate"]),
        "analysis": lab.conform_dimension(
            t.table(spark, sf, "part").select(F.col("p_partkey").alias("aid"), F.col("p_name").alias("name"), F.col("p_size").alias("size")), ANALYSIS),
        "goal": lab.conform_dimension(
            t.table(spark, sf, "supplier").select(
                F.col("s_suppkey").alias("supplier_id"), (F.col("s_suppkey") % 5 + F.when(F.col("s_suppkey") % 10 == 0, 1).otherwise(0)).alias("lane_id"),
                F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")), GOAL),
    }


SQL_LAB = """
li AS (SELECT *, l_orderkey * 10 + l_linenumber AS test_id FROM lineitem),
test AS (SELECT DISTINCT l_orderkey AS "TEST_SAMPLE_ID", test_id, l_quantity AS "TEST_quantity", l_returnflag AS "TEST_flag",
         l_linestatus AS "TEST_status", l_shipdate AS "TEST_shipped" FROM li),
result AS (SELECT DISTINCT test_id AS "RESULT_TEST_ID", l_partkey AS "RESULT_aid", l_suppkey AS supplier_id, l_suppkey % 5 AS lane_id,
           l_extendedprice AS "RESULT_price", l_discount AS "RESULT_discount" FROM li),
sample AS (SELECT DISTINCT o_orderkey AS "SAMPLE_ID", o_orderdate AS sample_date, o_orderstatus AS state FROM orders),
analysis AS (SELECT DISTINCT p_partkey AS "ANALYSIS_aid", p_name AS "ANALYSIS_name", p_size AS "ANALYSIS_size" FROM part),
goal AS (SELECT DISTINCT s_suppkey AS supplier_id, s_suppkey % 5 + CASE WHEN s_suppkey % 10 = 0 THEN 1 ELSE 0 END AS lane_id, s_suppkey AS "GOAL_id",
         s_name AS "GOAL_name", s_acctbal AS "GOAL_balance" FROM supplier),
chain AS (SELECT * FROM sample JOIN test ON "SAMPLE_ID" = "TEST_SAMPLE_ID" JOIN result ON test_id = "RESULT_TEST_ID"
          JOIN analysis ON "RESULT_aid" = "ANALYSIS_aid")
"""


@query("scanned_table", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def scanned_table(spark, sf):
    """A laboratory table by name from a folder of tables, only the columns asked for."""
    return src.read_table(spark, "supplier.parquet", sf).select("s_suppkey", "s_name", "s_nationkey")


@query("conformed_names", """
SELECT p_partkey AS "ANALYSIS_aid", p_name AS "ANALYSIS_name", p_size AS "ANALYSIS_size" FROM part GROUP BY ALL""")
def conformed_names(spark, sf):
    return _tables(spark, sf)["analysis"]


@query("live_historical_union", "WITH " + SQL_LAB + "SELECT * FROM test")
def live_historical_union(spark, sf):
    return _tables(spark, sf)["test"]


@query("lab_join_chain", "WITH " + SQL_LAB + "SELECT * FROM chain")
def lab_join_chain(spark, sf):
    x = _tables(spark, sf)
    return lab.join_chain(x["sample"], x["test"], x["result"], x["analysis"], KEYS)


@query("lab_join_left", "WITH " + SQL_LAB + "SELECT * FROM chain")
def lab_join_left(spark, sf):
    x = _tables(spark, sf)
    return lab.join_chain(x["sample"], x["test"], x["result"], x["analysis"], KEYS, strict_inner=False)


@query("goal_outer_join", "WITH " + SQL_LAB + "SELECT * FROM chain FULL JOIN goal USING (supplier_id, lane_id)")
def goal_outer_join(spark, sf):
    return lab.lab_dataset(**_tables(spark, sf), keys=KEYS)


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, sf):
    li = t.table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus")
    return dedup.live_and_historical(li, li.where("l_returnflag = 'R'"))

"""Projections, filters and orderings on the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .registry import query, table
from ..functions import columns, predicates
from ..operators import lookback


@query("project", "SELECT s_suppkey AS id, s_name AS name, NULL::VARCHAR AS middle FROM supplier")
def project(spark, sf_dir):
    return columns.project(table(spark, sf_dir, "supplier"), {"id": "s_suppkey", "name": "s_name", "middle": None})


@query("like_filter", """
SELECT p_partkey, p_name FROM part WHERE (p_name LIKE 'h%' OR p_name LIKE '%ring%') AND p_name NOT LIKE '%anvil'
""")
def like_filter(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return columns.like_filter(parts, "p_name", ["h%", "%ring%"], ["%anvil"])


@query("length_filter", "SELECT o_orderkey FROM orders WHERE length(CAST(o_custkey AS VARCHAR)) > 2")
def length_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.filter(predicates.longer_than(F.col("o_custkey"), 2)).select("o_orderkey")


@query("require", """
SELECT user_id, count(*) AS n FROM events WHERE value > 50 AND event_type <> 'view' GROUP BY user_id
""")
def require(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id", F.when(F.col("value") > 50, F.col("value")).alias("v"), F.when(F.col("event_type") != "view", "x").alias("t")
    )
    return predicates.require(events, ["v", "t"]).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def distinct_rows(spark, sf_dir):
    return columns.distinct_rows(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_suppkey"])


@query("ordered", "SELECT c_nationkey, c_mktsegment, c_custkey FROM customer ORDER BY c_nationkey, c_mktsegment, c_custkey DESC")
def ordered(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment", "c_custkey")
    return columns.ordered(rows, ["c_nationkey", "c_mktsegment"], ["c_custkey"])


@query("json_value", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_value(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", columns.json_value(F.col("props"), "$.k").alias("k"))


@query("month_agree", """
SELECT l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE strftime(o_orderdate, '%Y-%m') IN ('1997-03', '1997-04') AND strftime(l_shipdate, '%Y-%m') = strftime(o_orderdate, '%Y-%m')
""")
def month_agree(spark, sf_dir):
    both = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    monthly = both.withColumn("index_update", F.date_format("o_orderdate", "yyyy-MM"))
    return lookback.month_agree(monthly, ["1997-03", "1997-04"], "l_shipdate").select("l_orderkey", "l_linenumber")


@query("retain_months", "SELECT o_orderkey FROM orders WHERE strftime(o_orderdate, '%Y-%m') >= '1997-01'")
def retain_months(spark, sf_dir):
    monthly = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("partition_month"))
    return lookback.retain_months(monthly, "2000-01-01", 36).select("o_orderkey")

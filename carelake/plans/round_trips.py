"""Sources, sinks and streams: whole tables are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .registry import query, table
from ..operators import lookback
from ..session import shared_folder, written
from ..sources import files, sinks
from ..streaming import marks


@query("to_pipe_delimited", """
SELECT n_nationkey || '|' || n_name || '|' || CASE WHEN r_name LIKE 'A%' THEN '' ELSE r_name END AS line
FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def to_pipe_delimited(spark, sf_dir):
    both = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    some = both.withColumn("r_name", F.when(~F.startswith("r_name", F.lit("A")), F.col("r_name")))
    return some.select(sinks.to_pipe_delimited(["n_nationkey", "n_name", "r_name"]).alias("line"))


@query("csv_round_trip", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment FROM customer
""")
def csv_round_trip(spark, sf_dir):
    folder = shared_folder(spark, "csv")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    sinks.to_csv(rows, folder)
    names = {"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment"}
    return files.read_csv_dir(spark, folder, names).drop("source_file")


@query("ragged_csv", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS label,
       'Not Applicable' AS missing FROM orders
""")
def ragged_csv(spark, sf_dir):
    folder = shared_folder(spark, "ragged")
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    line = F.when(F.col("o_orderstatus") == "P", key).when(
        F.col("o_orderstatus") == "F", F.concat_ws(",", key, "o_orderpriority", F.lit("x"), F.lit("extra"))
    ).otherwise(F.concat_ws(",", key, "o_orderpriority", F.lit("x")))
    rows = o.select(line.alias("value"))
    # The CSV writer puts the header line on top of every file; quoting is off, so lines stay as they are.
    named = rows.withColumnRenamed("value", ">id,label,")
    named.write.mode("overwrite").option("header", True).option("sep", "\u0001").option("quote", "\u0000").csv(f"{folder}/rows")
    return files.read_ragged_csv(spark, f"{folder}/rows", ["id", "label", "missing"])


@query("partitioned_round_trip", """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m') AS index_update FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1997-05'
""")
def partitioned_round_trip(spark, sf_dir):
    folder = shared_folder(spark, "months")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("index_update"))
    sinks.save_partitions(rows, folder, ["index_update"])
    sinks.save_partitions(rows, folder, ["index_update"])
    return lookback.month_slice(files.read_table(spark, folder), "1997-05-01").withColumn("index_update", F.col("index_update").cast("string"))


@query("orc_copy", "SELECT p_partkey, p_name, p_size FROM part")
def orc_copy(spark, sf_dir):
    folder = shared_folder(spark, "orc")
    sinks.save_partitions(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"), f"{folder}/a", ["p_size"], "orc")
    sinks.copy_table(spark, f"{folder}/a", f"{folder}/b", "orc")
    return files.read_table(spark, f"{folder}/b", "orc")


@query("tsv_logs", """
SELECT event_type AS "Action", CAST(event_id AS VARCHAR) AS "Session_ID", CAST(user_id AS VARCHAR) AS "Username" FROM events
""")
def tsv_logs(spark, sf_dir):
    folder = shared_folder(spark, "logs")
    rows = table(spark, sf_dir, "events").select("event_type", F.col("event_id").cast("string"), F.col("user_id").cast("string"))
    rows.write.mode("overwrite").option("sep", "\t").option("header", True).csv(folder)
    good, _ = files.read_tsv_logs(spark, folder, ["Action", "Session_ID", "Username"], "*.csv")
    return good.drop("Source_File")


@query("lookback_backfill", """
WITH e AS (SELECT date_trunc('month', max(o_orderdate)) AS ds FROM orders),
s AS (SELECT o_custkey, o_orderdate AS latest_known_admitted, o_orderkey AS latest_known_order, strftime(o_orderdate, '%Y-%m') || '-01' AS latest_index_update,
             strftime(ds, '%Y-%m-%d') AS ds
      FROM orders, e WHERE o_orderdate >= ds - INTERVAL 36 MONTH)
SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY latest_index_update DESC, latest_known_order DESC) = 1
""")
def lookback_backfill(spark, sf_dir):
    snapshots, days = _snapshots(spark, sf_dir)
    # Rebalanced by snapshot, so that a folder holds a few files and none outgrows a task.
    stored = written(snapshots.hint("rebalance", "ds"), "backfill", ["ds"])
    return stored.filter(F.col("ds") == days[-1])


@query("lookback_backfill_all", """
WITH o AS (SELECT *, date_trunc('month', o_orderdate) AS m FROM orders),
days AS (SELECT CAST(unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS DATE) AS day FROM o)
SELECT o_custkey, o_orderdate AS latest_known_admitted, o_orderkey AS latest_known_order, strftime(m, '%Y-%m-%d') AS latest_index_update,
       strftime(day, '%Y-%m-%d') AS ds
FROM days JOIN o ON m <= day AND o_orderdate >= day - INTERVAL 36 MONTH
QUALIFY row_number() OVER (PARTITION BY day, o_custkey ORDER BY m DESC, o_orderkey DESC) = 1
""")
def lookback_backfill_all(spark, sf_dir):
    return _snapshots(spark, sf_dir)[0]


def _snapshots(spark, sf_dir):
    """The snapshots of all months of the orders, and the days they are taken for."""
    values = {"latest_known_admitted": "o_orderdate", "latest_known_order": "o_orderkey"}
    accounts = table(spark, sf_dir, "orders").withColumn("index_update", F.date_format("o_orderdate", "yyyy-MM"))
    first, last = accounts.agg(F.min("index_update"), F.max("index_update")).first()
    count = 12 * (int(last[:4]) - int(first[:4])) + int(last[5:]) - int(first[5:]) + 1
    days = [lookback.month_text(f"{first}-01", i) + "-01" for i in range(count)]
    snapshots = lookback.backfill_snapshots(accounts, days, values, key="o_custkey", event_time="o_orderdate", tie="o_orderkey")
    return snapshots, days


@query("stream_changed_files", """
SELECT user_id, event_type, max(ts) AS ts FROM events GROUP BY user_id, event_type
HAVING max(ts) >= TIMESTAMP '2024-01-20' OR event_type = 'signup'
""")
def stream_changed_files(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    before = events.filter((F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")) & (F.col("event_type") != "signup"))
    folder = shared_folder(spark, "stream")
    stream = marks.file_stream(spark, sf_dir, "user_id bigint, event_type string, ts timestamp_ntz", glob="events.parquet")
    marks.watch(stream, ["user_id", "event_type"], "ts", folder, first_marks=before).awaitTermination()
    return marks.changes_of(spark, folder).drop("version")

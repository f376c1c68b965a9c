"""Lookbacks, residence and per-key picks on events, orders and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .registry import query, table
from ..operators import keys, lookback, residence
from ..operators.joins import attach_mpi
from ..session import literal_rows

LATEST_STATE_SQL = """
SELECT user_id,
       max(ts) AS latest_index_update_dt_tm,
       max(ts) FILTER (WHERE event_type <> 'error') AS used_index_update_dt_tm,
       (arg_max(event_type, (ts, event_type)) FILTER (WHERE event_type <> 'error')) AS imputed_state,
       CASE WHEN max(ts) = max(ts) FILTER (WHERE event_type <> 'error')
            THEN 'latest_update' ELSE 'latest_update_not_unknown' END AS used_algorithm
FROM events GROUP BY user_id
"""


def account_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    return residence.latest_state(events, "user_id", "event_type", "ts", unknown="error")


@query("latest_state", LATEST_STATE_SQL)
def latest_state(spark, sf_dir):
    return account_states(spark, sf_dir)


def _people(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("mpi"))


def _states_with_people(spark, sf_dir, keep_unmatched=False):
    return residence.state_with_mpi(
        account_states(spark, sf_dir), _people(spark, sf_dir), "user_id", "c_custkey", "mpi", keep_unmatched
    )


WITH_MPI_SQL = f"""
SELECT s.*, c.c_nationkey AS mpi FROM ({LATEST_STATE_SQL}) s JOIN customer c ON s.user_id = c.c_custkey
"""


@query("state_with_mpi", WITH_MPI_SQL)
def state_with_mpi(spark, sf_dir):
    return _states_with_people(spark, sf_dir)


@query("state_with_mpi_kept", WITH_MPI_SQL.replace(" JOIN ", " LEFT JOIN "))
def state_with_mpi_kept(spark, sf_dir):
    return _states_with_people(spark, sf_dir, keep_unmatched=True)


PERSON_SQL = f"""
SELECT mpi, a.latest_index_update_dt_tm, a.used_index_update_dt_tm, a.imputed_state, a.used_algorithm,
       a.user_id AS patient_id_used_for_assignment, number_patient_ids
FROM (SELECT mpi, count(*) AS number_patient_ids,
             (arg_max(t, (used_index_update_dt_tm, user_id)) FILTER (WHERE used_index_update_dt_tm IS NOT NULL)) AS a
      FROM ({WITH_MPI_SQL}) t GROUP BY mpi)
"""


def _person_state(spark, sf_dir):
    return residence.person_state(_states_with_people(spark, sf_dir), "mpi", "user_id")


@query("person_state", PERSON_SQL)
def person_state(spark, sf_dir):
    return _person_state(spark, sf_dir)


@query("state_summary", f"""
SELECT imputed_state, used_algorithm, count(*) AS number_mpis,
       CAST(sum(number_patient_ids) AS BIGINT) AS number_patient_ids, '2024-02-01' AS ds
FROM ({PERSON_SQL}) GROUP BY imputed_state, used_algorithm
""")
def state_summary(spark, sf_dir):
    return residence.state_summary(_person_state(spark, sf_dir), "2024-02-01")


@query("standardize_codes", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Critical' WHEN '2-HIGH' THEN 'High'
  WHEN '3-MEDIUM' THEN 'Medium' WHEN '5-LOW' THEN 'Low' ELSE 'UNKNOWN' END AS priority FROM orders
""")
def standardize_codes(spark, sf_dir):
    pairs = [
        ("1-URGENT", "Critical", 1), ("2-HIGH", "High", 1), ("3-MEDIUM", "Medium", 1), ("5-LOW", "Low", 1),
        ("5-LOW", "Lowest", 2),
    ]
    crosswalk = literal_rows(spark, pairs, "raw string, standard string, rank int")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return residence.standardize(orders, "o_orderpriority", crosswalk, "priority").drop("o_orderpriority")


@query("recent_and_history", """
SELECT month, count(*) AS n FROM (
  SELECT strftime(o_orderdate, '%Y-%m') AS month FROM orders
  WHERE strftime(o_orderdate, '%Y-%m') <= '1998-06'
  UNION ALL
  SELECT strftime(o_orderdate, '%Y-%m') FROM orders WHERE strftime(o_orderdate, '%Y-%m') > '1998-06')
GROUP BY month
""")
def recent_and_history(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("index_update"))
    history = orders.filter(F.col("index_update") <= "1998-06")
    both = residence.recent_and_history(history, orders, "1998-06")
    return keys.key_frequency(both, "index_update").toDF("month", "n")


@query("account_to_person", """
SELECT l_partkey, min(l_suppkey) AS l_suppkey, count(DISTINCT l_suppkey) AS num_mpis_should_be_1
FROM lineitem GROUP BY l_partkey
""")
def account_to_person(spark, sf_dir):
    return residence.account_to_person(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


# -- lookbacks ----------------------------------------------------------------------------------

DS = "2000-01-01"
VALUES = {
    "latest_known_admitted": "o_orderdate",
    "latest_known_order": "o_orderkey",
    "latest_known_status": "o_orderstatus",
}


def _accounts(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("index_update", F.date_format("o_orderdate", "yyyy-MM"))


def _full(spark, sf_dir, ds):
    return lookback.lookback_full(
        _accounts(spark, sf_dir), ds, VALUES, key="o_custkey", event_time="o_orderdate", tie="o_orderkey"
    )


def _full_sql(ds: str, start: str) -> str:
    return f"""
SELECT o_custkey, o_orderdate AS latest_known_admitted, o_orderkey AS latest_known_order,
       o_orderstatus AS latest_known_status, strftime(o_orderdate, '%Y-%m') || '-01' AS latest_index_update, '{ds}' AS ds
FROM orders WHERE o_orderdate >= TIMESTAMP '{start}'
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY strftime(o_orderdate, '%Y-%m') DESC, o_orderkey DESC) = 1
"""


@query("lookback_full", _full_sql(DS, "1997-01-01"))
def lookback_full(spark, sf_dir):
    return _full(spark, sf_dir, DS)


@query("lookback_step", f"""
WITH prev AS ({_full_sql('1999-12-01', '1996-12-01')}),
both_ AS (
  SELECT o_custkey, o_orderdate AS latest_known_admitted, o_orderkey AS latest_known_order,
         o_orderstatus AS latest_known_status, strftime(o_orderdate, '%Y-%m') || '-01' AS latest_index_update
  FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '2000-01'
  UNION ALL
  SELECT o_custkey, latest_known_admitted, latest_known_order, latest_known_status, latest_index_update
  FROM prev WHERE latest_index_update >= '1997-01-01')
SELECT *, '{DS}' AS ds FROM both_ WHERE latest_known_admitted >= TIMESTAMP '1997-01-01'
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY latest_index_update DESC, latest_known_order DESC) = 1
""")
def lookback_step(spark, sf_dir):
    return lookback.lookback_step(
        _full(spark, sf_dir, "1999-12-01"), _accounts(spark, sf_dir), DS, VALUES, key="o_custkey", event_time="o_orderdate", tie="o_orderkey"
    )


@query("lookback_rows", """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m') AS partition_month
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'
""")
def lookback_rows(spark, sf_dir):
    rows = lookback.lookback_rows(_accounts(spark, sf_dir), DS, event_time="o_orderdate")
    return rows.select("o_orderkey", "o_custkey", "partition_month")


@query("month_slice", """
SELECT o_orderkey FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1998-03'
""")
def month_slice(spark, sf_dir):
    return lookback.month_slice(_accounts(spark, sf_dir), "1998-03-01").select("o_orderkey")


@query("attach_mpi", f"""
SELECT f.o_custkey, f.latest_known_order, l.l_suppkey FROM ({_full_sql(DS, '1997-01-01')}) f
JOIN lineitem l ON f.latest_known_order = l.l_orderkey
""")
def attach(spark, sf_dir):
    accounts = _full(spark, sf_dir, DS).select("o_custkey", "latest_known_order")
    return attach_mpi(accounts, table(spark, sf_dir, "lineitem"), "latest_known_order", "l_orderkey", "l_suppkey")


# -- per-key picks ------------------------------------------------------------------------------

@query("latest_per_key", """
SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_per_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return keys.latest_per_key(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]).drop("ts")


@query("latest_known", """
SELECT l_partkey, arg_max(l_orderkey, (l_shipdate, l_orderkey, l_linenumber)) AS last_order,
       arg_max(l_suppkey, (l_shipdate, l_orderkey, l_linenumber)) AS last_supplier
FROM lineitem GROUP BY l_partkey
""")
def latest_known(spark, sf_dir):
    # The tie-break includes the supplier so that copies of a line cannot mix.
    return keys.latest_known(
        table(spark, sf_dir, "lineitem"), ["l_partkey"], {"last_order": "l_orderkey", "last_supplier": "l_suppkey"},
        ["l_shipdate", "l_orderkey", "l_linenumber"],
    )


@query("max_when", """
SELECT user_id, max(value) FILTER (WHERE event_type = 'purchase') AS largest_purchase FROM events GROUP BY user_id
""")
def max_when(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    bought = keys.max_when(F.col("event_type") == "purchase", F.col("value"))
    return events.groupBy("user_id").agg(bought.alias("largest_purchase"))


@query("latest_month_of_greatest_row", """
SELECT l_partkey, arg_max(month, (l_quantity, l_suppkey, month)) AS latest_known
FROM (SELECT *, strftime(l_shipdate, '%Y-%m') AS month FROM lineitem) GROUP BY l_partkey
""")
def latest_month_of_greatest_row(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    return keys.latest_month_of_greatest_row(lines, "l_partkey", "month", ["l_quantity", "l_suppkey"])


@query("key_frequency", "SELECT l_partkey, count(*) AS freq FROM lineitem GROUP BY l_partkey")
def key_frequency(spark, sf_dir):
    return keys.key_frequency(table(spark, sf_dir, "lineitem"), "l_partkey")


@query("high_water", "SELECT event_type, max(event_id) AS max_event_id FROM events GROUP BY event_type")
def high_water(spark, sf_dir):
    return keys.high_water(table(spark, sf_dir, "events"), "event_id", ["event_type"])


@query("high_water_scalar", "SELECT max(l_orderkey) AS max_l_orderkey FROM lineitem")
def high_water_scalar(spark, sf_dir):
    return keys.high_water(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query("newest_per_folder", """
SELECT event_type, event_id, ts FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def newest_per_folder(spark, sf_dir):
    return keys.newest(table(spark, sf_dir, "events"), "event_id", "ts", ["event_type"])


@query("any_one", "SELECT c_nationkey, min(c_name) AS c_name FROM customer GROUP BY c_nationkey")
def any_one(spark, sf_dir):
    return keys.any_one(table(spark, sf_dir, "customer"), ["c_nationkey"], "c_name")


@query("first_rows", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 100")
def first_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return keys.first_rows(orders, 100, [F.col("o_orderdate").desc(), F.col("o_orderkey")])

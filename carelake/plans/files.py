"""Manifests, change detection, directories, tickets and logs on the star-schema tables.

Events stand for file sightings: the user is the client, the event type the folder, the time the
modification time. Lookup tables of event types are spread over the five regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .registry import query, table
from ..functions import dates, predicates, text
from ..operators import changes, logs, manifest, position, tickets
from ..session import literal_rows

TYPES = ("click", "error", "purchase", "signup", "view")
MARK = "2024-01-20 00:00:00"


def _listing(spark, sf_dir):
    """Paths ``type/day/user/event.xml`` with a modification time."""
    e = table(spark, sf_dir, "events")
    path = F.concat_ws("/", "event_type", F.date_format("ts", "yyyyMMdd"), F.col("user_id").cast("string"),
                       F.concat(F.col("event_id").cast("string"), F.lit(".xml")))
    return e.select(path.alias("path"), F.col("ts").alias("modified"), "event_id", "user_id", "event_type")


PATH = "event_type || '/' || strftime(ts, '%Y%m%d') || '/' || user_id || '/' || event_id || '.xml'"


def _mark():
    return F.lit(MARK).cast("timestamp_ntz")



@query("manifest_diff", f"SELECT {PATH} AS path FROM events WHERE event_type = 'error' OR ts >= TIMESTAMP '{MARK}'")
def manifest_diff(spark, sf_dir):
    files = _listing(spark, sf_dir)
    copied = files.filter((F.col("event_type") != "error") & (F.col("modified") < _mark()))
    return manifest.manifest_diff(files.select("path"), copied)


@query("remainder", f"SELECT {PATH} AS path FROM events WHERE event_type <> 'error'")
def remainder(spark, sf_dir):
    files = _listing(spark, sf_dir)
    archived = files.filter(F.col("event_type") == "error").select(F.concat(F.lit("other/folder/"), text.base_name(F.col("path"))).alias("path"))
    return manifest.remainder(files.select("path"), archived)


@query("folder_counts", "SELECT event_type AS folder, count(*) AS n_files FROM events GROUP BY event_type")
def folder_counts(spark, sf_dir):
    return manifest.folder_counts(_listing(spark, sf_dir))


@query("reconcile_counts", f"""
SELECT folder, coalesce(a.n, 0) AS n_current, coalesce(b.n, 0) AS n_new, coalesce(a.n, 0) = coalesce(b.n, 0) AS same
FROM (SELECT event_type AS folder, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY 1) a
FULL JOIN (SELECT event_type AS folder, count(*) AS n FROM events WHERE event_type <> 'error' AND (event_type <> 'click' OR ts < TIMESTAMP '{MARK}') GROUP BY 1) b
USING (folder)
""")
def reconcile_counts(spark, sf_dir):
    files = _listing(spark, sf_dir)
    moved = files.filter((F.col("event_type") != "error") & ((F.col("event_type") != "click") | (F.col("modified") < _mark())))
    return manifest.reconcile_counts(
        manifest.folder_counts(files.filter(F.col("event_type") != "view")), manifest.folder_counts(moved)
    )


@query("delivered_everywhere", """
SELECT l_partkey, count(DISTINCT l_returnflag) AS n_targets FROM lineitem GROUP BY l_partkey HAVING n_targets = 3
""")
def delivered_everywhere(spark, sf_dir):
    return manifest.delivered_everywhere(table(spark, sf_dir, "lineitem"), "l_partkey", "l_returnflag", 3)


@query("batches", """
SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS BIGINT) AS batch FROM orders
""")
def batches(spark, sf_dir):
    return position.batches(table(spark, sf_dir, "orders").select("o_orderkey"), 1000, [F.col("o_orderkey")])


@query("batches_n", """
SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // (SELECT CAST(ceil(count(*) / 7) AS BIGINT) FROM orders) AS BIGINT) AS batch FROM orders
""")
def batches_n(spark, sf_dir):
    return position.batches_n(table(spark, sf_dir, "orders").select("o_orderkey"), 7, [F.col("o_orderkey")])


@query("range_split", """
SELECT event_id, CASE WHEN p < 5 THEN p END AS part FROM
 (SELECT event_id, CAST((row_number() OVER (ORDER BY ts, event_id) - 1) // 500 AS BIGINT) AS p FROM events)
""")
def range_split(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return position.range_split(events, 500, 5, [F.col("ts"), F.col("event_id")]).drop("ts")


@query("positions", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS position FROM lineitem")
def positions(spark, sf_dir):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return position.with_position(table(spark, sf_dir, "lineitem").select(*cols), [F.col(c) for c in cols])


def _keyed_paths(spark, sf_dir):
    """Inbound paths: plain for purchases, URL-encoded for clicks, without keys otherwise."""
    e = table(spark, sf_dir, "events")
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    inbound = F.concat(F.lit("HL7v2In/domainOid=1.2/root=R"), user, F.lit("/extension=X"), event, F.lit("/msg"), event)
    bare = F.concat(F.lit("in/"), F.col("event_type"), F.lit("/msg"), event)
    path = F.when(F.col("event_type") == "purchase", inbound).when(
        F.col("event_type") == "click", F.replace(inbound, F.lit("="), F.lit("%3D"))
    ).otherwise(bare)
    return e.select("event_id", path.alias("path"))


@query("path_keys", """
SELECT event_id, CASE event_type WHEN 'click' THEN 'Q' || user_id END AS repository_id, CASE event_type WHEN 'purchase' THEN 'R' || user_id END AS root,
 CASE event_type WHEN 'purchase' THEN 'X' || event_id END AS extension, 'msg' || event_id AS file_name FROM events
""")
def path_keys(spark, sf_dir):
    paths = _keyed_paths(spark, sf_dir).join(table(spark, sf_dir, "events").select("event_id", "event_type", "user_id"), "event_id")
    inside = F.concat(F.lit("repositoryUniqueId=Q"), "user_id", F.lit("/"), "path")
    keyed = paths.withColumn("path", F.when(F.col("event_type") == "click", inside).otherwise(F.col("path")))
    return manifest.path_keys(keyed.select("event_id", "path")).drop("path")


@query("route", """
SELECT event_id, CASE WHEN event_type IN ('purchase', 'click') THEN 'root=R' || user_id || '_extension=X' || event_id || '_msg' || event_id
 ELSE 'msg' || event_id END AS destination FROM events
""")
def route(spark, sf_dir):
    return manifest.route(_keyed_paths(spark, sf_dir)).drop("path")


@query("to_sync", f"""
SELECT user_id || '/' || event_type AS path, max(ts) AS modified FROM events WHERE event_type <> 'error'
GROUP BY user_id, event_type HAVING max(ts) >= TIMESTAMP '{MARK}'
""")
def to_sync(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    start = F.when(F.col("event_type") == "error", "airflow_tmp_").otherwise("")
    named = e.select(F.concat(start, F.col("user_id").cast("string"), F.lit("/"), F.col("event_type")).alias("path"), F.col("ts").alias("modified"))
    source = named.groupBy("path").agg(F.max("modified").alias("modified"))
    return manifest.to_sync(source, named.filter(F.col("modified") < _mark()))


@query("tagged_files", f"SELECT {PATH} AS path FROM events WHERE event_type IN ('click', 'view') AND value > 50")
def tagged_files(spark, sf_dir):
    files = table(spark, sf_dir, "events")
    done = F.when(F.col("event_type") == "click", "True").when(F.col("event_type") == "view", "true").otherwise("false")
    tag = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    tags = F.when(F.col("value") > 50, F.array(tag("CPProcessed", done), tag("CLIENTID", F.lit("1")))).otherwise(F.array(tag("CPProcessed", done)))
    listed = _listing(spark, sf_dir).select("path", "event_id").join(files.select("event_id", tags.alias("tags")), "event_id")
    return manifest.tagged(listed, also=["CLIENTID"]).select("path")


@query("prefixes", "SELECT DISTINCT event_type || '/' || strftime(ts, '%Y%m%d') || '/' || user_id || '/' AS prefix FROM events")
def prefixes(spark, sf_dir):
    return manifest.prefixes(_listing(spark, sf_dir), 3)


def _authorised(spark, sf_dir):
    """One destination row per region; two are paused, some have a name pattern."""
    key = F.col("r_regionkey")
    config = table(spark, sf_dir, "region").select(
        F.element_at(F.array(*[F.lit(t) for t in TYPES]), key + 1).alias("authorized_identifier_oid"),
        F.when(key > 2, 1).otherwise(0).alias("delivery_paused"),
        F.when(key == 0, "").otherwise("user1").alias("authorized_filter_file_beginning_pattern"),
        F.concat(F.lit(" "), F.col("r_name"), F.lit(" ")).alias("client_folder_name"),
    )
    return manifest.authorised_destinations(config.unionByName(config))


@query("authorised_destinations", """
SELECT CASE r_regionkey WHEN 0 THEN 'click' WHEN 1 THEN 'error' ELSE 'purchase' END AS authorized_identifier_oid, 0 AS delivery_paused,
 CASE WHEN r_regionkey = 0 THEN '' ELSE 'user1' END AS authorized_filter_file_beginning_pattern, r_name AS client_folder_name
FROM region WHERE r_regionkey <= 2
""")
def authorised_destinations(spark, sf_dir):
    return _authorised(spark, sf_dir)


@query("plan_deliveries", """
SELECT 'src/' || event_type || '/' || strftime(ts, '%Y%m%d') AS folder, 'user' || user_id || '_' || event_id || '.xml' AS file_name,
 r_name AS client_folder_name FROM events JOIN region ON
 r_regionkey = CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 END
WHERE strftime(ts, '%Y%m%d') IN ('20240109', '20240110') AND (event_type = 'click' OR contains('user' || user_id || '_' || event_id || '.xml', 'user1'))
""")
def plan_deliveries(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    files = e.select(
        F.concat_ws("/", F.lit("src"), "event_type", F.date_format("ts", "yyyyMMdd")).alias("folder"),
        F.concat(F.lit("user"), F.col("user_id"), F.lit("_"), F.col("event_id"), F.lit(".xml")).alias("file_name"),
    )
    planned = manifest.plan_deliveries(files, _authorised(spark, sf_dir), ["20240110", "20240109"])
    return planned.select("folder", "file_name", "client_folder_name")


@query("not_yet_delivered", f"""
SELECT event_type AS folder, event_id AS file FROM events WHERE ts >= TIMESTAMP '{MARK}' OR event_type = 'view'
""")
def not_yet_delivered(spark, sf_dir):
    from ..operators.joins import not_yet_delivered as remaining

    files = table(spark, sf_dir, "events").select(F.col("event_type").alias("folder"), F.col("event_id").alias("file"), "ts")
    sent = files.filter((F.col("ts") < _mark()) & (F.col("folder") != "view"))
    return remaining(files.drop("ts"), sent, ["folder", "file"])


@query("message_volume", """
SELECT day_timestamp, stage, stage_level, CAST(count(*) * 2 AS BIGINT) AS count FROM
 (SELECT strftime(ts, '%Y%m%d') AS day_timestamp, event_type AS stage, 'delivered' AS stage_level FROM events) GROUP BY 1, 2, 3
""")
def message_volume(spark, sf_dir):
    deliveries = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("day_timestamp"), F.col("event_type").alias("stage"), F.lit("delivered").alias("stage_level")
    )
    return manifest.message_volume(deliveries, manifest.message_volume(deliveries))


@query("prune_marks", f"SELECT {PATH} AS path FROM events WHERE strftime(ts, '%Y%m%d') IN ('20240128', '20240129')")
def prune_marks(spark, sf_dir):
    return manifest.prune_marks(_listing(spark, sf_dir).select("path"), ["20240128", "20240129"])


@query("files_between", f"SELECT {PATH} AS path FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'")
def files_between(spark, sf_dir):
    return predicates.files_between(_listing(spark, sf_dir).select("path"), "path", "2024-01-05", "2024-01-11").select("path")


# -- change detection ---------------------------------------------------------------------------

KEYS = ["user_id", "event_type"]


def _seen(spark, sf_dir):
    return table(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").alias("modified"))


def _marks(spark, sf_dir):
    return _seen(spark, sf_dir).filter((F.col("modified") < _mark()) & (F.col("event_type") != "signup"))


CHANGED_SQL = f"""
SELECT user_id, event_type, max(ts) AS modified FROM events GROUP BY user_id, event_type
HAVING max(ts) >= TIMESTAMP '{MARK}' OR event_type = 'signup'
"""


@query("changed_files", CHANGED_SQL)
def changed_files(spark, sf_dir):
    return changes.changed_files(_seen(spark, sf_dir), _marks(spark, sf_dir), KEYS)


@query("advance_marks", "SELECT user_id, event_type, max(ts) AS modified FROM events GROUP BY user_id, event_type")
def advance_marks(spark, sf_dir):
    marks = _marks(spark, sf_dir)
    changed = changes.changed_files(_seen(spark, sf_dir), marks, KEYS)
    return changes.advance_marks(marks, changed, KEYS)


@query("changed_datasets", f"""
WITH latest AS (SELECT user_id AS server, event_id AS id, ts AS updated FROM events
                QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
marks AS (SELECT user_id AS server, max(ts) AS mark FROM events WHERE ts < TIMESTAMP '2024-01-29' GROUP BY user_id)
SELECT server, id, updated FROM latest LEFT JOIN marks USING (server) WHERE updated > coalesce(mark, TIMESTAMP '1970-01-01')
""")
def changed_datasets(spark, sf_dir):
    refreshes = table(spark, sf_dir, "events").select(F.col("user_id").alias("server"), F.col("event_id").alias("id"), F.col("ts").alias("updated"))
    marks = refreshes.filter(F.col("updated") < F.lit("2024-01-29").cast("timestamp_ntz")).select("server", "updated")
    return changes.changed_datasets(refreshes, marks)


@query("changed_groupings", f"""
SELECT client, md5(CAST(client AS VARCHAR)) AS client_md5, event_timestamp, count_distinct_mpi FROM (
 SELECT user_id AS client, max(ts) AS event_timestamp, count(DISTINCT event_type) AS count_distinct_mpi,
        max(ts) FILTER (WHERE ts < TIMESTAMP '2024-01-29') AS mark FROM events GROUP BY user_id)
WHERE mark IS NULL OR event_timestamp > mark
""")
def changed_groupings(spark, sf_dir):
    grouped = table(spark, sf_dir, "events").select(F.col("user_id").alias("client"), "event_type", F.col("ts").alias("event_timestamp"))
    counts = grouped.groupBy("client").agg(F.count_distinct("event_type").alias("count_distinct_mpi"))
    marks = grouped.filter(F.col("event_timestamp") < F.lit("2024-01-29").cast("timestamp_ntz"))
    return changes.changed_groupings(grouped, counts, marks)


LAST_JOB = """
SELECT event_type || '/' || user_id AS table_name, event_id AS id, ts AS start_time,
       CASE WHEN value > 50 THEN props WHEN value > 25 THEN 'n/a' END AS end_time FROM events
"""


def _jobs(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit("/"), F.col("user_id")).alias("table_name"), F.col("event_id").alias("id"),
        F.col("ts").alias("start_time"), F.when(F.col("value") > 50, F.col("props")).when(F.col("value") > 25, "n/a").alias("end_time"),
    )


@query("last_status", f"""
SELECT * FROM ({LAST_JOB}) QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY id DESC) = 1
""")
def last_status(spark, sf_dir):
    return changes.last_status(_jobs(spark, sf_dir), "table_name", "id")


@query("overdue_jobs", f"""
SELECT * FROM (SELECT * FROM ({LAST_JOB}) QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY id DESC) = 1)
WHERE CAST(start_time AS DATE) = DATE '2024-01-29' AND (end_time IS NULL OR length(end_time) < 6)
""")
def overdue_jobs(spark, sf_dir):
    return changes.overdue_jobs(_jobs(spark, sf_dir), "2024-02-03")



@query("stuck_jobs", """
SELECT * FROM (SELECT event_id, date_sub('minute', ts, TIMESTAMP '2024-01-29 12:00:00') AS minutes FROM events WHERE event_type = 'error') WHERE minutes > 120
""")
def stuck_jobs(spark, sf_dir):
    jobs = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "error", 1).otherwise(0).alias("started_running"), F.col("ts").alias("event_timestamp"))
    return changes.stuck_jobs(jobs, "2024-01-29 12:00:00").select("event_id", "minutes")


@query("reset_stuck", """
SELECT event_id, CASE WHEN event_type = 'error' AND date_sub('minute', ts, TIMESTAMP '2024-01-29 12:00:00') <= 120 THEN 1 ELSE 0 END AS started_running FROM events
""")
def reset_stuck(spark, sf_dir):
    jobs = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "error", 1).otherwise(0).alias("started_running"), F.col("ts").alias("event_timestamp"))
    return changes.reset_stuck(jobs, "2024-01-29 12:00:00").select("event_id", "started_running")


@query("auto_approve", """
WITH f AS (SELECT user_id AS client, max((ts, event_id || '.csv')) AS m FROM events WHERE event_type = 'purchase' GROUP BY user_id),
g AS (SELECT user_id AS client, min(ts) AS t FROM events WHERE event_type = 'signup' GROUP BY user_id)
SELECT c_custkey AS client, f.m[2] AS file, f.m[1] AS modified FROM customer JOIN f ON c_custkey = f.client JOIN g ON c_custkey = g.client
WHERE c_acctbal > 0 AND c_mktsegment <> 'FURNITURE' AND f.m[1] > g.t + INTERVAL 24 HOURS
""")
def auto_approve(spark, sf_dir):
    clients = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("client"), F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("auto_approval"),
        F.when(F.col("c_mktsegment") == "FURNITURE", "Approved").otherwise("").alias("frequency"),
    )
    e = table(spark, sf_dir, "events")
    files = e.filter("event_type = 'purchase'").select(
        F.col("user_id").alias("client"), F.concat(F.col("event_id"), F.lit(".csv")).alias("file"), F.col("ts").alias("modified")
    )
    grouped = e.filter("event_type = 'signup'").select(F.col("user_id").alias("client"), F.col("ts").alias("event_timestamp"))
    return changes.auto_approve(clients, files, grouped)


@query("rows_after", "SELECT event_id, user_id FROM events WHERE event_id > 500")
def rows_after(spark, sf_dir):
    return changes.rows_after(table(spark, sf_dir, "events").select("event_id", "user_id"), 500, "event_id")


@query("unprocessed", f"SELECT {PATH} AS path FROM events WHERE ts >= TIMESTAMP '{MARK}'")
def unprocessed(spark, sf_dir):
    files = _listing(spark, sf_dir)
    loaded = files.filter(F.col("modified") < _mark()).select(F.col("path").alias("Source_File"))
    return changes.unprocessed(files.select("path"), loaded)


@query("new_snapshots", """
SELECT DISTINCT 'dir_' || strftime(ts, '%Y%m%d') || '120000.csv' AS path, CAST(ts AS DATE) AS file_date FROM events
WHERE CAST(ts AS DATE) > DATE '2024-01-10'
""")
def new_snapshots(spark, sf_dir):
    files = table(spark, sf_dir, "events").select(F.concat(F.lit("dir_"), F.date_format("ts", "yyyyMMdd"), F.lit("120000.csv")).alias("path")).distinct()
    return changes.new_snapshots(files, "2024-01-10", start="2024-01-01", earliest="2024-01-01")


@query("new_keys", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)")
def new_keys(spark, sf_dir):
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("o_custkey"))
    return changes.new_keys(table(spark, sf_dir, "orders"), users, "o_custkey")


def _directory(spark, sf_dir):
    """Suppliers as organisations: parent ``x/<nation>``, network the supplier of the same balance sign."""
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("string")
    return s.select(
        F.col("s_name").alias("Name"), key.alias("HCID"),
        F.when(F.col("s_acctbal") > 0, F.concat(F.lit("urn/"), F.col("s_nationkey"))).otherwise(F.concat(F.lit("none"), F.col("s_nationkey"))).alias("Part of HCID"),
        F.when(F.col("s_acctbal") > 5000, F.col("s_nationkey").cast("string")).alias("QHIN HCID"), F.lit("2023-01-01").alias("FirstSeenDate"),
        F.col("s_acctbal").alias("balance"),
    )


@query("directory_update", """
SELECT s.s_name AS "Name", CAST(s.s_suppkey AS VARCHAR) AS "HCID",
 CASE WHEN s.s_acctbal > 0 THEN CAST(s.s_nationkey AS VARCHAR) ELSE 'none' || s.s_nationkey END AS "Part of HCID",
 CASE WHEN s.s_acctbal > 5000 THEN CAST(s.s_nationkey AS VARCHAR) END AS "QHIN HCID",
 CASE WHEN s.s_acctbal > 8000 THEN '2024-01-31' ELSE '2023-01-01' END AS "FirstSeenDate",
 coalesce(CASE WHEN s.s_acctbal > 0 THEN p.s_name END, 'NA') AS "PartOfName", coalesce(CASE WHEN s.s_acctbal > 5000 THEN p.s_name END, 'NA') AS "QHIN_Name",
 '2024-01-31' AS file_date
FROM supplier s LEFT JOIN supplier p ON p.s_suppkey = s.s_nationkey
""")
def directory_update(spark, sf_dir):
    current = _directory(spark, sf_dir)
    previous = current.filter(F.col("balance") <= 8000)
    return changes.directory_update(current.drop("balance"), previous, "2024-01-31")


# -- tickets and logs -----------------------------------------------------------------------------

@query("ticket_priority", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN '' ELSE label END AS risk,
 CASE o_orderstatus WHEN 'P' THEN -1 ELSE CAST(ceil((n + n * 3) / 2.0) AS INTEGER) END AS impact,
 CASE WHEN o_orderstatus = 'P' THEN '' ELSE CASE label WHEN 'Critical' THEN 'crimson' WHEN 'High' THEN 'red' WHEN 'Medium' THEN 'orange' WHEN 'Low' THEN 'lime' ELSE '' END END AS colour,
 false AS parse_error
FROM (SELECT *, CAST(left(o_orderpriority, 1) AS INTEGER) AS n, CASE left(o_orderpriority, 1) WHEN '1' THEN 'Critical' WHEN '2' THEN 'High' WHEN '3' THEN 'Medium' WHEN '5' THEN 'Low' ELSE 'Other' END AS label FROM orders)
""")
def ticket_priority(spark, sf_dir):
    digit = F.left("o_orderpriority", F.lit(1))
    label = F.when(digit == "1", "Critical").when(digit == "2", "High").when(digit == "3", "Medium").when(digit == "5", "Low").otherwise("Other")
    option = F.concat(label, F.lit(" : "), digit, F.lit("-"), (digit.cast("int") * 3).cast("string"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "none").otherwise(option).alias("escalation_option"))
    return tickets.ticket_priority(rows).drop("escalation_option")


@query("shape_tickets", """
WITH s AS (SELECT o_orderkey AS id, o_orderpriority AS reason, 'P' || o_custkey AS legal, CASE o_orderstatus WHEN 'F' THEN 'L-' || (o_custkey % 100) ELSE 'x' END AS ref,
  'Order ' || o_orderkey || ' Description: ' || o_orderstatus AS d, c_name AS who FROM orders JOIN customer ON o_custkey = c_custkey),
r AS (SELECT *, row_number() OVER (ORDER BY reason) AS reason_id FROM (SELECT DISTINCT o_orderpriority AS reason FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'))
SELECT s.id, s.reason AS ticket_reason, CAST(r.reason_id AS INTEGER) AS reason_id, CASE WHEN length(ref) >= 2 THEN ref ELSE '' END AS external_ref, d AS description,
 CAST(coalesce(CASE WHEN ref LIKE 'L-%' THEN p.p_size END, 0) AS INTEGER) AS priority,
 'GID:SUP-' || s.id || ' ' || s.reason || ' Client/Participant Name: ||||||' || legal || '||| - ' || legal || CASE WHEN length(ref) > 1 THEN ' - ' || ref ELSE '' END || ' - ' || left(d, 100) || '... - Requestor: ' || who AS card_title
FROM s LEFT JOIN r ON s.reason = r.reason LEFT JOIN part p ON s.ref = 'L-' || p.p_partkey
""")
def shape_tickets(spark, sf_dir):
    both = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    support = both.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("ticket_reason"), F.concat(F.lit("P"), F.col("o_custkey")).alias("client_legal_name"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("L-"), F.col("o_custkey") % 100)).otherwise("x").alias("ticket_reference_other_system"),
        F.concat(F.lit("Order "), F.col("o_orderkey")).alias("data_extract_description"), F.col("o_orderstatus").alias("ticket_reason_extended"),
        F.col("c_name").alias("requestor_info"),
    )
    projects = table(spark, sf_dir, "part").select(
        F.concat(F.lit("L-"), F.col("p_partkey")).alias("ProjectId"), F.col("p_size").alias("Priority"), F.col("p_partkey").alias("position")
    )
    names = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("5-LOW", 4)]
    reasons = literal_rows(spark, names, "text string, reason_id int").withColumns(
        {"category": F.lit("CAT_1"), "subscribers": F.array(F.lit("nobody"))}
    )
    shaped = tickets.shape_tickets(support, projects, reasons)
    return shaped.select("id", "ticket_reason", "reason_id", "external_ref", "description", "priority", "card_title")


def _boards(spark, sf_dir):
    """Documents as boards: paragraphs are lanes, sentences cards, and words checklists."""
    card = lambda s: F.struct(F.trim(s).alias("id"), F.filter(F.split(F.trim(s), " "), lambda w: F.length(w) > 0).alias("checklists"))
    lane = lambda p: F.struct(F.transform(F.split(p, r"\."), card).alias("cards"))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("board"), F.transform(F.split("text", "\n"), lane).alias("swimlanes"))


@query("flatten_boards", """
SELECT board, lane_no, card_no, generate_subscripts(ws, 1) - 1 AS checklist_no, unnest(ws) AS checklist FROM (
 SELECT board, lane_no, card_no, list_filter(string_split(trim(card, ' '), ' '), lambda x: length(x) > 0) AS ws FROM (
  SELECT board, lane_no, generate_subscripts(cards, 1) - 1 AS card_no, unnest(cards) AS card FROM (
   SELECT board, lane_no, string_split(lane, '.') AS cards FROM (
    SELECT doc_id AS board, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS lane_no, unnest(string_split(text, chr(10))) AS lane FROM documents))))
""")
def flatten_boards(spark, sf_dir):
    flat = tickets.flatten_boards(_boards(spark, sf_dir))
    numbers = {c: F.col(c).cast("bigint") for c in ("lane_no", "card_no", "checklist_no")}
    return flat.withColumns(numbers).select("board", "lane_no", "card_no", "checklist_no", "checklist")


@query("clean_logs", """
SELECT event_id, '/logs/dev-' || event_type || '/2024/' || event_id || '.log' AS "Source_File", strftime(ts, '%Y%m%d_%H%M%S') AS "Session_ID",
 '2024-02-01 00:00:00' AS "Processing_Timestamp", 'dev-' || event_type AS server_source FROM events
""")
def clean_logs(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("/logs/dev-"), F.col("event_type"), F.lit("/2024/"), F.col("event_id"), F.lit(".log")).alias("Source_File"),
        F.concat(F.lit(" "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" ")).alias("Session_ID"),
    )
    in_year = rows.filter(logs.in_listed_year(F.col("Source_File"), ("2024", "2025")))
    return logs.clean_logs(in_year, "/logs", "2024-02-01 00:00:00")


# -- scalar expressions ---------------------------------------------------------------------------

@query("text_functions", """
SELECT c_custkey, lpad(replace(CAST(c_custkey AS VARCHAR) || '-' || c_nationkey, '-', ''), 9, '0') AS ssn,
 substring(c_name, instr(c_name, '#') + 1) AS after_hash, left(c_name, 3) AS first_3, right(c_name, 4) AS last_4,
 lower(replace(c_name, '#', '')) AS table_name, md5(c_name) AS digest, sha1(c_name || c_mktsegment) AS sha,
 CAST(CAST(round_even(c_acctbal, 0) AS BIGINT) AS VARCHAR) AS whole,
 CASE WHEN c_nationkey > 9 THEN c_mktsegment || ' ' || c_name ELSE c_name END AS joined FROM customer
""")
def text_functions(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    name = F.col("c_name")
    return c.select(
        "c_custkey", text.nine_digit_ssn(F.concat_ws("-", F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string"))).alias("ssn"),
        text.part_after(name, "#").alias("after_hash"), F.left(name, F.lit(3)).alias("first_3"), F.right(name, F.lit(4)).alias("last_4"),
        text.table_name(name).alias("table_name"), text.name_digest(name).alias("digest"), text.digest(name, F.col("c_mktsegment")).alias("sha"),
        text.whole_number_text(F.col("c_acctbal")).alias("whole"),
        text.join_present(F.array(F.when(F.col("c_nationkey") > 9, F.col("c_mktsegment")), name)).alias("joined"),
    )


@query("date_functions", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate - INTERVAL 2 MONTH, '%Y-%m') AS two_months_before,
 strftime(o_orderdate, '%Y-%m-%d') AS hl7_day, o_orderdate AS hl7_time, CAST(epoch(o_orderdate) AS BIGINT) AS seconds,
 date_sub('minute', o_orderdate, TIMESTAMP '2002-01-01') AS minutes, true AS is_date FROM orders
""")
def date_functions(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    when = F.col("o_orderdate")
    day = F.date_format(when, "yyyyMMdd")
    return o.select(
        "o_orderkey", dates.us_date_to_iso(F.date_format(when, "M/d/yyyy")).alias("iso"), dates.month_of(when, -2).alias("two_months_before"),
        dates.hl7_date(F.concat(day, F.lit("0930"))).alias("hl7_day"), dates.hl7_timestamp(F.concat(day, F.lit("0000"))).alias("hl7_time"),
        dates.epoch_seconds(when).alias("seconds"), dates.minutes_between(when, F.lit("2002-01-01").cast("timestamp_ntz")).alias("minutes"),
        dates.is_real_date(day).alias("is_date"),
    )

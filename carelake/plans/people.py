"""Identity, opt-outs, populations, erasure and data quality on the star-schema tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .registry import query, table
from ..functions import predicates
from ..operators import erase, identity, joins, optout, population, position, quality


# -- identity: events as messages, people seen before a cut-off as the master ----------------------

CUT_OFF = "2024-01-16"

KEYS_SQL = """
SELECT event_id AS message_id, CAST(user_id AS VARCHAR) AS lastname, event_type AS firstname,
       strftime(ts, '%Y-%m-%d') AS dob, left(event_type, 1) AS sex, props AS ssn, ts FROM events
"""

MASTER_SQL = f"""
SELECT lastname, firstname, dob, sex, min(message_id) AS id, arg_min(ssn, message_id) AS ssn
FROM ({KEYS_SQL}) WHERE ts < TIMESTAMP '{CUT_OFF}' GROUP BY ALL
""".replace("GROUP BY ALL", "GROUP BY lastname, firstname, dob, sex")

MASTER2_SQL = f"""
WITH master AS ({MASTER_SQL}), keyed AS ({KEYS_SQL}),
fresh AS (SELECT lastname, firstname, dob, sex, arg_min(ssn, message_id) AS ssn FROM keyed
          WHERE (lastname, firstname, dob, sex) NOT IN (SELECT (lastname, firstname, dob, sex) FROM master)
          GROUP BY lastname, firstname, dob, sex)
SELECT * FROM master UNION ALL BY NAME
SELECT *, (SELECT max(id) FROM master) + row_number() OVER (ORDER BY lastname, firstname, dob, sex) AS id FROM fresh
"""


def _records(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("message_id"),
        F.col("user_id").cast("string").alias("lastname"),
        F.col("event_type").alias("firstname"),
        F.date_format("ts", "yyyy-MM-dd").alias("dob"),
        F.left("event_type", F.lit(1)).alias("sex"),
        F.col("props").alias("ssn"),
        "ts",
    )


def _master(spark, sf_dir) -> DataFrame:
    before = _records(spark, sf_dir).filter(F.col("ts") < F.lit(CUT_OFF).cast("timestamp_ntz"))
    return before.groupBy(*identity.IDENTITY).agg(
        F.min("message_id").alias("id"), F.min_by("ssn", "message_id").alias("ssn")
    )


def _resolved(spark, sf_dir):
    return identity.resolve_identities(_records(spark, sf_dir).drop("ts"), _master(spark, sf_dir))


@query("match_identities", f"""
SELECT k.lastname, k.firstname, k.dob, k.sex, max(m.id) AS mpi FROM ({KEYS_SQL}) k
LEFT JOIN ({MASTER_SQL}) m ON k.lastname = m.lastname AND k.firstname = m.firstname AND k.dob = m.dob AND k.sex = m.sex
GROUP BY k.lastname, k.firstname, k.dob, k.sex
""")
def match_identities(spark, sf_dir):
    return identity.match_identities(_records(spark, sf_dir), _master(spark, sf_dir))


@query("resolve_identities", f"""
SELECT k.message_id, m.id AS mpi FROM ({KEYS_SQL}) k JOIN ({MASTER2_SQL}) m
ON k.lastname = m.lastname AND k.firstname = m.firstname AND k.dob = m.dob AND k.sex = m.sex
""")
def resolve_identities(spark, sf_dir):
    return _resolved(spark, sf_dir)[0].select("message_id", "mpi")


@query("resolve_identities_master", f"SELECT id, lastname, firstname, dob, sex, ssn FROM ({MASTER2_SQL})")
def resolve_identities_master(spark, sf_dir):
    return _resolved(spark, sf_dir)[1].select("id", *identity.IDENTITY, "ssn")


def _any_case(df: DataFrame, upper: Column, *cols: str) -> DataFrame:
    return df.withColumns({c: F.when(upper, F.upper(c)).otherwise(F.col(c)) for c in cols})


@query("resolve_identities_any_case", f"""
SELECT k.message_id, m.id AS mpi FROM ({KEYS_SQL}) k JOIN ({MASTER2_SQL}) m
ON k.lastname = m.lastname AND k.firstname = m.firstname AND k.dob = m.dob AND k.sex = m.sex
""")
def resolve_identities_any_case(spark, sf_dir):
    """Every other record, and every third master row, is written in capitals; nobody is doubled."""
    records = _any_case(_records(spark, sf_dir).drop("ts"), F.col("message_id") % 2 == 0, "firstname", "sex")
    master = _any_case(_master(spark, sf_dir), F.col("id") % 3 == 0, "firstname", "sex")
    return identity.resolve_identities(records, master, case_insensitive=True)[0].select("message_id", "mpi")


@query("check_no_nulls", f"""
SELECT count(*) AS n_rows, 0::BIGINT AS n_null, true AS passed FROM ({KEYS_SQL})
""")
def check_no_nulls(spark, sf_dir):
    return quality.check_no_nulls(_resolved(spark, sf_dir)[0], "mpi")


@query("identity_messages", """
SELECT CAST(user_id AS VARCHAR) AS person, CAST(chunk AS BIGINT) AS chunk,
       string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS messages
FROM (SELECT *, (row_number() OVER (PARTITION BY CAST(user_id AS VARCHAR) ORDER BY event_id) - 1) // 100 AS chunk FROM events)
GROUP BY user_id, chunk
""")
def identity_messages(spark, sf_dir):
    pairs = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("person"), "event_id")
    lists = position.chunked_lists(pairs, "person", "event_id", 100, [F.col("event_id")], "messages")
    return lists.withColumn("messages", F.array_join(F.col("messages").cast("array<string>"), ","))


def _parts(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("MPI"), F.col("p_name").alias("first_name"), F.col("p_brand").alias("last_name"),
        F.col("p_type").alias("dob"), F.left("p_type", F.lit(1)).alias("sex"),
    )


@query("collapse_duplicates", """
SELECT max(p_partkey) OVER (PARTITION BY p_name, p_brand, p_type) AS MPI, p_name AS first_name,
       p_brand AS last_name, p_type AS dob, left(p_type, 1) AS sex FROM part
""")
def collapse_duplicates(spark, sf_dir):
    return identity.collapse_duplicates(_parts(spark, sf_dir))


@query("collapse_duplicates_adjacent", """
SELECT CASE WHEN p_name = lag(p_name) OVER w AND p_brand = lag(p_brand) OVER w AND p_type = lag(p_type) OVER w
            THEN greatest(p_partkey, lag(p_partkey) OVER w) ELSE p_partkey END AS MPI,
       p_name AS first_name, p_brand AS last_name, p_type AS dob, left(p_type, 1) AS sex
FROM part WINDOW w AS (ORDER BY p_partkey)
""")
def collapse_duplicates_adjacent(spark, sf_dir):
    return identity.collapse_duplicates(_parts(spark, sf_dir), mode="adjacent")


@query("previous_row", """
SELECT event_id, lag(event_id) OVER (ORDER BY ts, event_id) AS prev_event_id,
       lag(event_type) OVER (ORDER BY ts, event_id) AS prev_event_type FROM events
""")
def previous_row(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    order = [F.col("ts"), F.col("event_id")]
    return position.with_previous(events, order, ["event_id", "event_type"]).select(
        "event_id", "prev_event_id", "prev_event_type"
    )


@query("distinct_mpi", """
SELECT DISTINCT o_custkey AS mpi_int, CAST(o_custkey AS VARCHAR) AS "MPI" FROM orders WHERE o_custkey NOT IN (1, 13)
""")
def distinct_mpi(spark, sf_dir):
    return identity.distinct_mpi(table(spark, sf_dir, "orders"), "o_custkey")


@query("distinct_mpi_is_stale", """
SELECT n_new, n_current, n_new <> n_current AS stale FROM
  (SELECT count(DISTINCT o_custkey) AS n_new FROM orders WHERE o_custkey NOT IN (1, 13)),
  (SELECT count(*) AS n_current FROM customer)
""")
def distinct_mpi_is_stale(spark, sf_dir):
    return identity.distinct_mpi_is_stale(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), "o_custkey")


# -- opt-outs: one request per order, customers as the people --------------------------------------

PEOPLE_SQL = """
SELECT c_custkey AS id, c_mktsegment AS firstname, c_name AS lastname,
       strftime(DATE '1950-01-01' + c_nationkey * 100, '%Y-%m-%d') AS dob, left(c_mktsegment, 1) AS sex,
       lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS ssn FROM customer
"""

SANITIZED_SQL = """
SELECT o_orderkey AS id, c_mktsegment AS fname,
       CASE o_orderstatus WHEN 'F' THEN c_name ELSE left(c_name, 3) || ' ' || o_orderstatus END AS lname,
       strftime(DATE '1950-01-01' + c_nationkey * 100, '%Y-%m-%d') AS dob, left(c_mktsegment, 1) AS sex,
       lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS ssn,
       o_orderpriority AS respective_mrn, 'out' AS opt_choice, o_orderstatus AS status
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 100000 AND o_custkey % 3 <> 0
"""


def _people(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("firstname"), F.col("c_name").alias("lastname"),
        F.date_add(F.lit("1950-01-01").cast("date"), F.col("c_nationkey") * 100).cast("string").alias("dob"),
        F.left("c_mktsegment", F.lit(1)).alias("sex"), F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("ssn"),
    )


def _raw_opt_outs(spark, sf_dir):
    """Requests with a US date for finished orders, an ISO date otherwise, and a dashed number."""
    both = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    done = F.col("o_orderstatus") == "F"
    day = F.date_add(F.lit("1950-01-01").cast("date"), F.col("c_nationkey") * 100)
    number = F.lpad(F.col("c_custkey").cast("string"), 9, "0")
    return both.select(
        F.col("o_orderkey").alias("id"), F.col("c_mktsegment").alias("fname"),
        F.when(done, F.col("c_name")).otherwise(
            F.concat(F.left("c_name", F.lit(3)), F.lit(" "), F.col("o_orderstatus"))
        ).alias("lname"),
        F.when(done, F.date_format(day, "M/d/yyyy")).otherwise(day.cast("string")).alias("dob"),
        F.left("c_mktsegment", F.lit(1)).alias("sex"),
        F.concat(F.left(number, F.lit(3)), F.lit("-"), F.substring(number, 4, 2), F.lit("-"), F.right(number, F.lit(4))).alias("ssn"),
        F.col("o_orderpriority").alias("respective_mrn"),
        F.when((F.col("o_totalprice") > 100000) & (F.col("o_custkey") % 3 != 0), "out").otherwise("in").alias("opt_choice"),
        F.col("o_orderstatus").alias("status"),
    )


def _opt_outs(spark, sf_dir):
    return optout.sanitize_opt_outs(_raw_opt_outs(spark, sf_dir))


@query("sanitize_opt_outs", SANITIZED_SQL)
def sanitize_opt_outs(spark, sf_dir):
    return _opt_outs(spark, sf_dir)


@query("sanitize_opt_outs_text", SANITIZED_SQL.replace("'out' AS", "CASE WHEN o_totalprice > 100000 AND o_custkey % 3 <> 0 THEN 'out' ELSE 'in' END AS")
       .replace("WHERE o_totalprice > 100000 AND o_custkey % 3 <> 0", ""))
def sanitize_opt_outs_text(spark, sf_dir):
    raw = _raw_opt_outs(spark, sf_dir)
    loaded = raw.withColumn("dob", F.when(F.contains("dob", F.lit("-")), F.concat("dob", F.lit("T00:00:00"))).otherwise(F.col("dob")))
    return optout.sanitize_opt_outs_text(loaded)


STANDARD_ON = "o.lname = p.lastname AND o.fname = p.firstname AND o.dob = p.dob AND o.sex = p.sex"
SPECIAL_ON = (
    "left(o.lname, 3) = left(p.lastname, 3) AND o.fname = p.firstname AND o.dob = p.dob AND o.sex = p.sex "
    "AND right(o.ssn, 4) = right(p.ssn, 4)"
)


def _match_sql(on: str, method: str, join: str) -> str:
    return f"SELECT o.*, p.id AS mpi, '{method}' AS match_method FROM ({SANITIZED_SQL}) o {join} ({PEOPLE_SQL}) p ON {on}"


@query("match_standard", _match_sql(STANDARD_ON, "standard", "LEFT JOIN"))
def match_standard(spark, sf_dir):
    return optout.match_by(optout.STANDARD, _opt_outs(spark, sf_dir), _people(spark, sf_dir))


@query("match_special", _match_sql(SPECIAL_ON, "special1", "JOIN"))
def match_special(spark, sf_dir):
    return optout.match_by(optout.SPECIAL, _opt_outs(spark, sf_dir), _people(spark, sf_dir), keep_unmatched=False)


@query("match_special_split", _match_sql(SPECIAL_ON, "special1", "LEFT JOIN"))
def match_special_split(spark, sf_dir):
    """Identities of more than four matches are dealt out over a grid."""
    return optout.match_by(optout.SPECIAL, _opt_outs(spark, sf_dir), _people(spark, sf_dir), pairs=4)


@query("heavy_identities", f"""
SELECT o.fname, o.dob, o.sex, s4 AS ssn4, n_left, count(*) AS n_right FROM ({PEOPLE_SQL}) p JOIN (
 SELECT fname, dob, sex, left(lname, 3) AS l3, right(ssn, 4) AS s4, count(*) AS n_left FROM ({SANITIZED_SQL}) GROUP BY ALL) o
 ON left(lastname, 3) = l3 AND p.firstname = o.fname AND p.dob = o.dob AND p.sex = o.sex AND right(p.ssn, 4) = s4
GROUP BY o.fname, o.dob, o.sex, s4, n_left, l3 HAVING n_left * count(*) > 8
""")
def heavy_identities(spark, sf_dir):
    heavy = optout.heavy_identities(optout.SPECIAL, _opt_outs(spark, sf_dir), _people(spark, sf_dir), pairs=8)
    return heavy.select(F.col("_k2").alias("fname"), F.col("_k3").alias("dob"), F.col("_k4").alias("sex"), F.col("_k5").alias("ssn4"), "n_left", "n_right")


def _list_sql(join: str) -> str:
    return f"""
SELECT mpi, fname, lname, dob, sex, ssn, respective_mrn, opt_choice, status,
       string_agg(DISTINCT match_method, ',' ORDER BY match_method) AS match_methods
FROM ({_match_sql(STANDARD_ON, 'standard', join)} UNION ALL {_match_sql(SPECIAL_ON, 'special1', join)})
GROUP BY mpi, fname, lname, dob, sex, ssn, respective_mrn, opt_choice, status
"""


@query("match_opt_outs", _list_sql("LEFT JOIN"))
def match_opt_outs(spark, sf_dir):
    return optout.match_opt_outs(_opt_outs(spark, sf_dir), _people(spark, sf_dir))


@query("match_opt_outs_found", _list_sql("JOIN"))
def match_opt_outs_found(spark, sf_dir):
    return optout.match_opt_outs(_opt_outs(spark, sf_dir), _people(spark, sf_dir), keep_unmatched=False)


OPTED_OUT_SQL = f"""
SELECT DISTINCT p.id AS mpi FROM ({SANITIZED_SQL}) o JOIN ({PEOPLE_SQL}) p ON ({STANDARD_ON})
UNION SELECT DISTINCT p.id FROM ({SANITIZED_SQL}) o JOIN ({PEOPLE_SQL}) p ON ({SPECIAL_ON})
"""


@query("opted_out_ids", OPTED_OUT_SQL)
def opted_out_ids(spark, sf_dir):
    return optout.opted_out_ids(_opt_outs(spark, sf_dir), _people(spark, sf_dir))


@query("suppress", f"SELECT id AS mpi, lastname FROM ({PEOPLE_SQL}) WHERE id NOT IN ({OPTED_OUT_SQL})")
def suppress(spark, sf_dir):
    people = _people(spark, sf_dir).select(F.col("id").alias("mpi"), "lastname")
    return joins.suppress(people, optout.opted_out_ids(_opt_outs(spark, sf_dir), _people(spark, sf_dir)), "mpi", ("nan", "999999999999999"))


@query("shrink_opt_outs", """
SELECT o_custkey AS mpi, o_orderpriority AS respective_mrn, o_orderkey AS id, o_orderdate AS last_update_php FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def shrink_opt_outs(spark, sf_dir):
    listed = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("mpi"), F.col("o_orderpriority").alias("respective_mrn"),
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("last_update_php"),
    )
    return optout.shrink_opt_outs(listed, ["mpi", "respective_mrn"])


@query("tagged_union", """
SELECT source, count(*) AS n, count(DISTINCT nation) AS n_nations FROM (
  SELECT c_nationkey AS nation, 'customer' AS source FROM customer
  UNION ALL SELECT s_nationkey, 'supplier' FROM supplier) GROUP BY source
""")
def tagged_union(spark, sf_dir):
    frames = {
        "customer": table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")),
        "supplier": table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation")),
    }
    both = optout.tagged_union(frames, "source")
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("nation").alias("n_nations"))


@query("union_distinct", "SELECT l_suppkey AS id FROM lineitem UNION SELECT s_suppkey FROM supplier")
def union_distinct(spark, sf_dir):
    return optout.union_distinct(
        table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("id")),
        table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id")),
    )


# -- populations: regions as clients, their nations as facilities ----------------------------------

AS_OF = "2000-01-01"

POPULATION_SQL = f"""
WITH people AS (
  SELECT c_custkey AS "MPI", c_mktsegment AS first_name, 'N' || c_nationkey AS last_name,
         CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS VARCHAR) AS dob,
         CASE WHEN c_acctbal < 0 THEN '' ELSE left(c_mktsegment, 1) END AS sex FROM customer),
wanted AS (
  SELECT DISTINCT r_name AS client, o_custkey AS "MPI" FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE o_orderdate > TIMESTAMP '1998-07-01' AND o_custkey NOT IN ({OPTED_OUT_SQL}))
SELECT client, max("MPI") AS "MPI", first_name, last_name, dob, sex FROM wanted JOIN people USING ("MPI")
WHERE sex <> '' GROUP BY client, first_name, last_name, dob, sex
"""


def _visits(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").alias("MPI"), F.col("c_nationkey").alias("unit_id"), F.col("o_orderdate").alias("admitted")
    )


def _clients(spark, sf_dir):
    """One client per region; the list is bounded by the 25 nations."""
    both = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return both.groupBy(F.col("r_name").alias("client")).agg(
        F.array_join(F.sort_array(F.collect_list(F.col("n_nationkey").cast("string"))), "|").alias("facility_ids")
    )


def _demographics(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("MPI"), F.col("c_mktsegment").alias("first_name"),
        F.concat(F.lit("N"), F.col("c_nationkey")).alias("last_name"),
        F.floor(F.col("c_acctbal") / 100).cast("string").alias("dob"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(F.left("c_mktsegment", F.lit(1))).alias("sex"),
    )


def _population(spark, sf_dir, mode="identity"):
    opt_outs = optout.opted_out_ids(_opt_outs(spark, sf_dir), _people(spark, sf_dir)).withColumnRenamed("mpi", "MPI")
    return population.build_population(
        _visits(spark, sf_dir), _demographics(spark, sf_dir), opt_outs, _clients(spark, sf_dir), AS_OF, mode=mode
    )


def _servers(spark, sf_dir):
    return table(spark, sf_dir, "region").select(F.col("r_name").alias("client"), F.col("r_regionkey").alias("server_id"))


@query("build_population", POPULATION_SQL)
def build_population(spark, sf_dir):
    return _population(spark, sf_dir)


@query("groupings", f"""
SELECT DISTINCT client, "MPI", r_regionkey AS server_id FROM ({POPULATION_SQL}) JOIN region ON client = r_name
""")
def groupings(spark, sf_dir):
    return population.groupings(_population(spark, sf_dir), _servers(spark, sf_dir))


@query("crosswalk", f"""
SELECT client, "MPI", r_regionkey AS server_id, '' AS visit_reference_accid, dob
FROM ({POPULATION_SQL}) JOIN region ON client = r_name WHERE length(CAST("MPI" AS VARCHAR)) > 1
""")
def crosswalk(spark, sf_dir):
    return population.crosswalk(_population(spark, sf_dir), _servers(spark, sf_dir), identifiers=["dob"])


@query("running_counts", f"""
SELECT client, r_regionkey AS server_id, count(DISTINCT "MPI") AS count_distinct_mpi
FROM ({POPULATION_SQL}) JOIN region ON client = r_name GROUP BY client, r_regionkey
""")
def running_counts(spark, sf_dir):
    return population.running_counts(population.groupings(_population(spark, sf_dir), _servers(spark, sf_dir)))


@query("replace_client_slice", """
SELECT c_mktsegment AS client, c_custkey FROM customer WHERE c_mktsegment NOT IN (SELECT c_mktsegment FROM customer WHERE c_nationkey = 3 AND c_acctbal < 0)
UNION ALL SELECT c_mktsegment, c_custkey FROM customer WHERE c_nationkey = 3 AND c_acctbal < 0
""")
def replace_client_slice(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    whole = customer.select(F.col("c_mktsegment").alias("client"), "c_custkey")
    fresh = customer.filter("c_nationkey = 3 and c_acctbal < 0").select(F.col("c_mktsegment").alias("client"), "c_custkey")
    return population.replace_client_slice(whole, fresh)


@query("groupings_of_clients", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""")
def groupings_of_clients(spark, sf_dir):
    live = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return joins.groupings_of_clients(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), live, "o_custkey")


@query("groupings_export", """
SELECT DISTINCT o_custkey AS client, o_orderpriority AS mpi FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'
  AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""")
def groupings_export(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("client"), F.col("o_orderpriority").alias("mpi"), "o_orderstatus")
    approved = orders.filter("o_orderstatus = 'F'").drop("o_orderstatus").distinct()
    others = orders.filter("o_orderstatus <> 'F'").drop("o_orderstatus")
    not_live = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("client"))
    return approved.unionByName(joins.groupings_of_clients(others, not_live, "client"))


@query("exclude_listed", """
SELECT l_orderkey, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size = 1)
""")
def exclude_listed(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return joins.exclude_listed(lines, "l_partkey", table(spark, sf_dir, "part").filter("p_size = 1"), "p_partkey")


@query("lookup_default", """
SELECT c_custkey, coalesce(s, 'NA') AS supplier FROM customer
LEFT JOIN (SELECT s_suppkey, max(s_name) AS s FROM supplier GROUP BY s_suppkey) ON c_custkey = s_suppkey
""")
def lookup_default(spark, sf_dir):
    return joins.lookup(
        table(spark, sf_dir, "customer").select("c_custkey"), F.col("c_custkey"), table(spark, sf_dir, "supplier"),
        "s_suppkey", "s_name", "supplier", "NA",
    )


@query("enrich_demographics", """
SELECT o_orderkey, o_custkey, c_mktsegment, c_nationkey FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""")
def enrich_demographics(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    people = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return joins.enrich(orders, people, "o_custkey", ["c_mktsegment", "c_nationkey"])


@query("upsert", """
WITH ch AS (SELECT o_custkey AS id, o_orderstatus AS flag,
              CASE WHEN o_orderstatus = 'P' THEN '' WHEN o_orderstatus = 'O' AND o_custkey % 2 = 0 THEN 'xy' ELSE o_orderpriority END AS label
            FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1),
t AS (SELECT s_suppkey AS id, s_name AS label, 'x' AS flag FROM supplier)
SELECT coalesce(t.id, ch.id) AS id, CASE WHEN length(ch.label) > 2 THEN ch.label ELSE t.label END AS label,
       CASE WHEN ch.id IS NOT NULL THEN ch.flag ELSE t.flag END AS flag
FROM t FULL JOIN (SELECT * FROM ch WHERE length(label) <> 2) ch ON t.id = ch.id
""")
def upsert(spark, sf_dir):
    """Labels are long (all columns written), empty (only the flag) or of two letters (ignored)."""
    target = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("label"), F.lit("x").alias("flag"))
    last = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("id"))
        .agg(F.max(F.struct("o_orderkey", "o_orderpriority", "o_orderstatus")).alias("_l"))
    )
    status = F.col("_l.o_orderstatus")
    label = F.when(status == "P", "").when((status == "O") & (F.col("id") % 2 == 0), "xy").otherwise(F.col("_l.o_orderpriority"))
    changes = last.select("id", label.alias("label"), status.alias("flag"))
    return joins.upsert(target, changes, "id", ["label", "flag"], ["label"], ["flag"])


# -- panels ---------------------------------------------------------------------------------------

PANEL_SQL = """
SELECT c_custkey, c_mktsegment AS "Patient First Name", CASE WHEN c_acctbal < 0 THEN c_name ELSE c_mktsegment END AS "Patient Last Name",
       '1950-02-' || lpad(CAST(c_nationkey + 10 AS VARCHAR), 2, '0') AS "DOB", left(c_mktsegment, 1) AS "Gender",
       c_name AS "Residential Address", 'City ' || c_nationkey AS "City", 'S' || c_nationkey AS "State",
       CAST(c_nationkey AS VARCHAR) AS "Zip Code", CAST(c_custkey AS VARCHAR) AS "Insurance ID", c_mktsegment AS "CustomText1",
       'F' || c_nationkey AS "Attributed Facility Provider First Name", 'L' || c_nationkey AS "Attributed Facility Provider Last Name",
       CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS "Attributed Provider NPI" FROM customer
"""


def _panel(spark, sf_dir):
    nation = F.col("c_nationkey").cast("string")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("Patient First Name"),
        F.when(F.col("c_acctbal") < 0, F.col("c_name")).otherwise(F.col("c_mktsegment")).alias("Patient Last Name"),
        F.concat(F.lit("1950-02-"), F.lpad((F.col("c_nationkey") + 10).cast("string"), 2, "0")).alias("DOB"),
        F.left("c_mktsegment", F.lit(1)).alias("Gender"), F.col("c_name").alias("Residential Address"),
        F.concat(F.lit("City "), nation).alias("City"), F.concat(F.lit("S"), nation).alias("State"),
        nation.alias("Zip Code"), F.col("c_custkey").cast("string").alias("Insurance ID"),
        F.col("c_mktsegment").alias("CustomText1"),
        F.concat(F.lit("F"), nation).alias("Attributed Facility Provider First Name"),
        F.concat(F.lit("L"), nation).alias("Attributed Facility Provider Last Name"),
        F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("Attributed Provider NPI"),
    )


@query("validate_panel", """
SELECT c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS npi,
       concat_ws(',', CASE WHEN c_acctbal < 0 THEN 'last_name' END, CASE WHEN c_nationkey + 10 > 28 THEN 'date_of_birth' END) AS errors
FROM customer
""")
def validate_panel(spark, sf_dir):
    checked = quality.validate_panel(_panel(spark, sf_dir))
    return checked.select("c_custkey", "npi", F.array_join("errors", ",").alias("errors"))


PANEL_POPULATION_SQL = f"""
WITH m AS (SELECT "Patient First Name" AS f, "Patient Last Name" AS l, "DOB" AS d, "Gender" AS g, max(c_custkey) AS mpi
           FROM ({PANEL_SQL}) GROUP BY f, l, d, g)
SELECT m.mpi, f AS first_name, l AS last_name, strftime(CAST(d AS DATE), '%m/%d/%Y') AS dob, g AS sex,
       "Residential Address" AS street1, "City", "State", "Zip Code" AS zip, "Insurance ID" AS ins_member_id,
       "CustomText1" AS client_identifier, "Attributed Facility Provider First Name" AS provider_first_name,
       'placeholder_id' AS client_identifier_2
FROM ({PANEL_SQL}) p JOIN m ON f = "Patient First Name" AND l = "Patient Last Name" AND d = "DOB" AND g = "Gender"
JOIN customer c ON c.c_custkey = p.c_custkey
WHERE c.c_acctbal >= 0 AND c.c_nationkey + 10 <= 28 AND mpi >= 10
"""


@query("panel_population", PANEL_POPULATION_SQL)
def panel_population(spark, sf_dir):
    panel = _panel(spark, sf_dir)
    master = panel.select(
        F.col("c_custkey").alias("id"), F.col("Patient First Name").alias("firstname"),
        F.col("Patient Last Name").alias("lastname"), F.col("DOB").alias("dob"), F.col("Gender").alias("sex"),
    )
    return population.panel_population(panel, master, skip_invalid=True)


@query("panel_population_any_case", PANEL_POPULATION_SQL)
def panel_population_any_case(spark, sf_dir):
    panel = _panel(spark, sf_dir)
    master = panel.select(
        F.col("c_custkey").alias("id"), F.lower("Patient First Name").alias("firstname"),
        F.lower("Patient Last Name").alias("lastname"), F.col("DOB").alias("dob"), F.lower("Gender").alias("sex"),
    )
    return population.panel_population(panel, master, skip_invalid=True, case_insensitive=True)


@query("panel_plus_visits", """
SELECT c_custkey AS mpi FROM customer WHERE c_acctbal < 0
UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'
""")
def panel_plus_visits(spark, sf_dir):
    panel = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("mpi"))
    visits = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("mpi"))
    return population.panel_plus_visits(panel, visits)


@query("attribution_file", f"""
SELECT CASE WHEN c_custkey = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS "Unique Patient ID",
       NULL::VARCHAR AS "Secondary Client ID", "Patient First Name", NULL::VARCHAR AS "Patient Middle Initial",
       "Patient Last Name", NULL::VARCHAR AS "Patient Name Suffix",
       strftime(TRY_CAST("DOB" AS DATE), '%m/%d/%Y') AS "Patient Date of Birth", "Gender",
       NULL::VARCHAR AS "SSN - Last 4", "Residential Address" AS "Patient Address 1", NULL::VARCHAR AS "Patient Address 2",
       "City" AS "Patient City", "State" AS "Patient State", "Zip Code" AS "Patient Zip",
       NULL::VARCHAR AS "Patient Phone - Mobile", NULL::VARCHAR AS "Patient Phone - Home",
       "Attributed Provider NPI" AS "Attributed Physician NPI",
       "Attributed Facility Provider First Name" AS "Attributed Physician First Name",
       "Attributed Facility Provider Last Name" AS "Attributed Physician Last Name",
       NULL::VARCHAR AS "Attributed Practice Unit OID", NULL::VARCHAR AS "Attributed Practice Unit Name",
       '1.2.3' AS "Managing Organization OID", 'Example HIE' AS "Managing Organization Name",
       'notify' AS "Service Delivery Preferences", NULL::VARCHAR AS "Common Key"
FROM ({PANEL_SQL})
""")
def attribution_file(spark, sf_dir):
    panel = _panel(spark, sf_dir).withColumnRenamed("c_custkey", "mpi")
    return population.attribution_file(panel, "1.2.3", "Example HIE", "notify")


@query("clients_due", """
SELECT o_orderkey, o_orderpriority AS frequency FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice > 100000 AND o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def clients_due(spark, sf_dir):
    queue = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("folder_name"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("active"),
        F.when(F.col("o_totalprice") > 100000, 1).otherwise(0).alias("airflow"), F.col("o_orderpriority").alias("frequency"),
    )
    return predicates.clients_due(queue, ["1-URGENT", "2-HIGH"]).select("o_orderkey", "frequency")


@query("reset_requests", """
SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'P') THEN '' ELSE o_orderstatus END AS frequency FROM orders
""")
def reset_requests(spark, sf_dir):
    names = F.when(F.col("o_orderstatus") == "F", "Approved").when(F.col("o_orderstatus") == "P", "Revised").otherwise(F.col("o_orderstatus"))
    return population.reset_requests(table(spark, sf_dir, "orders").select("o_orderkey", names.alias("frequency")))


# -- erasure and checks -----------------------------------------------------------------------------

def _erasure_keys(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))


@query("find_ids", """
SELECT l_partkey AS id FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'P'
UNION ALL SELECT l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT'
""")
def find_ids(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "id")
    return erase.find_ids(lines, [_erasure_keys(spark, sf_dir), urgent], "l_orderkey")


@query("erase", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
""")
def erase_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return erase.erase(lines, _erasure_keys(spark, sf_dir), "l_orderkey")


@query("erase_report", """
SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS rows_before,
       count(*) FILTER (WHERE o_orderstatus = 'P') AS rows_removed,
       count(*) - count(*) FILTER (WHERE o_orderstatus = 'P') AS rows_after
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
""")
def erase_report(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    return erase.erase_report(lines, _erasure_keys(spark, sf_dir), "l_orderkey", "month")


@query("delete_batches", """
SELECT o_orderkey AS id, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 500 AS BIGINT) AS batch FROM orders
""")
def delete_batches(spark, sf_dir):
    return erase.delete_batches(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")))


@query("check_unique", "SELECT o_custkey, o_orderdate, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def check_unique(spark, sf_dir):
    return quality.check_unique(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"])


@query("check_cardinality", """
SELECT l_partkey, count(DISTINCT l_suppkey) AS n_distinct FROM lineitem GROUP BY l_partkey HAVING n_distinct <> 1
""")
def check_cardinality(spark, sf_dir):
    return quality.check_cardinality(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


@query("drop_sentinels", "SELECT c_custkey FROM customer WHERE c_mktsegment NOT IN ('FURNITURE', 'nan')")
def drop_sentinels(spark, sf_dir):
    kept = predicates.drop_sentinels(table(spark, sf_dir, "customer"), "c_mktsegment", ["FURNITURE", "nan"])
    return kept.select("c_custkey")


@query("in_delimited", "SELECT c_custkey FROM customer WHERE c_nationkey IN (1, 5, 7, 24)")
def in_delimited(spark, sf_dir):
    wanted = predicates.in_delimited(F.col("c_nationkey").cast("string"), "1|5,7|24")
    return table(spark, sf_dir, "customer").filter(wanted).select("c_custkey")


@query("join_delimited", """
SELECT r_name AS client, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def join_delimited(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return predicates.join_delimited(customer, "c_nationkey", _clients(spark, sf_dir), "facility_ids", ["client"]).select("client", "c_custkey")


@query("state_code_spellings", """
SELECT s_suppkey, CASE s_nationkey WHEN 1 THEN 'Alabama' WHEN 2 THEN 'Alaska' WHEN 4 THEN 'Arizona' WHEN 5 THEN 'Arkansas'
 WHEN 6 THEN 'California' WHEN 8 THEN 'Colorado' WHEN 9 THEN 'Connecticut' WHEN 10 THEN 'Delaware' WHEN 11 THEN 'District of Columbia'
 WHEN 12 THEN 'Florida' WHEN 13 THEN 'Georgia' WHEN 15 THEN 'Hawaii' WHEN 16 THEN 'Idaho' WHEN 17 THEN 'Illinois' WHEN 18 THEN 'Indiana'
 WHEN 19 THEN 'Iowa' WHEN 20 THEN 'Kansas' WHEN 21 THEN 'Kentucky' WHEN 22 THEN 'Louisiana' WHEN 23 THEN 'Maine' WHEN 24 THEN 'Maryland'
 ELSE 'UNKNOWN' END AS state FROM supplier
""")
def state_code_spellings(spark, sf_dir):
    from ..functions.state_codes import state_crosswalk
    from ..operators.residence import standardize

    raw = table(spark, sf_dir, "supplier").select("s_suppkey", F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("raw_state"))
    return standardize(raw, "raw_state", state_crosswalk(spark), "state").drop("raw_state")


# Spellings beside the rule, and what they stand for, one for each nation number.
BESIDE = [
    ("Ari", "Arizona"),
    ("ARK", "Arkansas"),
    (" CA", "California"),
    ("06810", "Connecticut"),
    ("Ga ", "Georgia"),
    ("Ill", "Illinois"),
    ("kANSAS", "Kansas"),
    ("KS - KANSAS", "Kansas"),
    ("71082", "Louisiana"),
    ("MICH", "Michigan"),
    ("Min", "Minnesota"),
    ("MO 64106", "Missouri"),
    ("Mon", "Montana"),
    ("Okl", "Oklahoma"),
    ("TX.", "Texas"),
    ("On", "Canada"),
    ("Au", "Australia"),
    ("Czechia", "Czech Republic"),
    ("GE", "Georgia"),
    ("Jalisco", "Mexico"),
    ("nA", "Namibia"),
    ("N.L.", "Netherlands"),
    ("uk", "United Kingdom"),
    ("RUSSIA", "Russia"),
    ("Nowhere", "UNKNOWN"),
]


@query("state_code_irregular", f"SELECT c_custkey, [{', '.join(repr(name) for _, name in BESIDE)}][c_nationkey + 1] AS state FROM customer")
def state_code_irregular(spark, sf_dir):
    from ..functions.state_codes import state_crosswalk
    from ..operators.residence import standardize

    spelling = F.element_at(F.array(*[F.lit(raw) for raw, _ in BESIDE]), (F.col("c_nationkey") + 1).cast("int"))
    raw = table(spark, sf_dir, "customer").select("c_custkey", spelling.alias("raw_state"))
    return standardize(raw, "raw_state", state_crosswalk(spark), "state").drop("raw_state")

"""Readers and sinks on texts and files written from the given tables, with the shapes found in practice:
several headers in a folder, files to skip, files of one name in many folders, snapshots by date."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from . import hl7_messages
from .documents import document_text
from .hl7_messages import message_text
from .people import _panel
from .registry import ORACLES, query, table
from ..operators import ccda, hl7v2, lookback, quality
from ..session import shared_folder
from ..sources import files, sinks


def _one_csv(rows, folder: str, header: bool = True) -> None:
    """CSV files that all bear the same header."""
    rows.write.mode("overwrite").option("header", header).csv(folder)


@query("csv_dir_mixed", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name || chr(10) || 'x' AS name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segment
FROM customer
""")
def csv_dir_mixed(spark, sf_dir):
    """Two headers in another order, one column more in one of them, and line breaks in cells."""
    folder = shared_folder(spark, "mixed")
    rows = table(spark, sf_dir, "customer").withColumn("c_name", F.concat("c_name", F.lit("\nx")))
    even, odd = F.col("c_custkey") % 2 == 0, F.col("c_custkey") % 2 == 1
    _one_csv(rows.filter(even).select("c_custkey", "c_name", "c_mktsegment"), f"{folder}/part=a")
    _one_csv(rows.filter(odd).select("c_name", "c_custkey"), f"{folder}/part=b")
    names = {"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment"}
    return files.read_csv_dir(spark, f"{folder}/*", names).select("id", "name", "segment")


@query("ragged_csv_two_headers", """
SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_size % 3 = 0 THEN '' ELSE p_brand END AS brand,
       CASE WHEN p_size % 2 = 0 THEN p_type ELSE 'Not Applicable' END AS kind FROM part
""")
def ragged_csv_two_headers(spark, sf_dir):
    folder = shared_folder(spark, "ragged-two")
    key, brand, kind = F.col("p_partkey").cast("string"), F.col("p_brand"), F.col("p_type")
    part = table(spark, sf_dir, "part")
    short = F.col("p_size") % 3 == 0
    sides = (
        ("a", ">id,kind, brand", F.when(short, F.concat_ws(",", key, kind)).otherwise(F.concat_ws(",", key, kind, brand, F.lit("more"))), 0),
        ("b", "brand,id", F.concat_ws(",", F.when(short, "").otherwise(brand), key, F.lit("more")), 1),
    )
    for name, header, line, rest in sides:
        rows = part.filter(F.col("p_size") % 2 == rest).select(line.alias(header))
        rows.write.option("header", True).option("sep", "\x01").option("quote", "\x00").csv(f"{folder}/part={name}")
    return files.read_ragged_csv(spark, f"{folder}/*", ["id", "brand", "kind"])


@query("table_snapshots", """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y') AS ds FROM orders
""")
def table_snapshots(spark, sf_dir):
    """One call per year, each with its own partition; the last year is written twice."""
    name = f"snapshots_{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy").alias("ds"))
    first, last = (int(x) for x in rows.agg(F.min("ds"), F.max("ds")).first())
    for year in [*range(first, last + 1), last]:
        sinks.save_table(rows.filter(F.col("ds") == str(year)), name, ["ds"], bucket="o_custkey", buckets=4)
    return spark.table(name).select("o_orderkey", "o_custkey", F.col("ds").cast("string").alias("ds"))


@query("lookback_full_then_step", """
WITH f AS (
  SELECT o_custkey, o_orderdate AS d, o_orderkey AS k, strftime(o_orderdate, '%Y-%m') || '-01' AS m FROM orders
  WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND strftime(o_orderdate, '%Y-%m') < '2000-01'
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY m DESC, k DESC) = 1),
s AS (SELECT * FROM f WHERE m >= '1997-02-01' UNION ALL
      SELECT o_custkey, o_orderdate, o_orderkey, strftime(o_orderdate, '%Y-%m') || '-01' FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '2000-02')
SELECT o_custkey, d AS latest_known_admitted, k AS latest_known_order, m AS latest_index_update, '2000-02-01' AS ds
FROM s WHERE d >= TIMESTAMP '1997-02-01' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY m DESC, k DESC) = 1
""")
def lookback_full_then_step(spark, sf_dir):
    """A full snapshot feeds an incremental step as it is."""
    values = {"latest_known_admitted": "o_orderdate", "latest_known_order": "o_orderkey"}
    accounts = table(spark, sf_dir, "orders").withColumn("index_update", F.date_format("o_orderdate", "yyyy-MM"))
    until = accounts.filter(F.col("index_update") < "2000-01")
    full = lookback.lookback_full(until, "2000-01-01", values, key="o_custkey", event_time="o_orderdate", tie="o_orderkey")
    return lookback.lookback_step(full.drop("ds"), accounts, "2000-02-01", values, key="o_custkey", event_time="o_orderdate", tie="o_orderkey")


@query("latest_file", "SELECT count(*) AS n, 'orders' AS name FROM orders")
def latest_file(spark, sf_dir):
    """The newest file of a suffix is found by the manifest and read."""
    folder = shared_folder(spark, "latest")
    for name in ("customer", "orders"):
        table(spark, sf_dir, name).select(F.lit(name).alias("name")).repartition(1).write.csv(f"{folder}/{name}", header=True)
    newest = files.latest_file(files.list_files(spark, folder, "*.csv")).first().path
    return spark.read.option("header", True).csv(newest).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query("compact_text_files", "SELECT CAST(n_nationkey AS VARCHAR) || chr(10) || n_name || chr(10) AS file_content FROM nation")
def compact_text_files(spark, sf_dir):
    """One small file per row, packed into monthly folders; a second run replaces what it sees."""
    folder = shared_folder(spark, "small")
    lines = table(spark, sf_dir, "nation").select(
        F.concat(F.col("n_nationkey").cast("string"), F.lit("\n"), F.col("n_name")).alias("value"), F.col("n_nationkey").alias("key")
    )
    lines.write.partitionBy("key").text(f"{folder}/in")
    for _ in range(2):
        files.compact_text_files(spark, f"{folder}/in", f"{folder}/out", "*.txt")
    return spark.read.parquet(f"{folder}/out").select("file_content")


def _packed_texts(texts, folder: str, compression: str | None = None) -> None:
    """Texts with their name in 16 folders, many in a file, but not more than one task can read as a whole."""
    lines = texts.select(F.concat("file", F.lit("\x1f"), "value").alias("value"), F.pmod(F.xxhash64("file"), F.lit(16)).alias("bucket"))
    lines.write.option("maxRecordsPerFile", 20_000).partitionBy("bucket").text(folder, compression=compression, lineSep="\x1e")


def _unpacked_texts(read):
    one = read.select(F.explode(F.split("value", "\x1e")).alias("_v")).filter(F.length("_v") > 0)
    return one.select(F.substring_index("_v", "\x1f", 1).alias("file"), F.substring_index("_v", "\x1f", -1).alias("value"))


@query("read_hl7v2_files", ORACLES["hl7_identity"])
def read_hl7v2_files(spark, sf_dir):
    folder = shared_folder(spark, "hl7")
    _packed_texts(message_text(spark, sf_dir), folder, "gzip")
    texts = _unpacked_texts(files.read_hl7v2(spark, folder, "UTF-8", "*.txt.gz"))
    return hl7v2.hl7_identity(hl7v2.hl7_messages(texts))


@query("ccda_snapshot", ORACLES["ccda_demographics"])
def ccda_snapshot(spark, sf_dir):
    """Documents are read, extracted and published as a snapshot, twice."""
    folder = shared_folder(spark, "ccda")
    _packed_texts(document_text(spark, sf_dir), f"{folder}/in")
    people = ccda.ccda_demographics(_unpacked_texts(files.read_ccda(spark, f"{folder}/in", "*.txt")))
    for _ in range(2):
        sinks.publish_snapshot(people, f"{folder}/out")
    return files.read_table(spark, f"{folder}/out")


@query("check_columns", "SELECT 0::BIGINT AS n_missing, 1::BIGINT AS n_missing_without_dob, count(*) AS n_rows FROM customer")
def check_columns(spark, sf_dir):
    panel = _panel(spark, sf_dir)
    missing, without = (len(quality.check_columns(df)) for df in (panel, panel.drop("DOB")))
    return panel.agg(
        F.lit(missing).cast("bigint").alias("n_missing"), F.lit(without).cast("bigint").alias("n_missing_without_dob"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def _union_sql(names: dict[str, str]) -> str:
    """All rows of several tables as texts, each with its table; columns that a table lacks are null."""
    return " UNION ALL BY NAME ".join(f"SELECT '{name}' AS of_table, COLUMNS(*)::VARCHAR FROM ({sql})" for name, sql in names.items())


def _union(tables: dict[str, DataFrame]) -> DataFrame:
    kinds = {name: dict(df.dtypes) for name, df in tables.items()}
    columns = dict.fromkeys(c for of_table in kinds.values() for c in of_table)

    def as_text(c: str, kind: str | None) -> str:
        value = "NULL" if kind is None else f"to_json(`{c}`)" if kind.startswith("array") else f"`{c}`"
        return f"CAST({value} AS STRING) AS `{c}`"

    named = [
        df.selectExpr(f"'{name}' AS of_table", *[as_text(c, kinds[name].get(c)) for c in columns]) for name, df in tables.items()
    ]
    while len(named) > 1:  # in pairs, so that a plan of many tables is not checked once for each of them
        named = [reduce(DataFrame.unionAll, named[i : i + 2]) for i in range(0, len(named), 2)]
    return named[0]


CCDA_SQL = {name: ORACLES[f"ccda_{'vitals' if name == 'vital_signs' else name}"] for name in ccda.EXTRACTS}


@query("hl7_all_tables", _union_sql(hl7_messages.TABLES_SQL))
def hl7_all_tables(spark, sf_dir):
    """Whole rows of every table, from messages that were parsed once."""
    parsed = hl7v2.parse_hl7(message_text(spark, sf_dir), shared_folder(spark, "hl7-parsed"))
    return _union(hl7v2.hl7_tables(parsed) | {"providers": hl7v2.hl7_providers(parsed, hl7_messages.provider_registry(spark, sf_dir))})


@query("ccda_all_extracts", _union_sql(CCDA_SQL))
def ccda_all_extracts(spark, sf_dir):
    """Whole rows of every extract, from documents that were parsed once."""
    parsed = ccda.parse_ccda(document_text(spark, sf_dir), shared_folder(spark, "ccda-parsed"))
    return _union(ccda.ccda_extracts(parsed))


for _name in ("hl7_person", "hl7_lab_results"):
    @query(f"{_name}_parsed", ORACLES[_name])
    def _from_parsed(spark, sf_dir, name=_name):
        parsed = hl7v2.parse_hl7(message_text(spark, sf_dir), shared_folder(spark, "hl7-parsed"))
        return hl7v2.hl7_tables(parsed)[name.removeprefix("hl7_")]


for _name in ("ccda_demographics", "ccda_encounters", "ccda_labs", "ccda_errors"):
    @query(f"{_name}_parsed", ORACLES[_name])
    def _from_parsed_documents(spark, sf_dir, name=_name):
        parsed = ccda.parse_ccda(document_text(spark, sf_dir), shared_folder(spark, "ccda-parsed"))
        return ccda.ccda_extracts(parsed)[name.removeprefix("ccda_")]

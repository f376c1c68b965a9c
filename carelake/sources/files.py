"""File and table sources."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import base_name
from .sinks import save_partitions


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Manifest of a folder tree: path, modificationTime, length. File contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select("path", "modificationTime", "length")


def latest_file(manifest: DataFrame, suffix: str = ".csv") -> DataFrame:
    """The newest file with a suffix; among equally new ones the greatest path."""
    wanted = manifest.filter(F.endswith(F.col("path"), F.lit(suffix)))
    return wanted.agg(F.max(F.struct("modificationTime", "path")).alias("_m")).select("_m.path", "_m.modificationTime")


def _by_header(spark: SparkSession, path: str, exclude: Sequence[str]) -> dict[str, list[str]]:
    """Header line to the files that start with it. Files whose whole name is excluded, and files
    without a line, are left out."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_block_start").alias("start"), "value",
    )
    starts = lines.filter((F.col("start") == 0) & ~F.col("name").isin(*exclude)).withColumn("_i", F.monotonically_increasing_id())
    groups: dict[str, list[str]] = {}
    for row in starts.groupBy("file").agg(F.min_by("value", "_i").alias("header")).orderBy("file").collect():
        groups.setdefault(row.header.removeprefix("\ufeff"), []).append(unquote(row.file))
    return groups


def _text_rows(spark: SparkSession, paths: list[str], header: list[str]) -> DataFrame:
    """Rows of CSV files as text columns ``<position>:<name>``. A quoted cell may hold line breaks."""
    schema = ", ".join(f"`{i}:{n}` string" for i, n in enumerate(header))
    return spark.read.option("header", True).option("multiLine", True).option("mode", "PERMISSIVE").schema(schema).csv(paths)


def read_csv_dir(
    spark: SparkSession, path: str, header_map: dict[str, str] | None = None,
    exclude: Sequence[str] = ("OptOutList.csv", "processed"),
) -> DataFrame:
    """All CSV files of a folder as text columns with renamed headers and the file name. Files that
    bear an excluded name are not opened. Every file is read by its own header, so the order of the
    columns may differ; a column that a file lacks is null there."""
    parts = []
    for header, paths in _by_header(spark, path, exclude).items():
        names = next(csv.reader([header]))
        rows = _text_rows(spark, paths, names)
        cells = [F.col(f"`{i}:{n}`").alias((header_map or {}).get(n, n)) for i, n in enumerate(names)]
        name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
        parts.append(rows.select(*cells, name.alias("source_file")))
    if not parts:
        return spark.createDataFrame([], "source_file string")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def clean_header(names: Sequence[str | None]) -> list[str]:
    """Blank names become ``_unnamed_<position>``; ``>`` and outer blanks are removed."""
    return [(n or f"_unnamed_{i}").replace(">", "").strip() for i, n in enumerate(names)]


def read_ragged_csv(spark: SparkSession, path: str, columns: Sequence[str], default: str | None = "Not Applicable") -> DataFrame:
    """Rows of CSV files whose lines may be too short or too long: short ones are padded with empty
    text, extra cells dropped, missing columns added with a default, and ``columns`` selected. Every
    file is read by its own header."""
    parts = []
    for line, paths in _by_header(spark, path, ()).items():
        header = clean_header(next(csv.reader([line]), []))
        place = {n: f"{i}:{n}" for i, n in reversed(list(enumerate(header)))}
        cells = [
            F.coalesce(F.col(f"`{place[c]}`"), F.lit("")).alias(c) if c in place else F.lit(default).cast("string").alias(c)
            for c in columns
        ]
        parts.append(_text_rows(spark, paths, header).select(*cells))
    if not parts:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
    return reduce(DataFrame.unionByName, parts)


def log_widths(spark: SparkSession, path: str, glob: str = "*.log") -> DataFrame:
    """Widest line of every tab-separated file."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path)
    return lines.groupBy(F.col("_metadata.file_path").alias("Source_File")).agg(
        F.max(F.size(F.split("value", "\t"))).alias("width")
    )


def read_tsv_logs(spark: SparkSession, path: str, columns: Sequence[str], glob: str = "*.log") -> tuple[DataFrame, DataFrame]:
    """Tab-separated logs with positional column names and their file.

    Returns the rows of files as wide as ``columns`` and the list of the other files with their width.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    rows = (
        spark.read.option("sep", "\t").option("header", True).option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob).option("quote", "").schema(schema).csv(path)
    )
    lined = rows.select(*[f"`{c}`" for c in columns], F.col("_metadata.file_path").alias("Source_File"))
    bad = log_widths(spark, path, glob).filter(F.col("width") != len(columns))
    return lined.join(bad.select("Source_File"), "Source_File", "left_anti"), bad


def read_text_files(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Small files as (file_path, file_content, index_update): the month of last change."""
    files = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path, wholetext=True)
    )
    return files.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("value").alias("file_content"),
        F.date_format("_metadata.file_modification_time", "yyyy-MM").alias("index_update"),
    )


def compact_text_files(spark: SparkSession, path: str, out: str, glob: str = "*.json") -> None:
    """Packs small files into monthly Parquet folders; a re-run replaces the months it sees."""
    save_partitions(read_text_files(spark, path, glob), out, ["index_update"])


def read_hl7v2(spark: SparkSession, path: str, charset: str = "ISO-8859-1", glob: str = "*") -> DataFrame:
    """HL7 v2 files as (file, name, value), decoded from a declared character set. ``file`` is the whole
    path, which tells files of one name apart; ``name`` is the last part of it. Where ``glob`` ends in ``.gz``,
    the files are unpacked."""
    if glob.endswith(".gz"):
        texts = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path, wholetext=True)
        known = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        # The bytes of a whole text are kept as they are, whatever the character set.
        named = texts.select(F.regexp_replace(known, "^(\\w+):///", "$1:/").alias("path"), F.col("value").cast("binary").alias("content"))
        return named.select(F.col("path").alias("file"), base_name(F.col("path")).alias("name"), F.decode("content", charset).alias("value"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select(F.col("path").alias("file"), base_name(F.col("path")).alias("name"), F.decode("content", charset).alias("value"))


def read_ccda(spark: SparkSession, path: str, glob: str = "*.[xX][mM][lL]") -> DataFrame:
    """XML documents of a folder tree as (file, name, value), whatever the case of the suffix. ``file``
    is the whole path, which tells files of one name apart; ``name`` is the last part of it."""
    files = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob).text(path, wholetext=True)
    )
    return files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"), "value")

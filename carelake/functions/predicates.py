"""Filters shared by the operators."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Markers that stand for "no value" in the source tables.
DATE_SENTINELS = ("1900-00-00 00:00:00", "0000-00-00 00:00:00")
MPI_SENTINELS = ("999999999999999", "<NA>")
ACCOUNT_SENTINELS = ("HcDAT_HELP_REQUESTED",)
LOOKUP_MPI_SENTINELS = ("1", "13")
TEXT_NULL = "nan"


def drop_sentinels(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is none of ``values``; null is dropped, as in SQL ``<>``."""
    return df.filter(~F.col(col).cast("string").isin(*values))


def split_delimited(text: str, delimiters: str = ",|") -> list[str]:
    """Members of a comma- or pipe-delimited list, as written (no trimming)."""
    return [part for part in re.split("[" + re.escape(delimiters) + "]", text) if part]


def in_delimited(col: Column, text: str, delimiters: str = ",|") -> Column:
    return col.isin(*split_delimited(text, delimiters))


def join_delimited(df: DataFrame, col: str, lists: DataFrame, list_col: str, keep: Sequence[str]) -> DataFrame:
    """Rows matched to every list row (for example a client) whose delimited list names them."""
    members = lists.select(
        *keep, F.explode(F.array_distinct(F.split(F.col(list_col), "[,|]"))).alias("_member")
    ).filter(F.length("_member") > 0)
    return df.join(members, F.col(col).cast("string") == F.col("_member"), "inner").drop("_member")


def longer_than(col: Column, n: int) -> Column:
    return F.length(col.cast("string")) > n


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(cols))


def clients_due(clients: DataFrame, frequencies: Sequence[str]) -> DataFrame:
    """Work queue: named, active, scheduled clients with one of the given request states."""
    return clients.filter(
        F.col("folder_name").isNotNull()
        & (F.col("active") == 1)
        & (F.col("airflow") == 1)
        & F.col("frequency").isin(*frequencies)
    )


def files_between(manifest: DataFrame, path: str, start: str, end: str, pattern: str = r"(\d{8})") -> DataFrame:
    """Files whose name carries a date from ``start`` to ``end`` inclusive."""
    named = F.try_to_date(F.regexp_extract(F.col(path), pattern, 1), "yyyyMMdd")
    return manifest.withColumn("file_day", named).filter(F.col("file_day").between(F.lit(start).cast("date"), F.lit(end).cast("date")))

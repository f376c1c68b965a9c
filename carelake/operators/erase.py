"""Erasure by key list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .position import batches


def ids_for_keys(df: DataFrame, keys: DataFrame, key: str, id_col: str = "id") -> DataFrame:
    """Ids of rows whose key is listed; a key listed twice gives its ids twice."""
    return df.select(key, id_col).join(keys.select(key), key, "inner")


def find_ids(df: DataFrame, key_lists: Sequence[DataFrame], key: str, id_col: str = "id") -> DataFrame:
    """Ids to delete over several key lists, repeats kept. The table is read once: the lists are
    stacked first."""
    stacked = key_lists[0].select(key)
    for one in key_lists[1:]:
        stacked = stacked.unionByName(one.select(key))
    return ids_for_keys(df, stacked, key, id_col).select(id_col)


def delete_batches(ids: DataFrame, id_col: str = "id", size: int = 500) -> DataFrame:
    return batches(ids, size, [F.col(id_col)])


def erase(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not listed; null keys stay."""
    listed = keys.filter(F.col(key).isNotNull()).select(key).distinct()
    return df.join(listed, key, "left_anti")


def erase_report(df: DataFrame, keys: DataFrame, key: str, by: str) -> DataFrame:
    """Rows before, after and removed per slice (for example per monthly partition)."""
    listed = keys.filter(F.col(key).isNotNull()).select(key).distinct().withColumn("_hit", F.lit(True))
    marked = df.select(by, key).join(listed, key, "left")
    return (
        marked.groupBy(by)
        .agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(F.col("_hit")).alias("rows_removed"))
        .withColumn("rows_after", F.col("rows_before") - F.col("rows_removed"))
    )

"""Latest record per key, extremes per key and per-key counts.

Every pick has a stated order with a tie-break, so results do not depend on partitioning.
All of them reduce on the map side, so a key that owns a third of the rows sends at most one
row per map task through the shuffle: ``row_number() = 1`` is planned with a partial
window-group limit, the others are partial aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Whole newest row per key; ``order`` lists sort columns, newest first, tie-break last."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_known(df: DataFrame, keys: Sequence[str], values: dict[str, str], order: Sequence[str]) -> DataFrame:
    """``values`` maps output name to source column, all taken from the one row with the greatest
    ``order`` tuple. Rows whose first order column is null are ignored; an all-null key gives nulls."""
    ordering = F.when(F.col(order[0]).isNotNull(), F.struct(*order))
    picked = F.struct(*[F.col(src).alias(out) for out, src in values.items()])
    return (
        df.groupBy(*keys)
        .agg(F.max_by(picked, ordering).alias("_v"))
        .select(*keys, *[F.col(f"_v.{out}").alias(out) for out in values])
    )


def max_when(condition: Column, value: Column) -> Column:
    """Largest ``value`` among rows meeting ``condition`` (aggregate expression)."""
    return F.max(F.when(condition, value))


def map_with_audit(pairs: DataFrame, key: str, value: str, audit: str) -> DataFrame:
    """One value per key (the least, so that it is stable) with the number of distinct values."""
    return pairs.groupBy(key).agg(
        F.min(value).alias(value), F.count_distinct(value).alias(audit)
    )


def latest_month_of_greatest_row(df: DataFrame, key: str, month: str, cols: Sequence[str]) -> DataFrame:
    """Month attached to the greatest row by ``cols``; among equal rows the latest month."""
    return df.groupBy(key).agg(
        F.max_by(F.col(month), F.struct(*cols, month)).alias("latest_known")
    )


def key_frequency(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("freq"))


def high_water(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.max(col).alias(f"max_{col}"))


def any_one(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One value per key; the least one, where the source picks without an order."""
    return df.groupBy(*keys).agg(F.min(value).alias(value))


def newest(df: DataFrame, value: str, time: str, by: Sequence[str] = ()) -> DataFrame:
    """``value`` at the greatest ``time`` per group, ties by the greater value."""
    return (
        df.filter(F.col(time).isNotNull())
        .groupBy(*by)
        .agg(F.max(F.struct(F.col(time), F.col(value))).alias("_m"))
        .select(*by, F.col(f"_m.{value}").alias(value), F.col(f"_m.{time}").alias(time))
    )


def collapse(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key set, where the source leaves the other columns undefined."""
    return latest_per_key(df, keys, order)


def first_rows(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """First ``n`` rows of a listing in a stated order (planned as a top-k, not a full sort)."""
    return df.orderBy(*order).limit(n)

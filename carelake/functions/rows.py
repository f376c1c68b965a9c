"""Row makers for values parsed from long texts.

The plain ``explode`` adds a size test of its array and a plain filter is moved as far down as it
goes; both would repeat the parsing below them. The outer form with a test of its own output stays
where it is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def rows_of(df: DataFrame, items: Column, name: str, position: str | None = None) -> DataFrame:
    """One row per non-null array element."""
    if position is None:
        made = df.select("*", F.explode_outer(items).alias(name))
    else:
        made = df.select("*", F.posexplode_outer(items).alias(position, name))
    return made.filter(F.col(name).isNotNull())


def keep(df: DataFrame, condition: Column) -> DataFrame:
    """A filter on a parsed value that is not pushed below the parsing."""
    return rows_of(df, F.when(condition, F.array(F.lit(True))), "_kept").drop("_kept")

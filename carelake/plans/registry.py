"""Queries over the star-schema tables, each next to the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fill(template: str, **values: Column) -> Column:
    """Text of a template whose ``{name}`` marks are replaced by column values."""
    parts = re.split(r"\{(\w+)\}", template)
    cells = [F.lit(p) if i % 2 == 0 else values[p].cast("string") for i, p in enumerate(parts) if i % 2 or p]
    return F.concat(*cells)


def handed_over(df: DataFrame) -> DataFrame:
    """The rows through a generator, so that made-up texts reach the parser like scanned ones and
    conditions on parsed values are not rewritten into the expressions that build the text."""
    return df.select(F.inline_outer(F.array(F.struct(*df.columns))))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Narrow rows over all cores before they grow into texts: a small file would be one task, and
    a partitioning without a fixed number would be merged again because the rows are still small."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, key)

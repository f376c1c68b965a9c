"""Projections and simple row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def project(df: DataFrame, mapping: dict[str, str | None]) -> DataFrame:
    """Columns in the order of ``mapping`` (output name to source name; no source: null text)."""
    return df.select(
        *[F.lit(None).cast("string").alias(out) if src is None else F.col(f"`{src}`").alias(out) for out, src in mapping.items()]
    )


def like_filter(df: DataFrame, col: str, like: Sequence[str] = (), not_like: Sequence[str] = ()) -> DataFrame:
    """Rows matching any of ``like`` (when given) and none of ``not_like``; null matches neither."""
    keep = F.col(col).isNotNull()
    if like:
        keep = keep & _any(F.col(col), like)
    if not_like:
        keep = keep & ~_any(F.col(col), not_like)
    return df.filter(keep)


def _any(col: Column, patterns: Sequence[str]) -> Column:
    found = col.like(patterns[0])
    for pattern in patterns[1:]:
        found = found | col.like(pattern)
    return found


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def ordered(df: DataFrame, ascending: Sequence[str], descending: Sequence[str] = ()) -> DataFrame:
    """Ascending columns first, then descending ones."""
    return df.orderBy(*[F.col(c).asc() for c in ascending], *[F.col(c).desc() for c in descending])


def json_value(col: Column, path: str) -> Column:
    return F.get_json_object(col, path)

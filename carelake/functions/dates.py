"""Date and time expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F


def month_text(ds: str, shift: int = 0) -> str:
    """``YYYY-MM`` of an ISO date, shifted by whole months."""
    d = date.fromisoformat(ds)
    year, month = divmod(d.year * 12 + d.month - 1 + shift, 12)
    return f"{year:04d}-{month + 1:02d}"


def month_of(when: Column, shift: int = 0) -> Column:
    return F.date_format(F.add_months(when.cast("date"), shift), "yyyy-MM")


def us_date_to_iso(text: Column) -> Column:
    """``M/d/yyyy`` to ``yyyy-MM-dd``; text that is no such date gives null."""
    return F.date_format(F.try_to_date(F.trim(text), "M/d/yyyy"), "yyyy-MM-dd")


def drop_midnight(text: Column) -> Column:
    return F.replace(text, F.lit("T00:00:00"), F.lit(""))


def is_real_date(text: Column, fmt: str = "yyyyMMdd") -> Column:
    return F.try_to_date(text, fmt).isNotNull()


def _iso_date(digits: Column) -> Column:
    """``yyyy-MM-dd`` of a text that begins with 8 digits. A cast of it costs a fraction of a parse by a pattern."""
    dash = F.lit("-")
    return F.concat(F.substring(digits, 1, 4), dash, F.substring(digits, 5, 2), dash, F.substring(digits, 7, 2))


def hl7_date(text: Column) -> Column:
    """Date in the first 8 characters, ``yyyy-MM-dd``, or null when they are no date."""
    iso = _iso_date(F.when(F.rlike(text, F.lit(r"\A\d{8}")), text))
    return F.when(iso.try_cast("date").isNotNull(), iso)


def hl7_timestamp(text: Column) -> Column:
    """``YYYYMMDD[HH[MM[SS]]]`` with any fraction or offset ignored; null when invalid."""
    digits = F.regexp_extract(text, r"^(\d{8,14})", 1)
    padded = F.rpad(digits, 14, "0")
    clock = F.concat_ws(":", *[F.substring(padded, start, 2) for start in (9, 11, 13)])
    iso = F.concat(_iso_date(padded), F.lit(" "), clock)
    return F.when(F.length(digits) >= 8, iso.try_cast("timestamp")).cast("timestamp_ntz")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a zone-less timestamp read as UTC."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MINUTE", start, end)

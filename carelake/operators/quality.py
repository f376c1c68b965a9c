"""Data-quality operators: each returns the offending rows or one row of counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

REQUIRED_PANEL_COLUMNS = ("Patient First Name", "Patient Last Name", "DOB", "Gender")


def validate_panel(
    panel: DataFrame, first: str = "Patient First Name", last: str = "Patient Last Name", dob: str = "DOB",
    gender: str = "Gender", npi: str = "Attributed Provider NPI", zip_code: str | None = "Zip Code",
    insurance: str | None = "Insurance ID", mpi: str | None = None,
) -> DataFrame:
    """Adds ``npi`` (whole part of the number) and ``errors`` (names of the failed rules)."""
    text = lambda c: F.col(f"`{c}`").cast("string")
    letters = "^[a-z A-Z]+$"
    iso = text(dob).rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(text(dob), "yyyy-MM-dd").isNotNull()
    whole_npi = text(npi).try_cast("double").try_cast("long")
    rules = {
        "first_name": text(first).rlike(letters),
        "last_name": text(last).rlike(letters),
        "date_of_birth": iso,
        "gender": F.length(text(gender)) == 1,
        "npi": whole_npi.isNotNull(),
    }
    for name, col in (("zip_code", zip_code), ("insurance_id", insurance), ("mpi", mpi)):
        if col is not None and col in panel.columns:
            number = text(col).try_cast("double")
            rules[name] = text(col).isNull() | F.coalesce(number == F.floor(number), F.lit(False))
    failed = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])
    return panel.withColumns({"npi": whole_npi, "errors": F.array_compact(failed)})


def check_no_nulls(df: DataFrame, col: str) -> DataFrame:
    """One row: rows, null rows, and whether the check passed (an empty table passes)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(col).isNull()).alias("n_null")
    ).withColumn("passed", (F.col("n_null") == 0) | (F.col("n_rows") == 0))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def check_columns(df: DataFrame, required: Sequence[str] = REQUIRED_PANEL_COLUMNS) -> list[str]:
    """Required columns that are missing."""
    return [c for c in required if c not in df.columns]


def check_cardinality(df: DataFrame, key: str, value: str, expected: int = 1) -> DataFrame:
    """Keys whose number of distinct values is not the expected one."""
    return (
        df.groupBy(key)
        .agg(F.count_distinct(value).alias("n_distinct"))
        .filter(F.col("n_distinct") != expected)
    )

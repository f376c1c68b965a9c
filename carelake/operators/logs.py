"""Server logs: session ids, server from the path, per-day compaction of text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import clean_session_id


def server_of(path: Column, base: str) -> Column:
    """First folder below ``base``."""
    below = F.substring_index(path, base.rstrip("/") + "/", -1)
    return F.substring_index(below, "/", 1)


def in_listed_year(path: Column, years: tuple[str, ...]) -> Column:
    """A folder of the path is all digits and starts with a listed year."""
    folders = F.slice(F.split(path, "/"), 1, F.size(F.split(path, "/")) - 1)
    return F.exists(folders, lambda p: p.rlike("^(" + "|".join(years) + r")\d*$"))


def clean_logs(rows: DataFrame, base: str, processed_at: str, path: str = "Source_File",
               session: str = "Session_ID") -> DataFrame:
    """Adds processing time, server and cleaned session id. Rows keep their file path."""
    return rows.withColumns(
        {
            "Processing_Timestamp": F.lit(processed_at),
            "server_source": server_of(F.col(path), base),
            session: clean_session_id(F.col(session).cast("string")),
        }
    )

"""Change detection against high-water marks.

Each operator is a batch function of the current state and the marks; ``streaming`` runs the
same functions on file streams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, functions as F

from .joins import lookup
from .keys import latest_per_key, newest
from ..functions.text import name_digest, part_after

NEVER = "1970-01-01 00:00:00"


def changed_files(seen: DataFrame, marks: DataFrame, keys: Sequence[str], time: str = "modified") -> DataFrame:
    """Files with no mark or a later time than their mark; the newest sighting of each file."""
    current = seen.groupBy(*keys).agg(F.max(time).alias(time))
    known = marks.groupBy(*keys).agg(F.max(time).alias("_mark"))
    return (
        current.join(known, list(keys), "left")
        .filter(F.col("_mark").isNull() | (F.col(time) > F.col("_mark")))
        .select(*keys, time)
    )


def advance_marks(marks: DataFrame, changed: DataFrame, keys: Sequence[str], time: str = "modified") -> DataFrame:
    """The mark table after the changed rows were handled."""
    both = marks.select(*keys, time).unionByName(changed.select(*keys, time))
    return both.groupBy(*keys).agg(F.max(time).alias(time))


def changed_datasets(
    refreshes: DataFrame, marks: DataFrame, key: str = "server", id_col: str = "id", time: str = "updated"
) -> DataFrame:
    """Latest refresh row per server when it is newer than its mark (no mark counts as 1970)."""
    latest = latest_per_key(refreshes, [key], [F.col(id_col).desc()])
    known = marks.groupBy(key).agg(F.max(time).alias("_mark"))
    mark = F.coalesce(F.col("_mark"), F.lit(NEVER).cast("timestamp_ntz"))
    return (
        latest.join(known, key, "left")
        .filter(F.col(time) > mark)
        .select(key, id_col, time)
    )


def changed_groupings(groupings: DataFrame, counts: DataFrame, marks: DataFrame, client: str = "client",
                      time: str = "event_timestamp") -> DataFrame:
    """Clients whose groupings changed since their mark, with their running person count."""
    current = groupings.groupBy(client).agg(F.max(time).alias(time))
    known = marks.groupBy(client).agg(F.max(time).alias("_mark"))
    total = counts.groupBy(client).agg(F.max("count_distinct_mpi").alias("count_distinct_mpi"))
    return (
        current.join(known, client, "left")
        .filter(F.col("_mark").isNull() | (F.col(time) > F.col("_mark")))
        .join(total, client, "left")
        .select(client, F.md5(F.col(client).cast("string").cast("binary")).alias("client_md5"), time, "count_distinct_mpi")
    )


def last_status(status: DataFrame, key: str, id_col: str) -> DataFrame:
    return latest_per_key(status, [key], [F.col(id_col).desc()])


def overdue_jobs(status: DataFrame, as_of: str, key: str = "table_name", id_col: str = "id",
                 start: str = "start_time", end: str = "end_time", days: int = 5) -> DataFrame:
    """Jobs whose last run started exactly ``days`` days ago and has no valid end."""
    last = last_status(status, key, id_col)
    begun = F.col(start).cast("date") == F.date_sub(F.lit(as_of).cast("date"), days)
    open_ended = F.col(end).isNull() | (F.length(F.col(end).cast("string")) < 6)
    return last.filter(begun & open_ended)


def stuck_jobs(jobs: DataFrame, as_of: str, started: str = "started_running", time: str = "event_timestamp",
               minutes: int = 120) -> DataFrame:
    """Running jobs whose last event is more than ``minutes`` old, with the age."""
    age = F.timestamp_diff("MINUTE", F.col(time), F.lit(as_of).cast("timestamp_ntz"))
    return jobs.filter(F.col(started) == 1).withColumn("minutes", age).filter(F.col("minutes") > minutes)


def reset_stuck(jobs: DataFrame, as_of: str, **names) -> DataFrame:
    """The job table with the running flag of stuck jobs cleared."""
    started = names.get("started", "started_running")
    time = names.get("time", "event_timestamp")
    age = F.timestamp_diff("MINUTE", F.col(time), F.lit(as_of).cast("timestamp_ntz"))
    stuck = (F.col(started) == 1) & (age > names.get("minutes", 120))
    return jobs.withColumn(started, F.when(stuck, 0).otherwise(F.col(started)))


def auto_approve(clients: DataFrame, files: DataFrame, groupings: DataFrame, client: str = "client",
                 file: str = "file", modified: str = "modified", grouped: str = "event_timestamp",
                 hours: int = 24) -> DataFrame:
    """Clients set to automatic approval whose newest panel file is more than ``hours`` later than
    their groupings. Clients without a file or groupings are left out."""
    due = clients.filter((F.col("auto_approval") == 1) & (F.col("frequency") != "Approved")).select(client)
    latest = newest(files.filter(F.endswith(F.col(file), F.lit(".csv"))), file, modified, [client])
    last = groupings.groupBy(client).agg(F.min(grouped).alias("_grouped"))
    limit = F.col("_grouped") + F.make_dt_interval(F.lit(0), F.lit(hours))
    return due.join(latest, client).join(last, client).filter(F.col(modified) > limit).drop("_grouped")


def rows_after(df: DataFrame, mark: int, id_col: str = "id") -> DataFrame:
    return df.filter(F.col(id_col) > mark)


def unprocessed(files: DataFrame, loaded: DataFrame, path: str = "path", source: str = "Source_File") -> DataFrame:
    done = loaded.select(F.col(source).alias(path)).filter(F.col(path).isNotNull()).distinct()
    return files.join(done, path, "left_anti")


def name_date(path, pattern: str = r"(\d{8})\d{0,6}"):
    """First run of 8 to 14 digits in a file name, read as a date by its first 8."""
    return F.try_to_date(F.regexp_extract(F.substring_index(path, "/", -1), pattern, 1), "yyyyMMdd")


def new_snapshots(files: DataFrame, latest: str | None, start: str, earliest: str, path: str = "path") -> DataFrame:
    """CSV files dated after the latest stored date (or after ``start``), in date order. Dates
    before ``earliest`` are ignored."""
    after = latest or start
    return (
        files.filter(F.endswith(F.col(path), F.lit(".csv")))
        .withColumn("file_date", name_date(F.col(path)))
        .filter((F.col("file_date") >= F.lit(earliest).cast("date")) & (F.col("file_date") > F.lit(after).cast("date")))
        .orderBy("file_date", path)
    )


def new_keys(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    return new.select(key).distinct().join(old.select(key).distinct(), key, "left_anti")


def directory_update(
    new: DataFrame, previous: DataFrame, file_date: str, key: str = "HCID", name: str = "Name",
    parent: str = "Part of HCID", network: str = "QHIN HCID", first_seen: str = "FirstSeenDate",
    order: Sequence[str] = (),
) -> DataFrame:
    """Directory rows of one snapshot: first-seen date of keys not stored before, parent cut to
    the part after its slash, parent and network names by self-lookup (``NA`` when unknown). Of several
    names for a key the last by the ``order`` columns counts, or the greatest where there are none."""
    stored = previous.select(key).distinct().withColumn("_old", F.lit(True))
    dated = new.join(stored, key, "left").withColumn(
        first_seen, F.when(F.col("_old").isNull(), F.lit(file_date)).otherwise(F.col(first_seen))
    ).drop("_old")
    cut = dated.withColumn(parent, part_after(F.col(parent), "/"))
    named = lookup(cut, F.col(parent), new, key, name, "PartOfName", "NA", order)
    named = lookup(named, F.col(network), new, key, name, "QHIN_Name", "NA", order)
    return named.withColumn("file_date", F.lit(file_date))


def fold_snapshots(dated: Iterator[tuple[str, DataFrame]], store: DataFrame, append) -> DataFrame:
    """Applies ``directory_update`` to snapshots in date order. ``append(rows)`` writes the rows
    to the stored table and reads it back."""
    for file_date, snapshot in dated:
        store = append(directory_update(snapshot, store, file_date))
    return store


def client_digest(df: DataFrame, client: str) -> DataFrame:
    return df.withColumn("client_md5", name_digest(F.col(client)))

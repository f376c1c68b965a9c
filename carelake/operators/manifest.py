"""File-manifest analytics: listings are DataFrames of (path, modificationTime, length)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import base_name, decoded


def manifest_diff(source: DataFrame, target: DataFrame, path: str = "path") -> DataFrame:
    """Files of ``source`` whose relative path is not in ``target``."""
    return source.join(target.select(path).distinct(), path, "left_anti")


def remainder(source: DataFrame, excluded: DataFrame, path: str = "path") -> DataFrame:
    """Files whose base name is in no excluded listing, whatever folder it was in."""
    names = excluded.select(base_name(F.col(path)).alias("_name")).distinct()
    return source.withColumn("_name", base_name(F.col(path))).join(names, "_name", "left_anti").drop("_name")


def top_folder(path: Column) -> Column:
    return F.substring_index(path, "/", 1)


def folder_counts(manifest: DataFrame, path: str = "path", suffix: str = ".xml") -> DataFrame:
    """Files per top folder, counted through all levels below it."""
    inside = manifest.filter(F.endswith(F.col(path), F.lit(suffix)) & F.contains(F.col(path), F.lit("/")))
    return inside.groupBy(top_folder(F.col(path)).alias("folder")).agg(F.count(F.lit(1)).alias("n_files"))


def reconcile_counts(current: DataFrame, new: DataFrame) -> DataFrame:
    """Folder counts of two trees side by side; a folder missing on one side counts 0."""
    a = current.select("folder", F.col("n_files").alias("n_current"))
    b = new.select("folder", F.col("n_files").alias("n_new"))
    both = a.join(b, "folder", "full").na.fill(0, ["n_current", "n_new"])
    return both.withColumn("same", F.col("n_current") == F.col("n_new"))


def delivered_everywhere(deliveries: DataFrame, item: str, target: str, n_targets: int) -> DataFrame:
    """Items that reached every one of ``n_targets`` targets."""
    return (
        deliveries.groupBy(item)
        .agg(F.count_distinct(target).alias("n_targets"))
        .filter(F.col("n_targets") == n_targets)
    )


def key_value(path: Column, key: str) -> Column:
    """Value of a ``key=value`` folder in a path; null when there is none."""
    found = F.regexp_extract(path, r"(?:^|/)[^/=]*" + key + "=([^/=]*)", 1)
    return F.nullif(found, F.lit(""))


def path_keys(manifest: DataFrame, path: str = "path") -> DataFrame:
    p = F.col(path)
    return manifest.withColumns(
        {
            "repository_id": key_value(p, "repositoryUniqueId"),
            "root": key_value(p, "root"),
            "extension": key_value(p, "extension"),
            "file_name": base_name(p),
        }
    )


def route(manifest: DataFrame, path: str = "path") -> DataFrame:
    """Flat destination name of a URL-encoded inbound path; the base name when the path does not
    have the inbound folder pattern."""
    plain = decoded(F.col(path))
    pattern = r"(?i)HL7v2In/domainOid=[^/]+/root=([^/]+)/extension=([^/]+)/([^/]+)"
    part = lambda i: F.regexp_extract(plain, pattern, i)
    flat = F.concat(F.lit("root="), part(1), F.lit("_extension="), part(2), F.lit("_"), part(3))
    name = base_name(plain)
    fallback = F.when(F.length(name) > 0, name).otherwise(
        F.concat(F.lit("unnamed_"), F.xxhash64(F.col(path)).cast("string"))
    )
    return manifest.withColumn("destination", F.when(F.rlike(plain, F.lit(pattern)), flat).otherwise(fallback))


def to_sync(source: DataFrame, target: DataFrame, path: str = "path", time: str = "modified",
            skip_prefix: str = "airflow_tmp_") -> DataFrame:
    """Files to copy: new ones, and ones newer than the local copy. Temporary files are skipped."""
    local = target.groupBy(path).agg(F.max(time).alias("_local"))
    wanted = source.filter(~F.startswith(F.col(path), F.lit(skip_prefix)))
    newer = F.coalesce(F.col("_local") < F.col(time), F.col("_local").isNull())
    return wanted.join(local, path, "left").filter(newer).drop("_local")


def tagged(manifest: DataFrame, tag: str = "CPProcessed", value: str | None = "true", also: Sequence[str] = (),
           tags: str = "tags") -> DataFrame:
    """Files carrying a tag (compared without case when a value is given) and all of ``also``.
    ``tags`` is an array of (key, value) structs."""
    def named(name: str, wanted: str | None) -> Column:
        def test(t):
            ok = t["key"] == name
            return ok if wanted is None else ok & (F.lower(t["value"]) == wanted)
        return F.exists(tags, test)

    keep = named(tag, value)
    for name in also:
        keep = keep & named(name, None)
    return manifest.filter(~F.endswith(F.col("path"), F.lit("/")) & keep)


def prefixes(manifest: DataFrame, levels: int = 3, path: str = "path") -> DataFrame:
    """Distinct folder prefixes of ``levels`` levels, of paths that go deeper than that."""
    parts = F.split(F.col(path), "/")
    prefix = F.concat(F.array_join(F.slice(parts, 1, levels), "/"), F.lit("/"))
    return manifest.filter(F.size(parts) > levels).select(prefix.alias("prefix")).distinct()


def authorised_destinations(config: DataFrame) -> DataFrame:
    """Distinct unpaused destination rows with trimmed text."""
    text = [c for c, t in config.dtypes if t == "string"]
    return (
        config.distinct()
        .filter(F.col("delivery_paused") == 0)
        .withColumns({c: F.trim(F.col(c)) for c in text})
        .distinct()
    )


def plan_deliveries(files: DataFrame, authorised: DataFrame, day_markers: Sequence[str]) -> DataFrame:
    """Files to deliver: an authorised OID and one of the day markers are folders of the path, and
    the name holds the destination's pattern.

    The OID is taken from the path segments, so this is an equi-join on one segment and not a
    search of every path for every OID.
    """
    segments = F.split(F.col("folder"), "/")
    on_day = files.filter(F.arrays_overlap(segments, F.array(*[F.lit(d) for d in day_markers])))
    per_segment = on_day.withColumn("_segment", F.explode(F.array_distinct(segments)))
    joined = per_segment.join(authorised, F.col("_segment") == F.col("authorized_identifier_oid"))
    pattern = F.coalesce(F.col("authorized_filter_file_beginning_pattern"), F.lit(""))
    return (
        joined.filter((F.length(pattern) == 0) | F.contains(F.col("file_name"), pattern))
        .drop("_segment")
        .distinct()
    )


def message_volume(deliveries: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """Deliveries per day, stage and level, added to the counts already stored."""
    keys = ["day_timestamp", "stage", "stage_level"]
    today = deliveries.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    if prior is None:
        return today
    return today.unionByName(prior.select(*keys, "count")).groupBy(*keys).agg(F.sum("count").alias("count"))


def prune_marks(marks: DataFrame, days: Sequence[str], path: str = "path") -> DataFrame:
    """Delivery marks whose path holds one of the kept day folders."""
    keep = F.lit(False)
    for day in days:
        keep = keep | F.contains(F.col(path), F.lit("/" + day))
    return marks.filter(keep)

"""Join shapes shared by the domain operators.

No side is broadcast by hint unless its row count is bounded by construction; otherwise Spark's
own size check (``autoBroadcastJoinThreshold``, applied statically and again by AQE) decides,
and large sides fall back to shuffled joins. Hot keys are left to the adaptive skew join: the joins
here are inner, left, semi or anti with one row per key on the right, which it can split. Where a key
may have many rows on both sides, ``split_join`` deals its pairs out over a grid of tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import task_count, written

#: Pairs of one key that one task may form.
PAIRS_A_TASK = 1 << 24
#: Tasks that the cells of heavy keys are dealt to at most; beyond that a task takes several.
MOST_TASKS = 1 << 13


def attach_mpi(accounts: DataFrame, registrations: DataFrame, account: str, account_ref: str, mpi: str) -> DataFrame:
    """Visit to person registration; every matching registration is kept. A plain join on the account:
    bucketed tables join without a shuffle, and otherwise the adaptive skew join splits an account
    with many registrations by rows, equal ones included."""
    people = registrations.select(F.col(account_ref).alias(account), F.col(mpi))
    return people.join(accounts, account).select(*accounts.columns, mpi)


def suppress(population: DataFrame, opt_outs: DataFrame, key: str, sentinels: Sequence[str] = ()) -> DataFrame:
    """Rows whose key is not opted out. Null keys and sentinel ids are dropped as well, as the
    comparison with the sentinel is not true for them."""
    kept = population.join(opt_outs.select(key).distinct(), key, "left_anti").filter(F.col(key).isNotNull())
    return kept.filter(~F.col(key).cast("string").isin(*sentinels)) if sentinels else kept


def groupings_of_clients(groupings: DataFrame, clients: DataFrame, key: str) -> DataFrame:
    return groupings.join(clients.select(key).distinct(), key, "left_semi")


def exclude_listed(df: DataFrame, col: str, excluded: DataFrame, excluded_col: str) -> DataFrame:
    """Rows whose value is not in the list. A null value is dropped; nulls in the list are
    ignored, where SQL ``NOT IN`` would return nothing at all."""
    unwanted = excluded.select(F.col(excluded_col).alias(col)).filter(F.col(col).isNotNull()).distinct()
    return df.filter(F.col(col).isNotNull()).join(unwanted, col, "left_anti")


def not_yet_delivered(files: DataFrame, delivered: DataFrame, keys: Sequence[str]) -> DataFrame:
    return files.join(delivered.select(*keys).distinct(), list(keys), "left_anti")


def lookup(
    df: DataFrame, key: Column, dim: DataFrame, dim_key: str, dim_value: str, name: str, default: str,
    last: Sequence[str] = (),
) -> DataFrame:
    """Value of a dimension by key, or ``default``. The last of several rows for a key wins by
    the ``last`` columns, or the greatest value when there are none."""
    order = F.struct(*last, dim_value) if last else F.struct(dim_value)
    one = (
        dim.filter(F.col(dim_key).isNotNull())
        .groupBy(F.col(dim_key).alias("_k"))
        .agg(F.max_by(F.col(dim_value), order).alias("_v"))
    )
    return (
        df.withColumn("_key", key)
        .join(one, F.col("_key") == F.col("_k"), "left")
        .withColumn(name, F.coalesce("_v", F.lit(default)))
        .drop("_key", "_k", "_v")
    )


def lookup_with_fallback(
    df: DataFrame, key: Column, first: DataFrame, second: DataFrame, name: str
) -> DataFrame:
    """Value from ``first(key, value)``, else from ``second(key, value)``, else null."""
    a = first.groupBy(F.col("key").alias("_ka")).agg(F.max("value").alias("_va"))
    b = second.groupBy(F.col("key").alias("_kb")).agg(F.max("value").alias("_vb"))
    return (
        df.withColumn("_key", key)
        .join(a, F.col("_key") == F.col("_ka"), "left")
        .join(b, F.col("_key") == F.col("_kb"), "left")
        .withColumn(name, F.coalesce("_va", "_vb"))
        .drop("_key", "_ka", "_va", "_kb", "_vb")
    )


def enrich(df: DataFrame, other: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Overwrites ``cols`` from ``other``; an unmatched row gets nulls there."""
    kept = [c for c in df.columns if c not in cols]
    return df.select(*kept).join(other.select(key, *cols), key, "left")


def upsert(
    target: DataFrame, changes: DataFrame, key: str, cols: Sequence[str], required: Sequence[str],
    partial: Sequence[str],
) -> DataFrame:
    """Conditional upsert by key.

    A change whose ``required`` columns all have more than 2 characters writes every column; one
    whose ``required`` columns are all shorter than 2 writes only the ``partial`` ones; any other
    change is ignored. ``changes`` holds one row per key (collapse it first).
    """
    size = lambda c: F.length(F.coalesce(F.col(c).cast("string"), F.lit("")))
    full = F.lit(True)
    blank = F.lit(True)
    for c in required:
        full = full & (size(c) > 2)
        blank = blank & (size(c) < 2)
    kind = F.when(full, "full").when(blank, "partial")
    usable = changes.withColumn("_kind", kind).filter(F.col("_kind").isNotNull())
    new = usable.select(F.col(key), F.col("_kind"), *[F.col(c).alias(f"_new_{c}") for c in cols])
    merged = target.select(key, *cols).withColumn("_old", F.lit(True)).join(new, key, "full")

    def value(c: str) -> Column:
        if c in partial:
            return F.when(F.col("_kind").isNotNull(), F.col(f"_new_{c}")).otherwise(F.col(c))
        return F.when(F.col("_kind") == "full", F.col(f"_new_{c}")).otherwise(F.col(c))

    return merged.select(key, *[value(c).alias(c) for c in cols])


def heavy_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], pairs: int = PAIRS_A_TASK) -> DataFrame:
    """Keys that form more than ``pairs`` pairs, with their rows on either side. A heavy key has more than
    ``sqrt(pairs)`` rows on one side, so the list is shorter than the tables by that factor."""
    count = lambda df, name: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    both = count(left, "n_left").join(count(right, "n_right"), list(keys))
    return both.filter(F.col("n_left").cast("double") * F.col("n_right") > pairs)


def split_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", pairs: int = PAIRS_A_TASK
) -> DataFrame:
    """Inner or left join on ``keys``. A key that is heavy on both sides, such as a placeholder, is split on
    both: its rows are cut into ``a`` and ``b`` parts, and each of the ``a * b`` cells of the grid, of about ``pairs``
    pairs, is a group of its own. Other keys, and null ones, are joined as usual.

    Parts are told apart by a hash of the whole row, so a lost task is dealt the same rows again. Equal rows
    of a heavy key are counted before and spread out again behind the join.
    """
    most = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    if (most or 0) * right.count() <= pairs:  # no key can be heavy
        return left.join(right, list(keys), how)
    heavy = written(heavy_keys(left, right, keys, pairs), "heavy-keys")
    side = max(1, int(pairs**0.5))
    parts = heavy.select(
        *keys, F.ceil(F.col("n_left") / side).cast("int").alias("_rows"), F.ceil(F.col("n_right") / side).cast("int").alias("_cols")
    )
    grid_cells = parts.agg(F.sum(F.col("_rows").cast("bigint") * F.col("_cols"))).first()[0]
    if grid_cells is None:
        return left.join(right, list(keys), how)
    # A stated number of partitions: adaptive execution would merge cells by their few bytes, whatever they join to.
    tasks = max(task_count(left.sparkSession), min(grid_cells, MOST_TASKS))
    rest = [df.join(heavy.select(*keys), list(keys), "left_anti") for df in (left, right)]

    def dealt(df: DataFrame, own: str, own_parts: str, other: str, other_parts: str, copies: str) -> DataFrame:
        counted = df.join(parts, list(keys)).groupBy(*df.columns, "_rows", "_cols").agg(F.count(F.lit(1)).alias(copies))
        part = F.pmod(F.xxhash64(*df.columns), F.col(own_parts)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other_parts) - 1))
        cells = counted.withColumn(own, part).withColumn(other, every).drop("_rows", "_cols")
        return cells.repartition(tasks, *keys, "_i", "_j")

    a = dealt(left, "_i", "_rows", "_j", "_cols", "_copies_a")
    b = dealt(right, "_j", "_cols", "_i", "_rows", "_copies_b")
    pairs_of = a.join(b, [*keys, "_i", "_j"]).drop("_i", "_j")
    again = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies_a") * F.col("_copies_b")))
    grid = pairs_of.withColumn("_again", again).drop("_again", "_copies_a", "_copies_b")
    return rest[0].join(rest[1], list(keys), how).unionByName(grid)

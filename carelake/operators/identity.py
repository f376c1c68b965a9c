"""Person identity: match on demographics, mint ids for new people, collapse duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .position import with_position, with_previous
from ..functions.dates import hl7_date
from ..functions.predicates import LOOKUP_MPI_SENTINELS

IDENTITY = ("lastname", "firstname", "dob", "sex")


def _filled(cols: Sequence[str]) -> Column:
    ok = F.lit(True)
    for c in cols:
        ok = ok & (F.length(F.coalesce(F.col(c).cast("string"), F.lit(""))) > 0)
    return ok


def normalize_identity(df: DataFrame, dob: str = "dob", sex: str = "sex") -> DataFrame:
    """Birth date from the first 8 digits (null when no date) and sex cut to one letter."""
    return df.withColumns({dob: hl7_date(F.col(dob)), sex: F.left(F.col(sex), F.lit(1))})


def match_identities(
    new: DataFrame, master: DataFrame, keys: Sequence[str] = IDENTITY, case_insensitive: bool = False
) -> DataFrame:
    """Distinct key sets of ``new`` with the greatest matching master id, or null.

    The new records are reduced to distinct keys before the join, so a key set shared by many
    messages is shuffled once per map task and joined as one row.
    """
    norm = (lambda c: F.lower(c)) if case_insensitive else (lambda c: F.col(c))
    wanted = new.select(*[norm(k).alias(k) for k in keys]).distinct()
    known = master.groupBy(*[norm(k).alias(k) for k in keys]).agg(F.max("id").alias("mpi"))
    return wanted.join(known, list(keys), "left")


def resolve_identities(
    new: DataFrame, master: DataFrame, keys: Sequence[str] = IDENTITY, extra: Sequence[str] = ("ssn",),
    record: str = "message_id", case_insensitive: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Match, mint, rematch.

    Returns the new records with their ``mpi`` (0 when a key is missing, so nothing is looked up)
    and the grown master table. New ids continue from the greatest master id in key order, so a
    retry on the same master snapshot mints the same ids. The values of a minted person come from
    its record with the least ``record`` id. With ``case_insensitive`` keys that differ in letter
    case only are one person, in matching, minting and rematching.
    """
    fold = F.lower if case_insensitive else F.col
    folded = [f"_key_{k}" for k in keys]
    key_of = {f: fold(k) for f, k in zip(folded, keys)}
    complete = new.filter(_filled(keys)).withColumns(key_of)
    kept = list(dict.fromkeys([*keys, *extra]))
    people = complete.groupBy(*folded).agg(F.min_by(F.struct(*kept), F.struct(record, *keys)).alias("_x"))
    known = master.groupBy(*[c.alias(f) for f, c in key_of.items()]).agg(F.max("id").alias("mpi"))
    matched = people.join(known, folded, "left")
    unmatched = matched.filter(F.col("mpi").isNull()).select(*folded, *[F.col(f"_x.{c}").alias(c) for c in kept])
    top = master.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    # Numbered rows are kept in the checkpoint folder, so ids and table agree however often they are read.
    minted = (
        with_position(unmatched, [F.col(f) for f in folded], "_rn", unique=True)
        .withColumn("id", (top + F.col("_rn")).cast(master.schema["id"].dataType))
        .drop("_rn")
    )
    master2 = master.unionByName(minted.drop(*folded), allowMissingColumns=True)
    ids = known.unionByName(minted.select(*folded, F.col("id").alias("mpi")))
    # One row per key on the right, so the adaptive skew join can split a key of many records.
    found = complete.join(ids, folded).drop(*folded)
    without_key = new.filter(~_filled(keys)).withColumn("mpi", F.lit(0).cast(found.schema["mpi"].dataType))
    return found.unionByName(without_key), master2


def collapse_duplicates(
    population: DataFrame, mpi: str = "MPI", identity: Sequence[str] = ("first_name", "last_name", "dob", "sex"),
    mode: str = "identity",
) -> DataFrame:
    """Replaces the id of duplicate people by the greater one.

    ``identity``: the greatest id among rows with the same complete identity. ``adjacent``: only
    a row and the row before it in id order are compared, as in the source, which leaves nearly
    every id as it was. Rows with a missing identity part never match.
    """
    complete = F.lit(True)
    for c in identity:
        complete = complete & F.col(c).isNotNull()
    if mode == "identity":
        best = population.filter(complete).groupBy(*identity).agg(F.max(mpi).alias("_best"))
        same = population.filter(complete).join(best, list(identity))
        changed = same.withColumn(mpi, F.col("_best")).select(*population.columns)
        return changed.unionByName(population.filter(~complete))
    if mode == "adjacent":
        order = [F.col(mpi), *[F.col(c) for c in identity]]
        paired = with_previous(population, order, [mpi, *identity])
        same_person = F.lit(True)
        for c in identity:
            same_person = same_person & F.coalesce(F.col(c) == F.col(f"prev_{c}"), F.lit(False))
        best = F.when(same_person, F.greatest(F.col(mpi), F.col(f"prev_{mpi}"))).otherwise(F.col(mpi))
        return paired.withColumn(mpi, best).select(*population.columns)
    raise ValueError(f"unknown mode: {mode}")


def representatives(
    population: DataFrame, mpi: str, identity: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Distinct people after the identity collapse, in one partial aggregate and no join.
    Rows with a missing identity part are their own group, keyed by their id."""
    complete = F.lit(True)
    for c in identity:
        complete = complete & F.col(c).isNotNull()
    own = F.when(~complete, F.col(mpi))
    return (
        population.groupBy(*by, *identity, own.alias("_own")).agg(F.max(mpi).alias(mpi)).drop("_own")
    )


def distinct_mpi(groupings: DataFrame, mpi: str = "MPI") -> DataFrame:
    """Lookup of distinct numeric person ids named in the groupings."""
    text = F.col(mpi).cast("string")
    usable = text.isNotNull() & (F.length(F.trim(text)) > 0) & ~text.isin(*LOOKUP_MPI_SENTINELS)
    return (
        groupings.filter(usable)
        .select(text.try_cast("long").alias("mpi_int"), text.alias("MPI"))
        .distinct()
        .filter(F.col("mpi_int").isNotNull())
    )


def distinct_mpi_is_stale(groupings: DataFrame, current: DataFrame, mpi: str = "MPI") -> DataFrame:
    """One row telling whether the lookup must be rebuilt (its row count no longer fits)."""
    fresh = distinct_mpi(groupings, mpi).agg(F.count(F.lit(1)).alias("n_new"))
    old = current.agg(F.count(F.lit(1))).scalar()
    return fresh.withColumn("n_current", old).withColumn("stale", F.col("n_new") != F.col("n_current"))

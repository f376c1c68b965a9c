"""State-of-residence assignment per account and per person."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .keys import map_with_audit, max_when

UNKNOWN = "UNKNOWN"


def standardize(df: DataFrame, col: str, crosswalk: DataFrame, name: str, default: str = UNKNOWN) -> DataFrame:
    """Standard value of a raw code; the crosswalk row with the least rank wins.

    ``crosswalk`` has columns ``raw``, ``standard``, ``rank``. It is reduced to one row per raw
    value first, so the join cannot multiply rows; a long one is shuffled, not broadcast.
    """
    first = crosswalk.groupBy(F.col("raw").alias("_raw")).agg(F.min_by("standard", F.struct("rank", "standard")).alias("_std"))
    return (
        df.join(first, F.col(col) == F.col("_raw"), "left")
        .withColumn(name, F.coalesce("_std", F.lit(default)))
        .drop("_raw", "_std")
    )


def recent_and_history(history: DataFrame, recent: DataFrame, after: str, month: str = "index_update") -> DataFrame:
    """Consolidated history rows and the load months newer than it."""
    return history.unionByName(recent.filter(F.col(month) > after), allowMissingColumns=True)


def latest_state(
    events: DataFrame, key: str = "patient_id", state: str = "state", when: str = "index_update_dt_tm",
    unknown: str = UNKNOWN,
) -> DataFrame:
    """Latest update, latest update with a known state, that state, and the rule that chose it.

    A key whose updates are all unknown gets a null state and ``latest_update_not_unknown``.
    Of several known states at the same time the greatest is taken.
    """
    known = F.col(state) != unknown
    best = F.max(F.when(known & F.col(when).isNotNull(), F.struct(F.col(when).alias("t"), F.col(state).alias("s"))))
    return (
        events.groupBy(key)
        .agg(F.max(when).alias("latest_index_update_dt_tm"), max_when(known, F.col(when)).alias("used_index_update_dt_tm"), best.alias("_b"))
        .select(
            key,
            "latest_index_update_dt_tm",
            "used_index_update_dt_tm",
            F.col("_b.s").alias("imputed_state"),
            F.when(F.col("latest_index_update_dt_tm") == F.col("used_index_update_dt_tm"), "latest_update")
            .otherwise("latest_update_not_unknown")
            .alias("used_algorithm"),
        )
    )


def account_to_person(pairs: DataFrame, account: str = "accid_ref", mpi: str = "mpi") -> DataFrame:
    return map_with_audit(pairs, account, mpi, "num_mpis_should_be_1")


def state_with_mpi(
    states: DataFrame, people: DataFrame, account: str = "patient_id", account_ref: str = "accid_ref",
    mpi: str = "mpi", keep_unmatched: bool = False,
) -> DataFrame:
    """Account states with their person. The source joins left and then filters on the right
    side, which drops unmatched accounts; ``keep_unmatched`` keeps them with a null person.
    Both sides hold one row per account, so no key can be hot."""
    mapped = people.select(F.col(account_ref).alias(account), F.col(mpi))
    return states.join(mapped, account, "left" if keep_unmatched else "inner")


def person_state(states: DataFrame, mpi: str = "mpi", account: str = "patient_id") -> DataFrame:
    """State of a person from the account with the latest known update, and the account count.
    Ties go to the greatest account. Null persons form one group; the aggregate is partial, so
    the size of that group does not matter."""
    fields = ["latest_index_update_dt_tm", "used_index_update_dt_tm", "imputed_state", "used_algorithm"]
    when = F.col("used_index_update_dt_tm")
    chosen = F.max_by(F.struct(*fields, account), F.when(when.isNotNull(), F.struct(when, F.col(account))))
    return (
        states.groupBy(mpi)
        .agg(chosen.alias("_a"), F.count(F.lit(1)).alias("number_patient_ids"))
        .select(
            mpi,
            *[F.col(f"_a.{c}").alias(c) for c in fields],
            F.col(f"_a.{account}").alias("patient_id_used_for_assignment"),
            "number_patient_ids",
        )
    )


def state_summary(people: DataFrame, ds: str) -> DataFrame:
    return (
        people.groupBy("imputed_state", "used_algorithm")
        .agg(F.count(F.lit(1)).alias("number_mpis"), F.sum("number_patient_ids").alias("number_patient_ids"))
        .withColumn("ds", F.lit(ds))
    )

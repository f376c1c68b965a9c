"""Opt-out lists: sanitise, match to people by two rules, list the methods per match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .joins import PAIRS_A_TASK, heavy_keys, split_join
from .keys import collapse
from ..functions.dates import drop_midnight, us_date_to_iso
from ..functions.predicates import TEXT_NULL
from ..functions.text import nine_digit_ssn
from ..session import written

STANDARD = "standard"
SPECIAL = "special1"
DETAIL = (
    "respective_vault", "respective_mrn", "opt_choice", "status", "username", "user", "submitted",
    "completed", "last_update_php",
)


def _iso_dob(dob):
    reformat = (dob != "Unknown") & ~F.contains(dob, F.lit("-"))
    return F.when(reformat, us_date_to_iso(dob)).otherwise(dob)


def sanitize_opt_outs(raw: DataFrame) -> DataFrame:
    """Active opt-outs with an ISO birth date, a nine-digit number and the special-rule keys.
    Rows whose choice, birth date or last name is null are dropped."""
    return (
        raw.filter((F.col("opt_choice") != "in") & F.col("dob").isNotNull() & F.col("lname").isNotNull())
        .withColumns({"dob": _iso_dob(F.col("dob")), "ssn": nine_digit_ssn(F.col("ssn"))})
    )


def sanitize_opt_outs_text(raw: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Variant for all-text loads: rows with the text ``nan`` in a name, birth date or sex are
    dropped, the midnight suffix is cut, and the active rows of the previous list are added."""
    cols = ["fname", "lname", "dob", "sex"]
    clean = raw
    for c in cols:
        clean = clean.filter(F.col(c) != TEXT_NULL)
    clean = clean.withColumns({"dob": drop_midnight(_iso_dob(F.col("dob"))), "ssn": nine_digit_ssn(F.col("ssn"))})
    if previous is not None:
        clean = clean.unionByName(previous.filter(F.col("opt_choice") != "in"), allowMissingColumns=True)
    return clean


def _standard_keys(opt_outs: DataFrame, people: DataFrame) -> tuple[dict, dict]:
    left = {"_k1": F.col("lname"), "_k2": F.col("fname"), "_k3": F.col("dob"), "_k4": F.col("sex")}
    right = {"_k1": F.col("lastname"), "_k2": F.col("firstname"), "_k3": F.col("dob"), "_k4": F.col("sex")}
    return left, right


def _special_keys(opt_outs: DataFrame, people: DataFrame) -> tuple[dict, dict]:
    left = {
        "_k1": F.left("lname", F.lit(3)), "_k2": F.col("fname"), "_k3": F.col("dob"), "_k4": F.col("sex"),
        "_k5": F.right("ssn", F.lit(4)),
    }
    right = {
        "_k1": F.left("lastname", F.lit(3)), "_k2": F.col("firstname"), "_k3": F.col("dob"), "_k4": F.col("sex"),
        "_k5": F.right("ssn", F.lit(4)),
    }
    return left, right


_RULES = {STANDARD: _standard_keys, SPECIAL: _special_keys}


def _fold(key, case_insensitive: bool):
    return F.lower(key) if case_insensitive else key


def _keyed(rule: str, opt_outs: DataFrame, people: DataFrame, case_insensitive: bool) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the rule's expressions as plain key columns, so that a match is an equi-join."""
    left, right = _RULES[rule](opt_outs, people)
    a = opt_outs.withColumns({k: _fold(v, case_insensitive) for k, v in left.items()})
    b = people.select(F.col("id").alias("_id"), *[_fold(v, case_insensitive).alias(k) for k, v in right.items()])
    return a.drop(*[c for c in ("mpi", "MPI") if c in a.columns]), b, list(left)


def match_by(
    rule: str, opt_outs: DataFrame, people: DataFrame, keep_unmatched: bool = True, case_insensitive: bool = False,
    pairs: int = PAIRS_A_TASK,
) -> DataFrame:
    """Opt-outs with the ``mpi`` of every person meeting the rule, tagged with ``match_method``. A placeholder
    identity that many list rows and many people share is spread over tasks of about ``pairs`` matches."""
    a, b, keys = _keyed(rule, opt_outs, people, case_insensitive)
    joined = split_join(a, b, keys, "left" if keep_unmatched else "inner", pairs)
    return joined.drop(*keys).withColumnRenamed("_id", "mpi").withColumn("match_method", F.lit(rule))


def heavy_identities(
    rule: str, opt_outs: DataFrame, people: DataFrame, pairs: int = PAIRS_A_TASK, case_insensitive: bool = False
) -> DataFrame:
    """Report of the identities that a rule matches more than ``pairs`` times: the key, the list rows
    (``n_left``) and the people (``n_right``). Such a key is a placeholder as a rule."""
    return heavy_keys(*_keyed(rule, opt_outs, people, case_insensitive), pairs=pairs)


def tagged_union(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    out = None
    for name, df in frames.items():
        tagged = df.withColumn(tag, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()


def match_opt_outs(
    opt_outs: DataFrame, people: DataFrame, keep_unmatched: bool = True, case_insensitive: bool = False,
    detail: Sequence[str] = DETAIL, pairs: int = PAIRS_A_TASK,
) -> DataFrame:
    """Opt-out list: one row per person and opt-out with the methods that matched, in name order.

    A list row repeated in the load is reduced before the joins, and the reduced list is stored for them.
    The methods of a row are bits of a number, which a hash aggregate can update in place."""
    cols = ["fname", "lname", "dob", "sex", "ssn", *[c for c in detail if c in opt_outs.columns]]
    unique = written(opt_outs.select(*cols).distinct(), "opt-outs")
    methods = sorted(_RULES)
    found = [
        match_by(method, unique, people, keep_unmatched, case_insensitive, pairs).drop("match_method").withColumn("_bit", F.lit(1 << i))
        for i, method in enumerate(methods)
    ]
    listed = union_all(*found).groupBy("mpi", *cols).agg(F.bit_or("_bit").alias("_bits"))
    named = [F.when(F.col("_bits").bitwiseAND(F.lit(1 << i)) != 0, F.lit(method)) for i, method in enumerate(methods)]
    return listed.withColumn("match_methods", F.array_join(F.array_compact(F.array(*named)), ",")).drop("_bits")


def opted_out_ids(opt_outs: DataFrame, people: DataFrame, case_insensitive: bool = False) -> DataFrame:
    """Distinct ids of opted-out people only. People are kept or dropped by semi-joins on distinct
    keys, so a key shared by many people and many list rows never forms their pairs."""
    found = []
    for rule in _RULES.values():
        left, right = rule(opt_outs, people)
        keys = opt_outs.select(*[_fold(v, case_insensitive).alias(k) for k, v in left.items()]).distinct()
        who = people.select(F.col("id").alias("mpi"), *[_fold(v, case_insensitive).alias(k) for k, v in right.items()])
        found.append(who.join(keys, list(left), "left_semi").select("mpi"))
    return union_distinct(*found)


def shrink_opt_outs(listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per ``keys`` (the newest update), where the source leaves the pick undefined."""
    rest = [F.col(c).desc() for c in listed.columns if c not in keys and c != "last_update_php"]
    return collapse(listed, keys, [F.col("last_update_php").desc(), *rest])

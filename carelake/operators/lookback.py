"""Rolling month lookbacks over account rows (one row per account and load month)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from .keys import latest_known, latest_per_key
from ..functions.dates import month_text
from ..functions.predicates import DATE_SENTINELS, ACCOUNT_SENTINELS


def _window_start(ds: str, months: int) -> str:
    d = date.fromisoformat(ds)
    total = d.year * 12 + d.month - 1 - months
    year, month = divmod(total, 12)
    last = (date(year + (month == 11), (month + 1) % 12 + 1, 1) - date(year, month + 1, 1)).days
    return date(year, month + 1, min(d.day, last)).isoformat()


def _first_open_month(start: str) -> str:
    """The first month whose first day is not before ``start``."""
    if start.endswith("-01"):
        return start[:7]
    year, month = int(start[:4]), int(start[5:7])
    return f"{year + (month == 12)}-{month % 12 + 1:02d}"


def month_slice(df: DataFrame, ds: str, month: str = "index_update") -> DataFrame:
    """One load month, on the bare partition column so that directories are pruned."""
    return df.filter(F.col(month) == ds[:7])


def month_agree(df: DataFrame, months: Sequence[str], event_time: str, month: str = "index_update") -> DataFrame:
    """Rows whose event month and load month are the same listed month."""
    return df.filter(F.col(month).isin(*months) & (F.substring(F.col(event_time).cast("string"), 1, 7) == F.col(month)))


def retain_months(df: DataFrame, ds: str, months: int, month: str = "partition_month") -> DataFrame:
    return df.filter(F.col(month) >= _window_start(ds, months)[:7])


def lookback_full(
    accounts: DataFrame, ds: str, values: dict[str, str], key: str = "accid", month: str = "index_update",
    event_time: str = "admitted", tie: str | None = None, months: int = 36,
) -> DataFrame:
    """Newest row per account whose load month and event time both fall in the window. The load month
    is given as its first day, so a snapshot can be the ``previous`` one of ``lookback_step``."""
    start = _window_start(ds, months)
    when = F.col(event_time)
    inside = accounts.filter(
        (F.col(month) >= _first_open_month(start))
        & ~F.coalesce(when.cast("string").isin(*DATE_SENTINELS), F.lit(False))
        & (when.try_cast("timestamp_ntz") >= F.lit(start).cast("timestamp_ntz"))
    )
    order = [F.col(month).desc()] + ([F.col(tie).desc()] if tie else [])
    newest = latest_per_key(inside, [key], order)
    return newest.select(
        F.col(key),
        *[F.col(src).alias(out) for out, src in values.items()],
        F.concat(F.col(month), F.lit("-01")).alias("latest_index_update"),
        F.lit(ds).alias("ds"),
    )


def lookback_step(
    previous: DataFrame, accounts: DataFrame, ds: str, values: dict[str, str], key: str = "accid",
    month: str = "index_update", event_time: str = "admitted", tie: str | None = None, months: int = 36,
) -> DataFrame:
    """One incremental step: this month's rows and the still-valid rows of the previous snapshot.

    All values come from one row. A newest row that fails the event-time test hides the older
    rows of its account for good, since the snapshot holds no runner-up: that is where this
    differs from ``lookback_full``.
    """
    start = _window_start(ds, months)
    month_date = F.concat(F.col(month), F.lit("-01"))
    fresh = month_slice(accounts, ds, month).select(
        F.col(key),
        *[F.col(src).alias(out) for out, src in values.items()],
        F.col(event_time).cast("string").alias("_event"),
        month_date.alias("latest_index_update"),
        *([F.col(tie).alias(f"_{tie}")] if tie else []),
    )
    event_out = next(out for out, src in values.items() if src == event_time)
    tie_out = next((out for out, src in values.items() if src == tie), None)
    kept = previous.filter(F.col("latest_index_update") >= start).select(
        F.col(key),
        *[F.col(out) for out in values],
        F.col(event_out).cast("string").alias("_event"),
        F.col("latest_index_update"),
        *([F.col(tie_out).alias(f"_{tie}")] if tie else []),
    )
    both = fresh.unionByName(kept).filter(
        ~F.coalesce(F.col(key).cast("string").isin(*ACCOUNT_SENTINELS), F.lit(False))
        & (F.col("_event").try_cast("timestamp_ntz") >= F.lit(start).cast("timestamp_ntz"))
    )
    order = ["latest_index_update"] + ([f"_{tie}"] if tie else [])
    out = {o: o for o in [*values, "latest_index_update"]}
    return latest_known(both, [key], out, order).withColumn("ds", F.lit(ds))


def lookback_rows(
    accounts: DataFrame, ds: str, event_time: str = "admitted", month: str = "index_update", months: int = 36
) -> DataFrame:
    """All rows of the last ``months`` full months, tagged with the month: one filter instead of
    one insert per month."""
    wanted = [month_text(ds, -i) for i in range(months, 0, -1)]
    tagged = month_agree(accounts, wanted, event_time, month).withColumn("partition_month", F.col(month))
    return retain_months(tagged.drop(month), ds, months)


def _steps_until(starts: Column, mark: Column) -> Column:
    """How many of the ascending window starts come before ``mark``."""
    return F.array_position(F.sort_array(F.array_append(starts, mark)), mark).cast("int") - 1


def _event_steps(starts: Sequence[str], event: Column) -> Column:
    """How many of the window starts are not after the event; none for an event that is no time."""
    just_after = event.try_cast("timestamp_ntz") + F.expr("INTERVAL '0.000001' SECOND")
    return F.coalesce(_steps_until(F.array(*[F.lit(s).cast("timestamp_ntz") for s in starts]), just_after), F.lit(0))


def _month_steps(starts: Sequence[str], month_date: Column) -> Column:
    return _steps_until(F.array(*[F.lit(s) for s in starts]), F.concat(month_date, F.lit("!")))


def backfill_snapshots(
    accounts: DataFrame, days: Sequence[str], values: dict[str, str], key: str = "accid", month: str = "index_update",
    event_time: str = "admitted", tie: str | None = None, months: int = 36, previous: DataFrame | None = None,
) -> DataFrame:
    """Every snapshot that ``lookback_step`` gives when it is folded over ``days`` (one in each month, ascending), told
    apart by ``ds``: one scan of the accounts, however many months there are.

    A row that wins its account and month is in the snapshots from that month on, until the account has a
    newer winner or the window leaves the row's load month or event behind, and in none after. So the fold is
    an interval per winner, cut by the next winner of the account. Winners are picked by a partial aggregate; the
    window over an account meets at most one row per month. ``previous`` is the snapshot before the first day; a row
    in it of the first month or later is an error, as the fold would weigh it against newer rows.
    """
    steps = [d[:7] for d in days]
    if not steps or sorted(set(steps)) != steps:
        raise ValueError("days must be ascending, one in each month")
    starts = [_window_start(d, months) for d in days]
    outs = list(values)
    event_out = next(out for out, src in values.items() if src == event_time)
    month_date = F.concat(F.col(month), F.lit("-01"))
    fresh = accounts.filter(F.col(month).isin(*steps)).select(
        F.col(key),
        (F.array_position(F.array(*[F.lit(s) for s in steps]), F.col(month)) - 1).cast("int").alias("_from"),
        *[F.col(src).alias(out) for out, src in values.items()],
        month_date.alias("latest_index_update"),
        _event_steps(starts, F.col(event_time).cast("string")).alias("_until"),
        (F.col(tie) if tie else F.lit(0)).alias("_tie"),
    )
    known = ~F.coalesce(F.col(key).cast("string").isin(*ACCOUNT_SENTINELS), F.lit(False))
    inside = fresh.filter(known & (F.col("_until") > F.col("_from")))
    whole = [*outs, "latest_index_update", "_until"]
    best = inside.groupBy(key, "_from").agg(F.max_by(F.struct(*whole), F.struct("_tie")).alias("_row"))
    winners = best.select(key, "_from", *[F.col(f"_row.{c}").alias(c) for c in whole])
    if previous is not None:
        late = F.col("latest_index_update") >= f"{steps[0]}-01"
        liu = F.when(late, F.raise_error(F.lit("the previous snapshot holds rows of the first month or later"))).otherwise(
            F.col("latest_index_update")
        )
        old = previous.filter(known & F.col("latest_index_update").isNotNull()).select(
            F.col(key), F.lit(-1).alias("_from"), *outs, liu.alias("latest_index_update"),
            _event_steps(starts, F.col(event_out).cast("string")).alias("_until"),
        )
        winners = winners.unionByName(old)
    after = F.lead("_from").over(Window.partitionBy(key).orderBy("_from"))
    last = F.least(F.col("_until"), _month_steps(starts, F.col("latest_index_update")), F.coalesce(F.col("_next"), F.lit(len(days))))
    first = F.greatest("_from", F.lit(0))
    alive = winners.withColumn("_next", after).filter(last > first)
    every = alive.withColumn("_step", F.explode(F.sequence(first, last - 1)))
    ds = F.get(F.array(*[F.lit(d) for d in days]), F.col("_step"))
    return every.select(key, *outs, "latest_index_update", ds.alias("ds"))


def backfill(step: Callable[[DataFrame, str], DataFrame], start: DataFrame, months: Iterable[str],
             save: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Folds ``step(snapshot, ds)`` over months in order. ``save`` writes each snapshot and reads
    it back, so a lost executor never replays earlier months."""
    snapshot = start
    for ds in months:
        snapshot = save(step(snapshot, ds), ds)
    return snapshot

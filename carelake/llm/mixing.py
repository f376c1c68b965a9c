"""Mixing sources to target weights by Pareto order sampling, with built-in functions only.

Every source gets a target in words; targets above ``most`` times the source are cut there and the
excess is shared again by weight. A source that must give ``f`` times its words gives each document
``floor(f)`` whole copies for certain; the rest ``p = f - floor(f)`` is the inclusion probability of
one more copy. Documents are ranked by Pareto's order, the odds of a seeded random number over the
odds of ``p``, and taken from the front while their words fit the rest of the target (a sample of
fixed size). A document that does not fit ends a round; a further round goes down the same ranks with
those documents that still fit, so that one long document leaves no hole.

No window sees the documents of a source: words are summed per source and cell of the rank, and only
the rows of the one cell where the target is reached are ranked one by one. The outcome is a
threshold per source and round, so documents are chosen where they lie, without a shuffle.

Nulls: a null text has no words; null is a source of its own, the last. Documents without words are
never taken. Repeated rows (equal key) share their random number. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.position import with_position
from ..session import written

WORD = r"[^\x20\x09-\x0D]+"
_CELLS = 1024


def words(text: str) -> Column:
    """Number of runs of other characters than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(key: str, seed: int) -> Column:
    """A number strictly between 0 and 1 from the key: 52 bits of its MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """``sizes`` (_source, _total) with ``_target``. Only sums over the sources reach the driver."""
    ranked = with_position(sizes, [F.col("_source").asc_nulls_last()], "_rank", unique=True)
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = written(
        ranked.withColumn("_weight", F.element_at(cycle, (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int")))
        .withColumn("_cap", F.col("_total") * most),
        "sources",
    )
    whole = weighed.agg(F.sum("_total")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        over = F.col("_weight") * level > F.col("_cap")
        held, free, now = weighed.agg(
            F.sum(F.when(over, F.col("_cap"))), F.sum(F.when(~over, F.col("_weight"))), F.count(F.when(over, 1))
        ).first()
        if now == capped or not free:
            break
        level, capped = (share * whole - (held or 0)) / free, now
    target = F.least(F.col("_cap").cast("double"), F.col("_weight") * F.lit(level))
    return weighed.select("_source", "_total", target.alias("_target"))


def _first_above(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Of rows (_source, _before, _need, order.., _words): those up to which the words still fit, as
    ``_cum`` before and with each row. At most one cell's rows per source come here."""
    w = Window.partitionBy("_source").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("_cum", F.col("_before") + F.sum("_words").over(w))


def _crossing(rows: DataFrame, order: str) -> DataFrame:
    """The first value of ``order`` per source at which the words no longer fit."""
    return (
        _first_above(rows, [order])
        .filter(F.col("_cum") > F.col("_need"))
        .groupBy("_source")
        .agg(F.min(F.struct(order, (F.col("_cum") - F.col("_words")).alias("_before"), "_need")).alias("_x"))
        .select("_source", "_x.*")
    )


def _on_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joins on the source, null being a value."""
    right = right.withColumnRenamed("_source", "_right")
    return left.join(right, left["_source"].eqNullSafe(right["_right"]), how).drop("_right")


def _threshold(candidates: DataFrame, needs: DataFrame) -> DataFrame:
    """Per source: the cell and, in it, the last (q, key) that still fit. No row: everything fits."""
    rows = _on_source(candidates, needs).filter((F.col("_words") > 0) & (F.col("_words") <= F.col("_need")))
    coarse = rows.groupBy("_source", "_need", F.floor(F.col("_cell") / _CELLS).alias("_coarse")).agg(F.sum("_words").alias("_words"))
    coarse = _crossing(coarse.withColumn("_before", F.lit(0.0)), "_coarse")
    inside = _on_source(rows.drop("_need"), coarse).filter(F.floor(F.col("_cell") / _CELLS) == F.col("_coarse"))
    fine = _crossing(inside.groupBy("_source", "_need", "_before", "_cell").agg(F.sum("_words").alias("_words")), "_cell")
    last = _on_source(rows.drop("_need").withColumnRenamed("_cell", "_at"), fine).filter(F.col("_at") == F.col("_cell"))
    ranked = _first_above(
        last.groupBy("_source", "_need", "_before", "_cell", "_q", "_key").agg(F.sum("_words").alias("_words")), ["_q", "_key"]
    )
    return ranked.groupBy("_source", "_cell").agg(
        F.max(F.when(F.col("_cum") <= F.col("_need"), F.struct("_q", "_key"))).alias("_last")
    )


def mixed(
    df: DataFrame, seed: int = 20, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2, rounds: int = 3,
) -> DataFrame:
    """``df`` with ``size`` (words), ``source_size``, ``target`` (both of the source) and ``copies``
    (int, how often the mix takes the document, ``most`` at most).

    ``rounds`` is the number of passes that fill what a source still lacks after documents too long for it were
    skipped; what is lacking after the last pass stays so.
    ``weights`` go round the sources in code point order. All targets together are ``share`` times
    all words, as far as ``most`` times every source allows.
    """
    light = written(
        df.select(F.col(source).alias("_source"), F.col(key).alias("_key"), words(text).alias("_words"), uniform(key, seed).alias("_u")),
        "words",
    )
    aims = targets(light.groupBy("_source").agg(F.sum("_words").alias("_total")), weights, share, most)
    factor = F.when(F.col("_total") > 0, F.col("_target") / F.col("_total")).otherwise(0.0)
    whole = F.least(F.floor(factor), F.lit(most))
    # As a file, so that Spark sees how small the table of sources is and joins it without a shuffle.
    plan = written(
        aims.withColumns({"_whole": whole, "_p": factor - whole, "_need0": F.col("_target") - whole * F.col("_total")}), "plan"
    )
    for k in range(rounds):
        ranks = _ranked(_on_source(light, plan), k).select("_source", "_key", "_words", "_q", "_cell", "_taken")
        left = ranks.filter(~F.col("_taken")).drop("_taken")
        needs = plan.select("_source", F.col(f"_need{k}").alias("_need")).filter(F.col("_need") >= 1)
        found = _threshold(left, needs).select("_source", F.col("_cell").alias(f"_cell{k}"), F.col("_last").alias(f"_last{k}"))
        plan = written(_on_source(plan, found, "left"), f"round{k}")
        if k + 1 < rounds:
            now = _ranked(_on_source(light, plan), k + 1).filter("_taken").groupBy("_source").agg(F.sum("_words").alias("_got"))
            rest = _on_source(plan, now, "left").withColumn(f"_need{k + 1}", F.col("_need0") - F.coalesce("_got", F.lit(0)))
            plan = written(rest.drop("_got"), f"rest{k}")
    kept = [c for c in df.columns if c.lower() not in ("size", "source_size", "target", "copies")]
    marked = df.withColumns({"_source": F.col(source), "_key": F.col(key), "_words": words(text), "_u": uniform(key, seed)})
    chosen = _ranked(_on_source(marked, plan), rounds)
    copies = F.when(F.col("_words") > 0, F.col("_whole") + F.col("_taken").cast("int")).otherwise(0).cast("int")
    return chosen.select(
        *kept, F.col("_words").alias("size"), F.col("_total").alias("source_size"), F.col("_target").alias("target"), copies.alias("copies")
    )


def _ranked(rows: DataFrame, rounds: int) -> DataFrame:
    """Pareto's rank ``_q``, its cell and whether one of the first ``rounds`` rounds took the row."""
    odds = (F.col("_u") / (1 - F.col("_u"))) / (F.col("_p") / (1 - F.col("_p")))
    ranked = rows.withColumn("_q", F.when(F.col("_p") > 0, odds))
    ranked = ranked.withColumn("_cell", F.floor(F.col("_q") / (1 + F.col("_q")) * (_CELLS * _CELLS)))
    taken = F.lit(False)
    for k in range(rounds):
        at, last, need = F.col(f"_cell{k}"), F.col(f"_last{k}"), F.col(f"_need{k}")
        fits = at.isNull() | (F.col("_cell") < at) | ((F.col("_cell") == at) & (F.struct("_q", "_key") <= last))
        taken = taken | F.coalesce((F.col("_words") > 0) & (need >= 1) & (F.col("_words") <= need) & F.col("_q").isNotNull() & fits, F.lit(False))
    return ranked.withColumn("_taken", taken)

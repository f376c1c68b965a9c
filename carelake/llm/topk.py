"""Exact top-k search by term-at-a-time accumulation over blocks.

Vectors become sparse rows of integer weights. The rows to search are cut into blocks, and so are the
queries; a pair of blocks meets in one task. There the rows of the block are turned into postings per
term, each query weight scatters its term's postings into dense arrays of scores, and the best k of
each query are selected by partition. The best of the blocks are merged by rank. Queries are a stated
set, so this is a scan of all rows per block of queries and no join of all pairs.

A row takes no part if its vector is null, or holds null or non-finite components, or its id is null.
Vectors may differ in length: a missing term weighs nothing. Ties go to the smaller id. Rows that
share a query's id are not its candidates, and the least of their vectors asks; repeated rows are candidates
each. A weight, or a score among the best, that does not fit a long is an error; sums on the way may exceed a long.
No queries or no rows give an empty result. Other columns of the input are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F


def integer_weights(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component, or null if a component is null or not finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))

    def weight(x: Column) -> Column:
        scaled = x.cast("double") * scale
        too_large = F.raise_error(F.lit("a scaled component does not fit a long")).cast("bigint")
        return F.when(F.abs(scaled) < 2.0**63, F.floor(scaled).cast("bigint")).otherwise(too_large)

    return F.when(fine, F.transform(vector, weight))


def _postings(rows: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per term the places of the rows that hold it and their weights. A term that a quarter of the
    rows hold gets a weight for every place, so that it is added without indexing."""
    lengths = np.array([len(r) for r in rows])
    place = np.repeat(np.arange(len(rows)), lengths)
    term = np.concatenate([np.arange(n) for n in lengths]) if len(rows) else np.empty(0, dtype=np.int64)
    weight = np.concatenate(rows) if len(rows) else np.empty(0, dtype=np.int64)
    held = weight != 0
    place, term, weight = place[held], term[held], weight[held]
    order = np.argsort(term, kind="stable")
    place, term, weight = place[order], term[order], weight[order]
    ends = np.searchsorted(term, np.arange(int(lengths.max(initial=0)) + 1))
    every, out = np.arange(len(rows)), []
    for a, b in zip(ends[:-1], ends[1:]):
        if 4 * (b - a) >= len(rows):
            full = np.zeros(len(rows), dtype=np.int64)
            full[place[a:b]] = weight[a:b]
            out.append((every, full))
        else:
            out.append((place[a:b], weight[a:b]))
    return out


def _best(scores: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Query row and place of the k best per query. Places are in id order and ``own`` marks what is
    no candidate. The place is part of what is compared, so ties need no further care."""
    n = scores.shape[1]
    ranked = scores * -n + np.arange(n)
    ranked[own] = 1 << (62 if scores.dtype != object else 256)
    if n > k:
        at = (np.argpartition(ranked, k - 1, axis=1) if scores.dtype != object else np.argsort(ranked, axis=1))[:, :k]
    else:
        at = np.broadcast_to(np.arange(n), scores.shape)
    query = np.repeat(np.arange(len(scores)), at.shape[1])
    place = at.ravel()
    fine = ~own[query, place]
    return query[fine], place[fine]


def _search(queries: pd.DataFrame, rows: pd.DataFrame, k: int, group: int = 16) -> pd.DataFrame:
    """A few queries at a time, so that their score arrays stay in the processor's cache."""
    rows = rows.sort_values("_id", kind="stable")
    ids = rows["_id"].to_numpy(dtype=np.int64)
    postings = _postings([np.asarray(v, dtype=np.int64) for v in rows["_v"]])
    asked = [np.asarray(v, dtype=np.int64)[: len(postings)] for v in queries["_v"]]
    greatest = lambda vectors: max((max(int(v.max(initial=0)), -int(v.min(initial=0))) for v in vectors), default=0)
    bound = greatest(asked) * greatest(w for _, w in postings) * len(postings)
    # Scores times the number of rows are compared; where they might not fit a long, Python's integers take over.
    kind = object if bound * max(len(ids), 1) >= 1 << 61 else np.int32 if bound < 1 << 31 else np.int64
    postings = [(place, weight.astype(kind)) for place, weight in postings]
    room = np.empty((2, group, len(ids)), dtype=kind)
    found = []
    for at in range(0, len(asked), group):
        n = len(asked[at : at + group])
        qids = queries["_id"].to_numpy(dtype=np.int64)[at : at + n]
        weights = np.zeros((n, len(postings)), dtype=kind)
        for i, v in enumerate(asked[at : at + n]):
            weights[i, : len(v)] = v
        scores, added = room[0, :n], room[1, :n]
        scores[:] = 0
        for term, (place, weight) in enumerate(postings):
            has = np.flatnonzero(weights[:, term])
            if len(has) == 0 or len(place) == 0:
                continue
            if len(place) == len(ids):
                np.multiply(weights[:, term, None], weight, out=added)
                scores += added
            else:
                scores[np.ix_(has, place)] += weights[has, term, None] * weight
        query, place = _best(scores if kind is object else scores.astype(np.int64), qids[:, None] == ids, k)
        best = scores[query, place]
        if kind is object and any(not -(1 << 63) <= int(s) < 1 << 63 for s in best):
            raise ValueError("a score does not fit a long")
        found.append(pd.DataFrame({"query_id": qids[query], "vec_id": ids[place], "score": best.astype(np.int64)}))
    return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)


def top_k(
    df: DataFrame, is_query: Column, k: int = 20, scale: int = 64, key: str = "vec_id", vector: str = "embedding",
    block: int = 4096,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` for the rows where ``is_query`` holds.

    About ``block`` rows meet about ``block`` queries in a task, whatever the size of the table.
    """
    usable = df.withColumn("_v", integer_weights(F.col(vector), scale)).filter(F.col("_v").isNotNull() & F.col(key).isNotNull())
    rows = usable.select(F.col(key).cast("bigint").alias("_id"), "_v", F.coalesce(is_query, F.lit(False)).alias("_q"))
    n, asked = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("_q"), 1))).first()
    row_blocks, query_blocks = max(1, -(-n // block)), max(1, -(-asked // block))
    # The whole row is hashed, so many rows of one id still spread.
    spot = lambda seed, m: F.pmod(F.xxhash64(F.lit(seed), "_id", "_v"), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    searched = rows.select("_id", "_v", spot(1, row_blocks).alias("_r"), every(query_blocks).alias("_s"))
    asking = rows.filter("_q").groupBy("_id").agg(F.min("_v").alias("_v")).select("_id", "_v", every(row_blocks).alias("_r"), spot(2, query_blocks).alias("_s"))

    def meet(queries: pd.DataFrame, block_rows: pd.DataFrame) -> pd.DataFrame:
        return _search(queries, block_rows, k)

    best = asking.groupBy("_r", "_s").cogroup(searched.groupBy("_r", "_s")).applyInPandas(meet, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

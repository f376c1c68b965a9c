"""Ranked lexical search, exact, by a dual-tree walk.

Every document is a vector with a whole-number coordinate for each term of the items it holds, every item a
vector of term weights, and a score is their inner product. In each task the documents of a block and the items
are put into hierarchies whose nodes hold the greatest value of each coordinate below them. The product of an
item node's and a document node's maxima bounds every score of the pair, so a pair that stays below the weakest
k-th score of the node's items is dropped with all its documents and items; what is left at the leaves is scored
exactly. The k-th scores rise from block to block of a task. Each task gives out its best, which are merged.

A document counts as ``tf`` of a term against its length; see ``coordinates``. Products and sums are whole numbers.
They are kept in doubles, which hold them exactly, as long as the largest possible sum is below 2**53, and in
64-bit integers beyond.

Nulls: a null text has no term and is not counted; a null document id ranks before others of its score. Rows that
share an item id are one item with the terms of all of them; a null item id is an item. Empty texts and items
without a known term give no row; long texts are read whole; repeated documents are ranked each, equal rows in any
order. Empty tables give an empty result. Other columns, whatever their name, are not carried.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import written

# Bytes that part terms become blanks, capital letters small ones; every byte of a further sign is kept.
_SIGNS = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
_FANOUT = 4
_ITEM_LEAF, _DOC_LEAF = 4, 8
_EXACT = 1 << 53
_NULL = -(1 << 63)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode().translate(_SIGNS).split() if text else []


def weight(n: int, df: int) -> int:
    """Weight of a term that ``df`` of ``n`` documents hold."""
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def coordinates(tf: np.ndarray, terms: np.ndarray, n: int, total: int) -> np.ndarray:
    """``tf`` of a term against the number of terms of its document, in a collection of ``n`` documents and
    ``total`` terms."""
    m = 100 - 90 + (90 * terms * n) // total
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """Written table of (_item, _term): the different terms of each item."""
    kind = items.schema[key].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in batch.column(1).to_pylist()]
            row = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.record_batch(
                [batch.column(0).take(pa.array(row)), pa.array([t for f in found for t in f], pa.binary())], names=["_item", "_term"]
            )

    pair = items.select(F.col(key).alias("_item"), F.col(text).cast("string").alias("_text"))
    return written(pair.mapInArrow(split, f"_item {kind}, _term binary").distinct(), "items")


def _profiles(docs: DataFrame, key: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """Written table of (_doc, _n, _code, _tf): the number of terms of each document, and those of the
    vocabulary (numbered from 0) with how often it holds them."""
    kind = docs.schema[key].dataType.simpleString()
    numbered = docs.sparkSession.sparkContext.broadcast({t: i + 1 for t, i in vocabulary.items()})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbered.value.get
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                n, held, tf, ends = [], [], [], [0]
                for words in map(terms_of, rows.column(1).to_pylist()):
                    found = Counter(filter(None, map(known, words)))
                    n.append(len(words))
                    held.extend(found)
                    tf.extend(found.values())
                    ends.append(len(held))
                code = np.array(held, dtype=np.int32) - 1
                lists = lambda values: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.record_batch(
                    [rows.column(0), pa.array(n, pa.int64()), lists(pa.array(code, pa.int32())), lists(pa.array(tf, pa.int32()))],
                    names=["_doc", "_n", "_code", "_tf"],
                )

    pair = docs.select(F.col(key).alias("_doc"), F.col(text).cast("string").alias("_text"))
    return written(pair.mapInArrow(count, f"_doc {kind}, _n bigint, _code array<int>, _tf array<int>"), "profiles")


class Tree:
    """A hierarchy over the rows of a matrix of non-negative values: ``levels[0]`` holds the maxima of its
    leaves of ``leaf`` rows, and each further level those of ``_FANOUT`` nodes below. Rows are ordered by their
    greatest coordinate first, so rows of a node have much in common."""

    def __init__(self, rows: np.ndarray, leaf: int):
        lead = rows.argmax(axis=1) if rows.shape[1] else np.zeros(len(rows), dtype=np.int64)
        self.order = np.lexsort((-rows.max(axis=1, initial=0), lead))
        self.leaf = leaf
        self.rows = rows[self.order]
        self.levels = [self._maxima(self.rows, leaf)]
        while len(self.levels[-1]) > 1:
            self.levels.append(self._maxima(self.levels[-1], _FANOUT))

    @staticmethod
    def _maxima(rows: np.ndarray, size: int) -> np.ndarray:
        return np.maximum.reduceat(rows, np.arange(0, len(rows), size), axis=0)


class Search:
    """The k best documents of each item among the blocks met so far. ``weights`` has a row per item."""

    def __init__(self, weights: np.ndarray, k: int):
        self.k = k
        self.items = Tree(weights, _ITEM_LEAF)
        n = len(weights)
        self.score = np.zeros((n, k), dtype=weights.dtype)  # in the order of the tree; 0: no document yet
        self.doc = np.zeros((n, k), dtype=np.int64)
        self.compared = 0

    def _weakest(self) -> list[np.ndarray]:
        """The least k-th score below each item node, level by level."""
        floor = [np.minimum.reduceat(self.score[:, -1], np.arange(0, len(self.score), _ITEM_LEAF))]
        while len(floor[-1]) > 1:
            floor.append(np.minimum.reduceat(floor[-1], np.arange(0, len(floor[-1]), _FANOUT)))
        return floor

    def block(self, coords: np.ndarray, ids: np.ndarray) -> None:
        """Searches a block of documents; the smaller id comes first among equal scores."""
        docs = Tree(coords, _DOC_LEAF)
        ids = ids[docs.order]
        floor = self._weakest()
        a, b = len(self.items.levels) - 1, len(docs.levels) - 1
        pairs = np.ones((1, 1), dtype=bool)
        while True:
            pairs = self._kept(pairs, self.items.levels[a], docs.levels[b], floor[a])
            if (a == 0 and b == 0) or not pairs.any():
                break
            if a > 0:
                a -= 1
                pairs = np.repeat(pairs, _FANOUT, axis=0)[: len(self.items.levels[a])]
            if b > 0:
                b -= 1
                pairs = np.repeat(pairs, _FANOUT, axis=1)[:, : len(docs.levels[b])]
        for node in np.flatnonzero(pairs.any(axis=1)):
            self._score(int(node), np.flatnonzero(pairs[node]), docs, ids)

    @staticmethod
    def _kept(pairs: np.ndarray, items: np.ndarray, docs: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Pairs of nodes that may hold a score above 0 and not below the weakest k-th one."""
        rows, cols = np.flatnonzero(pairs.any(axis=1)), np.flatnonzero(pairs.any(axis=0))
        out = np.zeros_like(pairs)
        if len(rows) and len(cols):
            used = np.flatnonzero(items[rows].any(axis=0))
            bound = items[np.ix_(rows, used)] @ docs[np.ix_(cols, used)].T
            out[np.ix_(rows, cols)] = (bound > 0) & (bound >= floor[rows, None])
        return out & pairs

    def _score(self, node: int, leaves: np.ndarray, docs: Tree, ids: np.ndarray) -> None:
        """Exact scores of an item leaf against document leaves, the most promising first."""
        mine = slice(node * _ITEM_LEAF, (node + 1) * _ITEM_LEAF)
        weights = self.items.rows[mine]
        used = np.flatnonzero(weights.any(axis=0))
        weights = weights[:, used]
        bound = (weights.max(axis=0) @ docs.levels[0][np.ix_(leaves, used)].T)
        order = np.argsort(-bound, kind="stable")
        step = 16
        for at in range(0, len(order), step):
            some = order[at : at + step]
            some = some[bound[some] >= self.score[mine, -1].min()]
            if not len(some):
                break  # bounds fall from here on
            rows = (leaves[some][:, None] * _DOC_LEAF + np.arange(_DOC_LEAF)).ravel()
            rows = rows[rows < len(docs.rows)]
            scores = weights @ docs.rows[np.ix_(rows, used)].T
            self.compared += scores.size
            for i in range(len(scores)):
                self._take(mine.start + i, scores[i], ids[rows])

    def _take(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        fine = np.flatnonzero((scores > 0) & (scores >= self.score[item, -1]))
        if not len(fine):
            return
        score = np.concatenate([self.score[item], scores[fine]])
        doc = np.concatenate([self.doc[item], ids[fine]])
        best = np.lexsort((doc, -score))
        best = best[score[best] > 0][: self.k]
        self.score[item] = 0
        self.score[item, : len(best)], self.doc[item, : len(best)] = score[best], doc[best]


def _dense(code: pa.ListArray, values: np.ndarray, width: int, kind) -> np.ndarray:
    lengths = np.diff(code.offsets.to_numpy())
    out = np.zeros((len(code), width), dtype=kind)
    out[np.repeat(np.arange(len(code)), lengths), code.flatten().to_numpy(zero_copy_only=False)] = values
    return out


def _searched(
    profiles: DataFrame, names: pa.Array, weights: np.ndarray, n: int, total: int, k: int, cells: int, item_kind: str
) -> DataFrame:
    """(_item, _doc, _score): each task's best for the items ``names``, a row of ``weights`` each."""
    block = max(_DOC_LEAF, min(4096, cells // max(weights.shape[1], 1)))
    shared = profiles.sparkSession.sparkContext.broadcast((names, weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, matrix = shared.value
        own = Search(matrix, k)
        for batch in batches:
            for begin in range(0, batch.num_rows, block):
                rows = batch.slice(begin, block)
                code, tf = rows.column(2), rows.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                lengths = np.diff(code.offsets.to_numpy())
                terms = np.repeat(rows.column(1).to_numpy(zero_copy_only=False), lengths)
                coords = np.zeros((len(lengths), matrix.shape[1]), dtype=matrix.dtype)
                place = np.repeat(np.arange(len(lengths)), lengths), code.flatten().to_numpy(zero_copy_only=False)
                coords[place] = coordinates(tf, terms, n, total) if total else 0
                own.block(coords, rows.column(0).fill_null(_NULL).to_numpy(zero_copy_only=False))
        row, slot = np.nonzero(own.score > 0)
        doc = own.doc[row, slot]
        yield pa.record_batch(
            [asked.take(pa.array(own.items.order[row])), pa.array(doc, mask=doc == _NULL), pa.array(own.score[row, slot].astype(np.int64))],
            names=["_item", "_doc", "_score"],
        )

    return profiles.select("_doc", "_n", "_code", "_tf").mapInArrow(search, f"_item {item_kind}, _doc bigint, _score bigint")


def ranked(
    docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", pairs: int = 1 << 14, most_items: int = 1 << 10, cells: int = 1 << 22,
) -> DataFrame:
    """``item_key``, ``rank`` (from 1), ``key``, ``score``: the ``k`` best documents of each item with a score above 0,
    equal scores by ascending ``key`` (a whole number; ``-2**63`` reads as null).

    Items are asked in batches of about ``pairs`` terms and ``most_items`` items, which bounds what is sent to the
    tasks by the batch, however many items there are; each batch reads the documents. ``cells`` bounds a block's
    coordinates, so a block holds fewer documents where there are more terms.
    """
    spark = docs.sparkSession
    terms = item_terms(items, item_key, item_text)
    number, asked = terms.agg(F.count(F.lit(1)), F.count_distinct(F.struct("_item"))).first()
    batches = max(1, -(-number // pairs), -(-asked // most_items))
    item_kind = items.schema[item_key].dataType.simpleString()
    whole = docs.select(F.col(key).cast("bigint").alias(key), text)
    found = []
    for b in range(batches if number else 0):
        mine = terms.filter(F.pmod(F.xxhash64("_item"), F.lit(batches)) == b).toArrow()
        if not mine.num_rows:
            continue
        vocabulary = {t: i for i, t in enumerate(sorted(set(mine.column("_term").to_pylist())))}
        profiles = _profiles(whole, key, text, vocabulary)
        n, total = profiles.agg(F.count(F.when(F.col("_n") > 0, 1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
        held = profiles.select(F.explode("_code").alias("_code")).groupBy("_code").count().collect()  # a row per term
        names, weights = _weights(mine, vocabulary, dict(map(tuple, held)), n)
        found.append(_searched(profiles, names, weights, n, total, k, cells, item_kind))
    if not found:
        return spark.createDataFrame([], f"{item_key} {item_kind}, rank int, {key} bigint, score bigint")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    # Tasks are merged in groups first, so that no task sorts the best of all tasks for an item.
    best = [F.desc("_score"), F.col("_doc").asc_nulls_first()]
    group = F.pmod(F.xxhash64("_doc"), F.lit(64))
    within = Window.partitionBy("_item", "_group").orderBy(*best)
    some = every.withColumn("_group", group).withColumn("_r", F.row_number().over(within)).filter(F.col("_r") <= k)
    last = Window.partitionBy("_item").orderBy(*best)
    return some.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k).select(
        F.col("_item").alias(item_key), "rank", F.col("_doc").alias(key), F.col("_score").alias("score")
    )


def _weights(mine: pa.Table, vocabulary: dict[bytes, int], held: dict[int, int], n: int) -> tuple[pa.Array, np.ndarray]:
    """The items and their weights per term, as doubles where every sum stays exact in them."""
    item = mine.column("_item").combine_chunks().dictionary_encode(null_encoding="encode")
    by_term = np.array([weight(n, held.get(i, 0)) for i in range(len(vocabulary))], dtype=np.int64)
    exact = len(vocabulary) * int(by_term.max(initial=0)) * 1_000_000 < _EXACT
    weights = np.zeros((len(item.dictionary), len(vocabulary)), dtype=np.float64 if exact else np.int64)
    code = np.array([vocabulary[t] for t in mine.column("_term").to_pylist()], dtype=np.int64)
    weights[item.indices.to_numpy(zero_copy_only=False), code] = by_term[code]
    return item.dictionary, weights

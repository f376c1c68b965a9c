"""Near-duplicate documents by DartMinHash and banding.

A document is a weighted set: its shingles of five words, each weighing as often as it occurs. Darts
are thrown at the region of each element (a Poisson process over weight and rank, seeded by the
element alone): documents that share an element see the same darts in the part of the region they
share. A document looks at ranks below a limit that gives it about ``k ln k + 2 k`` darts however long
it is; every dart is hashed to one of ``k`` coordinates, and the earliest dart of a coordinate is the
signature there. Two documents agree at a coordinate as often as their weighted Jaccard similarity.

Bands of the signature are the candidates' keys. In a band's bucket no pairs are listed: members are
compared with one representative, and the links found join documents to groups. Buckets that still
hold several groups get another representative. The documents of buckets that are mixed even then are
compared across groups, where a prefix filter tells the pairs: two documents can only be similar if
they share one of their rarest shingles, so a line that many documents hold makes no pairs. That step
is exact, so no bucket is too large. Every link rests on the exact weighted similarity of the two documents; classes are the connected
components of the links.

Texts equal after folding (lower case, words split at ASCII white space) are one class from the
start, represented by the smallest key, so a group of copies of any size is one row. A text of one to
four words is a single shingle. Nulls: a null text, or one without a word, is a class of its own, as
is a row with a null key. Rows that repeat a key are one document; of several texts under one key the
one with the least digest counts, but ``deduplicated`` compares each of them. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import graph
from ..operators.position import with_position
from ..session import written

_U64 = np.uint64
_GOLD = _U64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift, multiply, xor), element by element."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def folded(text: Column) -> Column:
    """Words in lower case with one space between; the text by which copies are recognised."""
    return F.trim(F.regexp_replace(F.lower(text), F.lit(r"[\x20\x09-\x0D]+"), F.lit(" ")))


def shingles(text: str, size: int = 5) -> np.ndarray:
    """Sorted hashes of the runs of ``size`` words, one for each time a run occurs."""
    words = text.split(" ")
    hashed: dict[str, int] = {}
    for w in set(words):
        hashed[w] = xxhash.xxh3_64_intdigest(w)
    h = np.array([hashed[w] for w in words], dtype=_U64)
    n = max(len(h) - size + 1, 1)
    run = np.zeros(n, dtype=_U64)
    for i in range(min(size, len(h))):
        run = _mix(run * _GOLD + h[i : i + n])
    return np.sort(run)


def _uniform(bits: np.ndarray) -> np.ndarray:
    return ((bits >> _U64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def signatures(sets: list[np.ndarray], k: int) -> np.ndarray:
    """A row of ``k`` fingerprints for each sorted multiset of hashes.

    A cell is one unit of weight of one element: the ``j``-th copy of a hash is the cell (hash, j).
    Its darts arrive at ranks with exponential gaps, drawn from hashes of cell and dart number, so a
    longer document, which looks at lower ranks only, sees a prefix of the same darts.
    """
    darts = k * math.log(k) + 2 * k
    out = np.zeros((len(sets), k), dtype=_U64)
    size = np.array([len(s) for s in sets])
    todo, reach = np.arange(len(sets)), 1.0
    while len(todo):
        elements = np.concatenate([sets[i] for i in todo])
        row = np.repeat(np.arange(len(todo)), size[todo])
        first = np.r_[True, (elements[1:] != elements[:-1]) | (row[1:] != row[:-1])]
        copy = np.arange(len(elements)) - np.maximum.accumulate(np.where(first, np.arange(len(elements)), 0))
        cell = _mix(elements ^ _mix(copy.astype(_U64) * _GOLD + _U64(1)))
        limit = (reach * darts / size[todo])[row]  # in units of the expected gap
        rank = np.zeros(len(cell))
        earliest = np.full(len(todo) * k, np.inf)
        found = np.zeros(len(todo) * k, dtype=_U64)
        number = 0
        while len(cell):
            number += 1
            dart = _mix(cell + _U64(number * int(_GOLD) % (1 << 64)))
            rank = rank - np.log(_uniform(_mix(dart ^ _U64(0xA5A5A5A5A5A5A5A5))))
            alive = rank < limit
            cell, rank, limit, row, dart = cell[alive], rank[alive], limit[alive], row[alive], dart[alive]
            spot = row * k + (dart % _U64(k)).astype(np.int64)
            order = np.lexsort((dart, rank))[::-1]  # the earliest is written last and stays
            better = rank[order] < earliest[spot[order]]
            order = order[better]
            earliest[spot[order]] = rank[order]
            found[spot[order]] = dart[order]
        full = np.isfinite(earliest).reshape(len(todo), k).all(axis=1)
        out[todo[full]] = found.reshape(len(todo), k)[full]
        todo, reach = todo[~full], reach * 2
    return out


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted multisets."""
    values, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x = np.bincount(at[: len(a)], minlength=len(values))
    y = np.bincount(at[len(a) :], minlength=len(values))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


def sketched(docs: DataFrame, bands: int, rows: int, size: int) -> DataFrame:
    """``docs`` (id, _d, _text) to (id, _d, n, bands, profile): number of shingles, band keys and the
    sorted 32-bit hashes of the shingles, from which similarities are computed."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = _mix(np.arange(1, bands + 1, dtype=_U64) * _GOLD)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                begin, sets, cells = at, [], 0
                while at < batch.num_rows and cells < 1_000_000:
                    sets.append(shingles(batch.column(2)[at].as_py(), size))
                    cells += len(sets[-1]) + 2000
                    at += 1
                key = np.tile(salt, (len(sets), 1))
                signature = signatures(sets, bands * rows).reshape(len(sets), bands, rows)
                for r in range(rows):
                    key = _mix(key * _GOLD + signature[:, :, r])
                flat = pa.array(key.ravel().view(np.int64))
                offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands)
                profiles = [np.sort((s >> _U64(32)).astype("<u4")).tobytes() for s in sets]
                yield pa.record_batch(
                    [
                        batch.column(0).slice(begin, at - begin), batch.column(1).slice(begin, at - begin),
                        pa.array([len(s) for s in sets], pa.int32()), pa.ListArray.from_arrays(offsets, flat),
                        pa.array(profiles, pa.binary()),
                    ],
                    names=["id", "_d", "n", "bands", "profile"],
                )

    return docs.mapInArrow(sketch, "id bigint, _d binary, n int, bands array<bigint>, profile binary")


def linked(pairs: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """Those pairs (a < b) whose exact similarity reaches the threshold."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.zeros(batch.num_rows, dtype=bool)
            last = None
            for i, (x, y) in enumerate(zip(batch.column("pa"), batch.column("pb"))):
                x, y = x.as_buffer(), y.as_buffer()
                if last is None or not last[0].equals(x):
                    last = (x, np.frombuffer(x, dtype="<u4"))
                near[i] = similarity(last[1], np.frombuffer(y, dtype="<u4")) >= threshold
            keep = pa.array(np.flatnonzero(near))
            yield pa.record_batch([batch.column("a").take(keep), batch.column("b").take(keep)], names=["a", "b"])

    side = lambda c: sketches.select(F.col("h").alias(c), F.col("n").alias(f"n{c}"), F.col("profile").alias(f"p{c}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    possible = F.least("na", "nb") >= threshold * F.greatest("na", "nb")  # sizes alone rule others out
    return joined.filter(possible).select("a", "b", "pa", "pb").mapInArrow(compare, "a bigint, b bigint")


def prefix_pairs(docs: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a < b) of different groups that can reach the threshold. ``docs``: (h, g, n, profile).

    Shingles are put in one order, the rarest first. Documents that share ``threshold`` of their
    shingles share one among the first ``n - ceil(threshold n) + 1`` of each, and behind the first one
    they share enough must be left in both to make up the overlap.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                values = np.frombuffer(batch.column("profile")[i].as_buffer(), dtype="<u4")
                first = np.r_[True, values[1:] != values[:-1]]
                at = np.arange(len(values))
                copy = at - np.maximum.accumulate(np.where(first, at, 0))
                tokens = (values.astype(_U64) << _U64(32) | copy.astype(_U64)).view(np.int64)
                own = [pa.array(np.full(len(values), batch.column(c)[i].as_py(), dtype=np.int64)) for c in ("h", "g", "n")]
                yield pa.record_batch([*own, pa.array(tokens)], names=["h", "g", "n", "token"])

    tokens = written(docs.select("h", "g", "n", "profile").mapInArrow(spread, "h bigint, g bigint, n bigint, token bigint"), "tokens")
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("f")).filter(F.col("f") > 1)
    of_doc = Window.partitionBy("h")
    ranked = tokens.join(shared, "token").withColumns(
        {"_rank": F.row_number().over(of_doc.orderBy("f", "token")), "_shared": F.count(F.lit(1)).over(of_doc)}
    )
    # A shingle that no other document holds stands before all that are shared.
    length = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1
    placed = ranked.withColumn("place", F.col("n") - F.col("_shared") + F.col("_rank")).filter(F.col("place") <= length)
    prefix = written(placed.select("h", "g", "n", "token", "place"), "prefix")
    other = prefix.select("token", *[F.col(c).alias(f"{c}2") for c in ("h", "g", "n", "place")])
    overlap = F.lit(threshold / (1 + threshold)) * (F.col("n") + F.col("n2")) - 1e-9
    met = prefix.join(other, "token").filter(
        (F.col("h") < F.col("h2")) & (F.col("g") != F.col("g2"))
        & (F.least("n", "n2") >= threshold * F.greatest("n", "n2"))
        & (1 + F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2")) >= overlap)
    )
    return met.select(F.col("h").alias("a"), F.col("h2").alias("b"))


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def near_links(sketches: DataFrame, heads: DataFrame, threshold: float, stars: int = 2) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that connect all similar candidates, and (node, root) of the linked documents."""
    of_head = heads.withColumnRenamed("_d", "_hd")
    own = (F.col("id") == F.col("h")) & (F.col("_d") == F.col("_hd"))
    rows = written(sketches.select("id", "_d", "bands").join(of_head, own).select("h", F.explode("bands").alias("band")), "bands")
    shared = rows.groupBy("band").agg(F.min("h").alias("_lo"), F.max("h").alias("_hi")).filter(F.col("_lo") < F.col("_hi"))
    buckets = written(rows.join(shared.select("band"), "band").distinct(), "buckets")
    # Only documents that share a bucket are ever compared; their profiles are put aside once.
    profiles = sketches.select("id", "_d", "n", "profile").join(of_head, own).join(buckets.select("h"), "h", "left_semi")
    profiles = written(profiles.select("h", "n", "profile").dropDuplicates(["h"]), "profiles")
    links, tried, groups = None, None, None
    for star in range(stars + 1):
        inside = buckets.withColumn("g", F.col("h"))
        if groups is not None:
            inside = buckets.join(groups.withColumnRenamed("node", "h"), "h", "left").withColumn("g", F.coalesce("root", "h")).drop("root")
            mixed = inside.groupBy("band").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).filter(F.col("lo") < F.col("hi"))
            inside = written(inside.join(mixed.select("band"), "band"), f"mixed{star}")
        if star < stars:
            order = F.struct(F.xxhash64(F.lit(star), "h") if star else F.lit(0), "h", "g")
            head = inside.groupBy("band").agg(F.min(order).alias("_x")).select("band", F.col("_x.h").alias("r"), F.col("_x.g").alias("rg"))
            pairs = inside.join(head, "band").filter(F.col("g") != F.col("rg")).select(*_ordered("h", "r"))
        else:  # what no representative could settle
            pairs = prefix_pairs(inside.select("h", "g").distinct().join(profiles, "h"), threshold)
        pairs = pairs.distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = written(pairs, f"pairs{star}")
        if pairs.isEmpty():
            if star < stars and groups is not None:
                continue
            if groups is None:
                break
        found = written(linked(pairs, profiles, threshold), f"links{star}")
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        if star < 1 or not found.isEmpty():
            groups = graph.components(links.select(F.col("a").alias("lo"), F.col("b").alias("hi")))
    empty = rows.select(F.col("h").alias("a"), F.col("h").alias("b")).limit(0)
    return (links if links is not None else empty), (groups if groups is not None else empty.select(F.col("a").alias("node"), F.col("b").alias("root")))


def near_duplicates(
    df: DataFrame, threshold: float = 0.8, key: str = "doc_id", text: str = "text", words: int = 5, bands: int = 40, rows: int = 7
) -> DataFrame:
    """One row per input row: ``key``, ``class_id`` (smallest key of its class) and ``kept`` (it is
    that key). With 40 bands of 7 rows a pair of similarity 0.8 is missed once in ten thousand."""
    base = df.select(F.col(key).cast("bigint").alias("id"), folded(F.col(text)).alias("_text"))
    full = base.filter(F.col("id").isNotNull() & (F.col("_text") != ""))
    docs = full.select("id", F.unhex(F.sha2("_text", 256)).alias("_d"), "_text")
    sketches = written(sketched(docs, bands, rows, words), "sketches")
    copies = written(sketches.groupBy("id").agg(F.min("_d").alias("_d")), "copies")
    heads = written(copies.groupBy("_d").agg(F.min("id").alias("h")), "heads")
    _, groups = near_links(sketches, heads, threshold)
    of_text = heads.join(groups, F.col("h") == F.col("node"), "left").select("_d", F.coalesce("root", "h").alias("_root"))
    own = copies.join(of_text, "_d").select("id", "_root")
    every = df.select(F.col(key).cast("bigint").alias("id")).join(own, "id", "left")
    return every.select(
        F.col("id").alias(key), F.coalesce("_root", "id").alias("class_id"), (F.coalesce("_root", "id") == F.col("id")).alias("kept")
    )


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each class: that of the smallest key. Rows with a null key are kept. Texts that share a key are
    documents of their own here: each is compared, and one row of it stays unless its class has a smaller one."""
    content = F.coalesce(F.col(text), F.lit(""))
    mark = F.xxhash64(content)
    per_key = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min(mark).alias("_lo"), F.max(mark).alias("_hi"))
    repeated = written(per_key.filter("_n > 1").select(key, (F.col("_lo") < F.col("_hi")).alias("_several")), "repeated")
    if not repeated.filter("_several").isEmpty():
        return _one_of_each_text(df, repeated, key, text, options)
    classes = near_duplicates(df, key=key, text=text, **options)
    gone = written(classes.filter(~F.col("kept")).select(key).distinct(), "gone")
    stay = df.join(gone, key, "left_anti")
    once = stay.join(repeated, key, "left_anti")
    return once.unionByName(stay.join(repeated, key, "left_semi").dropDuplicates([key])).select(*df.columns)


def _one_of_each_text(df: DataFrame, repeated: DataFrame, key: str, text: str, options: dict) -> DataFrame:
    """``deduplicated`` where keys hold several texts: documents are numbered by key and digest and compared by number."""
    named = df.withColumn("_sha", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    whole = named.filter(F.col(key).isNotNull())
    pairs = whole.select(key, "_sha").distinct()
    numbered = written(with_position(pairs, [F.col(key), F.col("_sha")], "_number", unique=True), "numbered")
    rest = whole.join(repeated, key, "left_anti")
    again = whole.join(repeated, key, "left_semi").dropDuplicates([key, "_sha"])
    docs = rest.unionByName(again)
    texts = docs.select(key, "_sha", text).join(numbered, [key, "_sha"]).select("_number", text)
    classes = near_duplicates(texts, key="_number", text=text, **options)
    kept = written(numbered.join(classes.filter("kept").select("_number"), "_number", "left_semi").select(key, "_sha"), "kept")
    return docs.join(kept, [key, "_sha"], "left_semi").unionByName(named.filter(F.col(key).isNull())).select(*df.columns)

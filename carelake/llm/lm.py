"""Language-model scores: stupid backoff over the word n-grams of all documents.

Documents are put into batches of bounded size, where they lie; a batch is written as one row that holds
the hashes of its distinct words, most frequent first, and its documents as places in that list, so no
later pass reads a text. A batch lists each of its n-grams once, with its count, cut by hash range; for
every range the lists of all batches meet in one task, which adds up the count table of that range and
joins it back to the lists: each batch gets, in the order of its list, how often the other batches hold
the n-gram. Batches then sum the scores of their documents. A very frequent n-gram adds one entry per
batch, never one per document or occurrence. The batches are stored in buckets, so only n-gram lists and
counts are shuffled. A row of a list holds about ``3 batch_bytes / 6 / ranges`` n-grams: raise
``batch_bytes`` (64 MB) and ``range_bytes`` (800 MB) together at a hundred terabytes.

The score of a word is ``a^b c(gram) / c(context)`` for the longest n-gram ending there that is seen
elsewhere, ``b`` orders below the full one. Counts leave out the scored document itself, else every
n-gram would be seen. A word that no other document holds counts as ``unseen`` occurrences.

Words are runs of characters other than ASCII white space, in lower case. Nulls: a null text, or one
without a word, has 0 words, score 0 and a null mean. Copies are other documents, so they count for
each other, as do rows that repeat a key. A text of any length is one row of a batch, and longer than
``batch_bytes`` a batch of its own. An empty table gives an empty result. Other columns of the input,
whatever their name, are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import shared_folder

_U64 = np.uint64
_GOLD = _U64(0x9E3779B97F4A7C15)
_ZSTD = pa.Codec("zstd", compression_level=1)
_MOST_BUCKETS = 50_000  # Spark allows 100,000
_ROW_BYTES = 16  # what a document weighs besides its text


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    return x ^ (x >> _U64(32))


def _planes(numbers: np.ndarray) -> bytes:
    """Little-endian numbers byte plane by byte plane, compressed: planes of high bytes are nearly empty."""
    raw = numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True)


def _from_planes(data: pa.Scalar, kind: str) -> np.ndarray:
    buffer = data.as_buffer()
    raw = _ZSTD.decompress(buffer.slice(8), int.from_bytes(buffer.slice(0, 8).to_pybytes(), "little"), asbytes=True)
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _packed(hashes: np.ndarray) -> bytes:
    """Hashes as differences (modulo 2^64), which are small where the hashes ascend."""
    return _planes(np.diff(hashes, prepend=_U64(0)).astype("<u8"))


def _unpacked(data: pa.Scalar) -> np.ndarray:
    return np.cumsum(_from_planes(data, "<u8"), dtype=_U64)


def _small(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """A byte for each number; 255 stands for the next of the long numbers that follow apart."""
    return _planes(np.minimum(numbers, 255).astype(np.uint8)), numbers[numbers >= 255].astype("<i8").tobytes()


def _numbers(low: pa.Scalar, high: pa.Scalar) -> np.ndarray:
    out = _from_planes(low, "u1").astype(np.int64)
    out[out == 255] = np.frombuffer(high.as_buffer(), dtype="<i8")
    return out


def words_of(text: str | None) -> list[bytes]:
    """``bytes.split`` parts at ASCII white space alone."""
    return text.lower().encode().split() if text else []


class _Batch:
    """Documents gathered until their texts fill a batch."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.keys: list[pa.Array] = []
        self.places: list[np.ndarray] = []

    def add(self, key: pa.Array, text: str | None) -> None:
        words, known = words_of(text), self.known
        for word in set(words).difference(known):
            known[word] = len(known)
        self.keys.append(key)
        self.places.append(np.fromiter(map(known.__getitem__, words), dtype=np.uint32, count=len(words)))

    def row(self, number: int) -> pa.RecordBatch:
        places = np.concatenate(self.places)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.known), dtype=_U64, count=len(self.known))
        often = np.bincount(places, minlength=len(hashes))
        order = np.lexsort((hashes, -often))
        rank = np.empty(len(order), dtype="<u4")
        rank[order] = np.arange(len(order))
        keys = pa.concat_arrays(self.keys)
        columns = {
            "batch": pa.array([number], pa.int64()),
            "ids": pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
            "sizes": pa.array([_planes(np.array([len(p) for p in self.places], dtype="<i8"))], pa.binary()),
            "words": pa.array([_packed(hashes[order])], pa.binary()),
            "places": pa.array([_planes(rank[places])], pa.binary()),
            "n_words": pa.array([len(places)], pa.int64()),
        }
        return pa.record_batch(list(columns.values()), names=list(columns))


def batched(df: DataFrame, key: str, text: str, size: int, buckets: int) -> DataFrame:
    """Table (batch, ids, sizes, words, places, n_words) in buckets of ``batch``, a row per batch: consecutive
    rows of a partition, ``size`` bytes of text at most unless a single text is longer."""
    kind = df.schema[key].dataType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, room, open_ = TaskContext.get().partitionId() << 32, size, _Batch()
        for rows in batches:
            bytes_ = rows.column(2).to_numpy(zero_copy_only=False)
            for i, b in enumerate(bytes_):
                if b > room and open_.keys:
                    yield open_.row(number)
                    number, room, open_ = number + 1, size, _Batch()
                open_.add(rows.column(0).slice(i, 1), rows.column(1)[i].as_py())
                room -= b
        if open_.keys:
            yield open_.row(number)

    lengths = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + _ROW_BYTES
    rows = df.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")).withColumn("n_bytes", lengths)
    schema = f"batch bigint, ids array<{kind}>, sizes binary, words binary, places binary, n_words bigint"
    spark, folder = df.sparkSession, shared_folder(df.sparkSession, "lm-batches")
    name = folder.rsplit("/", 1)[-1].replace("-", "_")
    writer = rows.mapInArrow(gather, schema).write.format("parquet").option("compression", "zstd").option("path", folder)
    writer.bucketBy(buckets, "batch").saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # its files stay until the shared folder is released
    return out


def ngrams(hashes: np.ndarray, doc: np.ndarray, order: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For 1 to ``order`` words the hashes of the n-grams by their first word, and which lie in one document."""
    grams, inside = [hashes], [np.ones(len(hashes), dtype=bool)]
    for k in range(1, min(order, len(hashes))):
        grams.append(_mix(grams[-1][:-1] * _GOLD + hashes[k:]))
        inside.append(doc[:-k] == doc[k:])
    return grams, inside


def _read(words: pa.Scalar, places: pa.Scalar, sizes: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch: its word hashes in order, the document of each, and the documents' numbers of words."""
    n = _from_planes(sizes, "<i8")
    return _unpacked(words)[_from_planes(places, "<u4")], np.repeat(np.arange(len(n)), n), n


def listed(batches: DataFrame, order: int, ranges: int) -> DataFrame:
    """Rows (range, batch, grams, low, high): the n-grams of a batch in a hash range and their counts."""
    bounds = np.array([(i << 64) // ranges for i in range(1, ranges)], dtype=_U64)

    def list_(batch: int, words: pa.Scalar, places: pa.Scalar, sizes: pa.Scalar) -> pa.RecordBatch:
        hashes, doc, _ = _read(words, places, sizes)
        every = np.concatenate([g[i] for g, i in zip(*ngrams(hashes, doc, order))])
        grams, counts = np.unique(every, return_counts=True)
        cuts = [0, *np.searchsorted(grams, bounds).tolist(), len(grams)]
        held = [(i, a, b) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
        numbers = [_small(counts[a:b]) for _, a, b in held]
        columns = {
            "range": pa.array([i for i, _, _ in held], pa.int32()),
            "batch": pa.array([batch] * len(held), pa.int64()),
            "grams": pa.array([_packed(grams[a:b]) for _, a, b in held], pa.binary()),
            "low": pa.array([low for low, _ in numbers], pa.binary()),
            "high": pa.array([high for _, high in numbers], pa.binary()),
        }
        return pa.record_batch(list(columns.values()), names=list(columns))

    def lists(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            for batch, words, places, sizes in zip(part.column(0).to_pylist(), *part.columns[1:]):
                yield list_(batch, words, places, sizes)

    rows = batches.select("batch", "words", "places", "sizes")
    return rows.mapInArrow(lists, "range int, batch bigint, grams binary, low binary, high binary")


def counted(lists: DataFrame) -> DataFrame:
    """Rows (batch, range, low, high): per n-gram of a list its count outside the list."""

    def add(rows: pa.Table) -> pa.Table:
        grams = [_unpacked(g) for g in rows.column("grams")]
        counts = [_numbers(*pair) for pair in zip(rows.column("low"), rows.column("high"))]
        _, place = np.unique(np.concatenate(grams), return_inverse=True)
        every = np.concatenate(counts)
        outside = np.bincount(place, weights=every).astype(np.int64)[place] - every
        parts = [_small(part) for part in np.split(outside, np.cumsum([len(g) for g in grams])[:-1])]
        return pa.table({
            "batch": rows.column("batch"),
            "range": rows.column("range"),
            "low": pa.array([low for low, _ in parts], pa.binary()),
            "high": pa.array([high for _, high in parts], pa.binary()),
        })

    return lists.groupBy("range").applyInArrow(add, "batch bigint, range int, low binary, high binary")


def score(
    hashes: np.ndarray, doc: np.ndarray, sizes: np.ndarray, outside: np.ndarray, order: int, words: int, alpha: float, unseen: float
) -> np.ndarray:
    """Per document of a batch the sum of the log scores of its words. ``outside``: the counts of the other
    batches, in the order of the batch's list; ``words``: the number of all words."""
    grams, inside = ngrams(hashes, doc, order)
    lists = []
    for k, i in enumerate(inside):  # order by order, which needs a part of the memory
        each, place, held = np.unique(grams[k][i], return_inverse=True, return_counts=True)
        lists.append((each, place.astype(np.int32), held))
        grams[k] = None
    every = np.unique(np.concatenate([each for each, _, _ in lists]))
    seen = []
    for i, (each, place, held) in zip(inside, lists):
        own = np.ones(len(place), dtype=np.int64)
        again = np.flatnonzero(held[place] > 1)  # the others are their document's only one
        _, at, times = np.unique(doc[: len(i)][i][again] * len(each) + place[again], return_inverse=True, return_counts=True)
        own[again] = times[at]
        counts = np.zeros(len(i), dtype=np.int64)
        counts[i] = (held + outside[np.searchsorted(every, each)])[place] - own
        seen.append(counts)
    del lists, every
    value = np.log(np.maximum(seen[0], unseen) / np.maximum(words - sizes, 1)[doc])
    first = np.cumsum(sizes) - sizes
    longest = np.minimum(np.arange(len(doc)) - first[doc], order - 1)  # orders above one that the place allows
    value += np.log(alpha) * longest
    for k in range(1, len(seen)):  # a longer n-gram that is seen overrides the shorter ones
        hit = np.flatnonzero(seen[k] > 0)
        value[hit + k] = np.log(seen[k][hit] / np.maximum(seen[k - 1][hit], 1)) + np.log(alpha) * (longest[hit + k] - k)
    return np.bincount(doc, weights=value, minlength=len(sizes))


def scored(
    df: DataFrame, order: int = 2, alpha: float = 0.4, unseen: float = 0.5, key: str = "doc_id", text: str = "text",
    batch_bytes: int = 8 << 20, range_bytes: int = 16 << 20, least_ranges: int = 64,
) -> DataFrame:
    """One row per input row: ``key``, ``n_words``, ``log_score`` (natural logarithms, summed) and
    ``mean_log_score``."""
    total = df.agg(F.sum(F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)) + F.lit(_ROW_BYTES))).first()[0] or 0
    batches = batched(df, key, text, batch_bytes, min(_MOST_BUCKETS, max(1, -(-total // batch_bytes))))
    answers = counted(listed(batches, order, max(least_ranges, -(-total // range_bytes))))
    words = batches.agg(F.sum("n_words")).first()[0] or 0

    def sums(rows: pa.Table, answers: pa.Table) -> pa.Table:
        hashes, doc, sizes = _read(*(rows.column(name)[0] for name in ("words", "places", "sizes")))
        at = np.argsort(answers.column("range").to_numpy())
        parts = (_numbers(answers.column("low")[i], answers.column("high")[i]) for i in at.tolist())
        outside = np.concatenate([np.empty(0, np.int64), *parts])
        logs = score(hashes, doc, sizes, outside, order, words, alpha, unseen)
        ids = rows.column("ids").combine_chunks().flatten()
        return pa.table({"id": ids, "n_words": pa.array(sizes, pa.int64()), "log_score": pa.array(logs, pa.float64())})

    kind = df.schema[key].dataType.simpleString()
    out = batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        sums, f"id {kind}, n_words bigint, log_score double"
    )
    return out.select(
        F.col("id").alias(key), "n_words", "log_score", F.try_divide("log_score", F.col("n_words").cast("double")).alias("mean_log_score")
    )

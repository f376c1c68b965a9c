"""Packing by concatenate-and-cut: all documents' ids in one line, cut into fixed windows.

Pass one tokenizes every document once and writes its ids with the number of ids before it in its
partition. Pass two sums the partitions' totals in order: that gives every document its place in the
whole line, and each document cuts itself where windows end. Only the last window can be short.

Nulls: a null text is empty; an empty document is its end id alone. Repeated rows are packed each. An
empty table gives an empty result. A text of any length is encoded whole. Other columns of the input,
whatever their name, are not carried.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..session import written

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_CONTROL = re.compile(r"[\x1c-\x1f]")  # white space to str.split, signs to a tokenizer
_CLOSING = ".,!?;:#$%&*+-/=@^_~"  # no apostrophe and no bracket, which may belong to a contraction or an added token
_PROBES = ["Plain words, and CAPS!", " it's one of 3,141 things...\tlines\n\ntwo  blanks ", "na\u00efve \u00dcber-words a%% ##b x's", "a", " a", "A,"]


def _plain(word: str) -> bool:
    """Latin letters only, which stay one run of letters whatever the normaliser does."""
    return word.isalpha() and (word.isascii() or (max(word) < "\u0250" and "\u0130" not in word))


class WordEncoder:
    """Ids of whole texts for a tokenizer that never merges across white space.

    Words repeat, so each one is encoded once and remembered; ``limit`` bounds what is remembered
    (the memory is emptied when full). Closing punctuation after a letter or digit is a token of its
    own in such a tokenizer, so word and punctuation are remembered apart. Words of letters are encoded
    many at a time, as one text, which is cut behind the ids that end a word. A tokenizer that gives other ids for
    ``_PROBES`` by word than by text is of another kind, and encodes whole texts.
    """

    def __init__(self, path: str, limit: int = 1_600_000):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.limit = limit
        self.known: dict[str, bytes] = {}
        self.by_word = True
        self.by_word = self.encode(_PROBES) == [ids.tobytes() for ids in self._ids(_PROBES)]

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(code.ids, dtype="<u4") for code in found]

    def _learn(self, words: set[str]) -> None:
        known = self.known
        cut: list[tuple[str, str, str]] = []  # word, core and closing signs, where they differ from the word
        fresh: set[str] = set()
        for word in words:
            core, tail = word.lower() if word.isascii() else word, ""
            bare = core.rstrip(_CLOSING)
            if len(bare) < len(core) and bare and bare[-1].isascii() and bare[-1].isalnum():
                core, tail = bare, core[len(bare) :]
                fresh.add(tail)
            fresh.add(core)
            if tail or core != word:
                cut.append((word, core, tail))
        fresh = fresh.difference(known)  # walks the few new words, not all known ones
        letters = [w for w in fresh if w.isalpha() and (w.isascii() or _plain(w))]
        other = list(fresh.difference(letters))
        groups = [letters[i : i + 128] for i in range(0, len(letters), 128)]
        for group, ids in zip(groups, self._ids([" ".join(g) for g in groups])):
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(group) and (not len(ids) or cuts[-1] == len(ids)):
                raw, ends = ids.tobytes(), (cuts * 4).tolist()
                known.update(zip(group, [raw[a:b] for a, b in zip([0, *ends], ends)]))
            else:  # a tokenizer that marks word ends in another way
                other.extend(group)
        for word, ids in zip(other, self._ids(other)):
            known[word] = ids.tobytes()
        for word, core, tail in cut:
            known[word] = known[core] + known[tail] if tail else known[core]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if not self.by_word:
            return [ids.tobytes() for ids in self._ids([t or "" for t in texts])]
        split = [(_WORD.findall(t) if _CONTROL.search(t) else t.split()) if t else [] for t in texts]
        every: set[str] = set().union(*split)
        fresh = every.difference(self.known)
        if len(self.known) + 2 * len(fresh) > self.limit:
            self.known.clear()
            fresh = every
        if fresh:
            gc.disable()  # many small objects and no cycle among them
            try:
                self._learn(fresh)
            finally:
                gc.enable()
        code = self.known.__getitem__
        return [b"".join(map(code, words)) for words in split]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One per worker process; a later task finds the words of the earlier ones."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def tokenized(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 2) -> DataFrame:
    """Written table of (``key``, ids binary, n, _part, _before): each document's ids with ``end_id``,
    and the number of ids before it in its partition."""
    end = np.array([end_id], dtype="<u4").tobytes()
    kind = df.schema[key].dataType

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                ids = [code + end for code in own.encode(rows.column(1).to_pylist())]
                n = np.array([len(code) // 4 for code in ids], dtype=np.int64)
                start = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.record_batch(
                    [rows.column(0), pa.array(ids, pa.binary()), pa.array(n), pa.array(np.full(len(n), part, np.int64)), pa.array(start)],
                    names=["_key", "ids", "n", "_part", "_before"],
                )

    schema = f"_key {kind.simpleString()}, ids binary, n bigint, _part bigint, _before bigint"
    pair = df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    return written(pair.mapInArrow(encode, schema), "tokens").withColumnRenamed("_key", key)


def packed(
    df: DataFrame, tokenizer: str, length: int = 4096, key: str = "doc_id", text: str = "text", end_id: int = 2
) -> DataFrame:
    """One row per piece: ``key``, ``start`` (the document's ids before it), ``length``, ``ids``
    (binary, little-endian 32-bit), ``doc_tokens``, ``sequence_id``, ``offset`` (place in the sequence)."""
    tokens = tokenized(df, tokenizer, key, text, end_id)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = tokens.groupBy("_part").agg(F.sum("n").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    # One row of two longs for each task of pass one, so the broadcast has a bound.
    placed = tokens.join(F.broadcast(starts), "_part").withColumn("_at", F.col("_start") + F.col("_before"))

    def piece(sequence):
        first = F.greatest(sequence * length, F.col("_at"))
        size = F.least((sequence + 1) * length, F.col("_at") + F.col("n")) - first
        begin = first - F.col("_at")
        return F.struct(
            begin.alias("start"), size.alias("length"),
            F.col("ids").substr((begin * 4 + 1).cast("int"), (size * 4).cast("int")).alias("ids"),
            F.col("n").alias("doc_tokens"), sequence.alias("sequence_id"), (first - sequence * length).alias("offset"),
        )

    last = F.expr(f"(_at + n - 1) div {length}")
    return placed.select(key, F.inline(F.transform(F.sequence(F.expr(f"_at div {length}"), last), piece)))

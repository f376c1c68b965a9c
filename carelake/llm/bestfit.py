"""Best-two-fit packing: each bin is filled greedily and its smallest document then exchanged for two.

A bin takes the largest document that fits, again and again. If a gap stays and the bin holds several
documents, its smallest one is exchanged for the two unpacked documents whose sum is greatest among those that
fit the gap and the smallest's place together, provided they fill the bin more tightly. Documents of one
length are interchangeable, so the bins follow from the count of each length: as long as a bin's lengths last,
the next bin is the same, and the plan is a short list of patterns with their repetitions. Its size is bounded
by the bin's size and not by the number of documents.

Pass one tokenizes every document once and numbers it among the documents of its length and partition. The
counts per partition and length give every document its rank in its length, and the plan turns ranks into
places. Only documents longer than a bin are cut; their full pieces are bins of their own.

Nulls: a null text is empty, an empty document is its end id alone; null and repeated keys are packed each.
A text of any length is encoded whole. Documents of one length take places in the order of partitions. An
empty table gives an empty result. Other columns, whatever their name, are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..session import written


class ByteEncoder:
    """Ids of texts as the ``tokenizers`` library gives them.

    A byte-level vocabulary whose ids follow its merges is run by ``tiktoken``, which is several times
    faster and gives the same ids; any other tokenizer, and a text that spells one of the added tokens, is
    left to ``tokenizers``.
    """

    # Fixed value: the word pattern of byte-level tokenizers that use their own regular expression.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.added = [token["content"] for token in described.get("added_tokens", [])]
        self.size = self.tokenizer.get_vocab_size()
        ranks = self._ranks(described)
        self.fast = None
        if ranks is not None:
            import tiktoken

            self.fast = tiktoken.Encoding("bytes", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _ranks(described: dict) -> dict[bytes, int] | None:
        """Bytes of each token by rank, if the tokenizer is of the kind that ``tiktoken`` runs."""
        before, model = described.get("pre_tokenizer") or {}, described["model"]
        vocabulary = model.get("vocab")
        if (
            described.get("normalizer") is not None or before.get("type") != "ByteLevel" or before.get("add_prefix_space")
            or not before.get("use_regex", True) or model.get("type", "BPE") != "BPE" or model.get("dropout") or model.get("ignore_merges")
            or model.get("end_of_word_suffix") or model.get("continuing_subword_prefix") or model.get("byte_fallback")
        ):
            return None
        # Printable bytes stand for themselves in the file; the others are numbered from 256.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = [b for b in range(256) if b not in set(plain)]
        signs = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
        merges = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        followed = all(vocabulary.get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
        if not followed or len(vocabulary) - len(merges) < 256 or any(vocabulary.get(s, 256) > 255 for s in signs):
            return None
        return {bytes(signs[s] for s in token): i for token, i in vocabulary.items() if i < 256 + len(merges)}

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        out = [[] for _ in texts]
        slow = []
        for i, text in enumerate(texts):
            if not text:
                continue
            if self.fast is None or any(token in text for token in self.added):
                slow.append(i)
            else:
                out[i] = self.fast.encode_ordinary(text)
        if slow:
            for i, code in zip(slow, self.tokenizer.encode_batch_fast([texts[i] for i in slow], add_special_tokens=False)):
                out[i] = code.ids
        return out


_encoders: dict[str, ByteEncoder] = {}


def encoder(path: str) -> ByteEncoder:
    """One per worker process."""
    if path not in _encoders:
        _encoders[path] = ByteEncoder(path)
    return _encoders[path]


def tokenized(df: DataFrame, tokenizer: str, length: int, key: str, text: str, end_id: int) -> DataFrame:
    """Written table of (_key, _ids, _n, _len, _part, _rank, _full): the ids (two bytes each if the vocabulary
    allows), their number, the length of the first piece, the task, the documents of that length before it in
    the task, and the full pieces before it there."""
    kind = df.schema[key].dataType
    narrow = _narrow(tokenizer, end_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        part = TaskContext.get().partitionId()
        seen, full = np.zeros(length + 1, dtype=np.int64), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                codes = own.encode(rows.column(1).to_pylist())
                ids = [np.array([*code, end_id], dtype="<u2" if narrow else "<u4").tobytes() for code in codes]
                n = np.array([len(code) + 1 for code in codes], dtype=np.int64)
                first = (n - 1) % length + 1
                rank = np.empty(len(n), dtype=np.int64)
                for i, size in enumerate(first.tolist()):
                    rank[i] = seen[size]
                    seen[size] += 1
                pieces = (n - first) // length
                before = full + np.cumsum(pieces) - pieces
                full += int(pieces.sum())
                yield pa.record_batch(
                    [rows.column(0), pa.array(ids, pa.binary()), pa.array(n), pa.array(first.astype(np.int32)),
                     pa.array(np.full(len(n), part, np.int32)), pa.array(rank), pa.array(before)],
                    names=["_key", "_ids", "_n", "_len", "_part", "_rank", "_full"],
                )

    schema = f"_key {kind.simpleString()}, _ids binary, _n bigint, _len int, _part int, _rank bigint, _full bigint"
    pair = df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    return written(pair.mapInArrow(encode, schema), "tokens")


def _narrow(tokenizer: str, end_id: int) -> bool:
    return max(encoder(tokenizer).size, end_id + 1) <= 1 << 16


def _pair(left: np.ndarray, room: int, least: int) -> tuple[int, int] | None:
    """Two unpacked lengths of the greatest sum within ``room``, if it exceeds ``least``; of equal sums the
    one with the longest document."""
    at = np.arange(len(left))
    largest = np.maximum.accumulate(np.where(left > 0, at, 0))  # the largest unpacked length up to each
    small = np.flatnonzero(left[: room + 1] > 0)
    small = small[small > 0]
    partner = largest[room - small]
    alone = (partner == small) & (left[small] < 2)
    partner = np.where(alone, largest[np.maximum(small - 1, 0)], partner)
    total = np.where(partner > 0, small + partner, 0)
    if not len(total) or total.max() <= least:
        return None
    best = np.flatnonzero(total == total.max())
    long = np.maximum(small, partner)[best]
    pick = best[int(long.argmax())]
    return int(small[pick]), int(partner[pick])


def pattern(counts: np.ndarray, length: int) -> tuple[dict[int, int], int]:
    """The next bin, lengths with their numbers, and how often it comes before a length runs short."""
    greedy: dict[int, int] = {}
    gap = length
    while gap > 0:
        fits = np.flatnonzero(counts[: gap + 1] > 0)
        fits = fits[(fits > 0) & ~np.isin(fits, list(greedy))] if greedy else fits[fits > 0]
        if not len(fits):
            break
        size = int(fits[-1])
        greedy[size] = min(gap // size, int(counts[size]))
        gap -= size * greedy[size]
    final = dict(greedy)
    if gap > 0 and sum(greedy.values()) > 1:
        least = min(greedy)
        left = counts.copy()
        for size, n in greedy.items():
            left[size] -= n
        found = _pair(left, gap + least, least)
        if found:
            final[least] -= 1
            for size in found:
                final[size] = final.get(size, 0) + 1
    final = {size: n for size, n in final.items() if n}
    times = min((int(counts[size]) - max(n, greedy.get(size, 0))) // n + 1 for size, n in final.items())
    return final, times


def planned(counts: np.ndarray, length: int) -> np.ndarray:
    """Rows (length, first rank, first bin, documents of the length in a bin, their offset in it) in order of
    length and rank. ``counts[size]`` is the number of documents of each length."""
    counts = counts.astype(np.int64).copy()
    rank = np.zeros_like(counts)
    rows, bins = [], 0
    while counts[1:].any():
        final, times = pattern(counts, length)
        at = 0
        for size in sorted(final, reverse=True):
            rows.append((size, int(rank[size]), bins, final[size], at))
            at += size * final[size]
            rank[size] += times * final[size]
            counts[size] -= times * final[size]
        bins += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def placed(plan: np.ndarray, size: np.ndarray, rank: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of documents by their length and their rank in it."""
    starts = np.searchsorted(plan[:, 0], np.arange(length + 2))
    row = np.empty(len(size), dtype=np.int64)
    for one in np.unique(size):
        mine = size == one
        a, b = starts[one], starts[one + 1]
        row[mine] = a + np.searchsorted(plan[a:b, 1], rank[mine], side="right") - 1
    _, first, bins, uses, offset = plan[row].T
    turn = rank - first
    return bins + turn // uses, offset + turn % uses * size


def packed(
    df: DataFrame, tokenizer: str, length: int = 2048, key: str = "doc_id", text: str = "text", end_id: int = 0
) -> DataFrame:
    """One row per piece: ``key``, ``piece`` (from 0), ``start`` (the document's ids before it), ``length``, ``ids``
    (binary, little-endian 32-bit), ``sequence_id`` (negative for full pieces), ``offset`` in the sequence."""
    kind = df.schema[key].dataType.simpleString()
    narrow = _narrow(tokenizer, end_id)
    tokens = tokenized(df, tokenizer, length, key, text, end_id)
    # One row per task and length at most.
    counts = written(tokens.groupBy("_part", "_len").agg(F.count(F.lit(1)).alias("_c")), "lengths")
    have = np.zeros(length + 1, dtype=np.int64)
    for size, n in counts.groupBy("_len").agg(F.sum("_c")).collect():  # a row per length, ``length`` at most
        have[size] = n
    plan = planned(have, length)
    before = Window.partitionBy("_len").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("_part", "_len", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_first"))
    # A row of ``firsts`` is no larger than a document and as a rule stands for many.
    ranked = tokens.join(firsts.hint("shuffle_hash"), ["_part", "_len"]).withColumn("_rank", F.col("_rank") + F.col("_first"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                yield _cut(batch.slice(at, 1024), plan, length, narrow)

    columns = ("_key", "_ids", "_n", "_len", "_part", "_rank", "_full")
    schema = f"_key {kind}, piece int, start bigint, length bigint, ids binary, sequence_id bigint, offset bigint"
    return ranked.select(*columns).mapInArrow(cut, schema).withColumnRenamed("_key", key)


def _cut(rows: pa.RecordBatch, plan: np.ndarray, length: int, narrow: bool) -> pa.RecordBatch:
    """The pieces of documents: the first where the plan puts it, full ones in sequences of their own."""
    n, first, part, rank, full = (rows.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2, 7))
    bins, offset = placed(plan, first, rank, length)
    pieces = (n - first) // length + 1
    row = np.repeat(np.arange(len(n)), pieces)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    head = piece == 0
    start = np.where(head, 0, first[row] + (piece - 1) * length)
    size = np.where(head, first[row], length)
    own = -1 - ((part[row] << 40) + full[row] + piece - 1)
    codes = rows.column(1).to_pylist()
    ids = []
    for r, a, b in zip(row.tolist(), start.tolist(), (start + size).tolist()):
        if narrow:
            ids.append(np.frombuffer(codes[r], dtype="<u2")[a:b].astype("<u4").tobytes())
        else:
            ids.append(codes[r][4 * a : 4 * b])
    return pa.record_batch(
        [rows.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(size), pa.array(ids, pa.binary()),
         pa.array(np.where(head, bins[row], own)), pa.array(np.where(head, offset[row], 0))],
        names=["_key", "piece", "start", "length", "ids", "sequence_id", "offset"],
    )

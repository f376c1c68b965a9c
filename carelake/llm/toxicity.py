"""Toxicity by gradient-boosted trees over a few dense features, with isotonic calibration.

The lexicon is learned from labelled documents: words and word beginnings (4 to 6 letters) that toxic
documents hold far more often than others. The features are densities of lexicon hits (plain, by
word beginning, only after undoing disguises), hits next to a second person, and rates of capitals,
punctuation, disguised and stretched words. Trees are fitted on rows whose features come from a lexicon
learned without their half of the sample; the scores of rows kept apart calibrate the trees.

Nulls: a null text counts as empty, and an empty text has only zeros as features but gets a score like
any other. Unlabelled or null labels teach nothing; with one label or none the score is that label's
rate (0 without labels). Ties and repeated rows get equal scores; an empty table gives an empty
result. Input columns named like a result column are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from ..session import written

# Second-person words of the four languages, and signs that stand for letters.
SECOND_PERSON = frozenset(
    "you your yours u ur yourself du dich dir dein deine deinen ihr euch tu te toi ton ta tes vous votre vos "
    "ti tus usted ustedes vosotros vuestro vuestra".split()
)
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i"})

_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_NOT_LETTER = re.compile(r"[\W\d_]+")
_STRETCH = re.compile(r"([^\W\d_])\1\1")
_PREFIXES = (6, 5, 4)
_NEAR = 4
FEATURES = (
    "word_density", "word_weight", "word_hits", "word_kinds", "greatest_weight", "prefix_density", "prefix_hits",
    "disguised_density", "second_person_near", "second_person_rate", "capitals", "capital_words", "punctuation",
    "exclamations", "questions", "digits", "disguises", "stretched", "length",
)
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[c for c in range(128) if chr(c).isupper()]] = 1
_CLASS[[c for c in range(128) if chr(c).islower()]] = 2
_CLASS[[c for c in range(128) if chr(c).isdigit()]] = 3
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()]] = 4
_CLASS[ord("!")], _CLASS[ord("?")] = 5, 6


def terms(token: str) -> list[str]:
    """The word of a token and its beginnings, marked by a star."""
    word = _EDGE.sub("", token.lower())
    return [word, *[f"{word[:n]}*" for n in _PREFIXES if len(word) > n]] if len(word) > 2 else []


class Scanner:
    """Features of a text under a lexicon. What a token holds is remembered, up to a bound."""

    def __init__(self, lexicon: dict[str, float], limit: int = 500_000):
        self.lexicon, self.limit = lexicon, limit
        self.seen: dict[str, tuple | None] = {}

    def _look(self, token: str) -> tuple | None:
        """(kind, weight, word, second person, all capitals, disguised, stretched), or None if nothing holds."""
        word, kind, weight = _EDGE.sub("", token.lower()), 0, 0.0
        found = self.lexicon.get(word, 0.0) if len(word) > 2 else 0.0
        if found:
            kind, weight = 1, found
        elif len(word) > 4:
            begin = max((self.lexicon.get(f"{word[:n]}*", 0.0) for n in _PREFIXES if len(word) > n), default=0.0)
            if begin:
                kind, weight = 2, begin
        plain = word.isalpha()
        disguised = not plain and any(c.isalpha() for c in word)
        if disguised and not kind:
            bare = _NOT_LETTER.sub("", token.lower().translate(DISGUISE))
            found = self.lexicon.get(bare, 0.0) if len(bare) > 2 else 0.0
            if found:
                kind, weight = 3, found
        second = word in SECOND_PERSON
        capital = len(word) > 1 and token.isupper()
        stretched = bool(_STRETCH.search(word))
        return (kind, weight, word, second, capital, disguised, stretched) if kind or second or capital or disguised or stretched else None

    def features(self, text: str | None) -> list[float]:
        text = text or ""
        tokens = _TOKEN.findall(text)
        seen = self.seen
        if len(seen) > self.limit:
            seen.clear()
        for t in {t for t in tokens if t not in seen}:
            seen[t] = self._look(t)
        marked = [(i, m) for i, t in enumerate(tokens) if (m := seen[t]) is not None]
        n = max(len(tokens), 1)
        hits = [(i, m) for i, m in marked if m[0]]
        words = [m for _, m in hits if m[0] == 1]
        second = np.array([i for i, m in marked if m[3]])
        near = 0
        if len(second) and hits:
            at = np.array([i for i, _ in hits])
            right = np.searchsorted(second, at)
            gap = np.minimum(
                np.abs(second[np.minimum(right, len(second) - 1)] - at), np.abs(second[np.maximum(right - 1, 0)] - at)
            )
            near = int((gap <= _NEAR).sum())
        raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
        signs = np.bincount(_CLASS[raw], minlength=7)
        letters, size = max(int(signs[1] + signs[2]), 1), max(len(raw), 1)
        return [
            len(words) / n, sum(m[1] for m in words) / n, math.log1p(len(words)), math.log1p(len({m[2] for m in words})),
            max((m[1] for _, m in hits), default=0.0),
            sum(m[0] == 2 for _, m in hits) / n, math.log1p(sum(m[0] == 2 for _, m in hits)),
            sum(m[0] == 3 for _, m in hits) / n, near / n, len(second) / n,
            signs[1] / letters, sum(m[4] for _, m in marked) / n, (signs[4] + signs[5] + signs[6]) / size,
            signs[5] / size, signs[6] / size, signs[3] / size, sum(m[5] for _, m in marked) / n,
            sum(m[6] for _, m in marked) / n, math.log1p(len(tokens)),
        ]


def lexicon(sample: DataFrame, support: int = 4, odds: float = 2.0, most: int = 20_000) -> list[dict[str, float]]:
    """For each half of the sample, and for all of it: terms with their log-odds.

    ``sample``: _text, _toxic, _half. A term must be in ``support`` toxic documents of different text
    and have at least ``odds``; the ``most`` best terms of a lexicon are kept.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        for batch in batches:
            for text, toxic, half in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                found = {t for token in set(_TOKEN.findall(text or "")) for t in terms(token)}
                sums.update((t, half, toxic) for t in found)
            if len(sums) > 2_000_000:
                yield _rows(sums)
                sums = Counter()
        yield _rows(sums)

    def _rows(sums: Counter) -> pa.RecordBatch:
        keys = list(sums)
        columns = [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32()))]
        return pa.record_batch([*columns, pa.array([sums[k] for k in keys], pa.int64())], names=["term", "half", "toxic", "n"])

    distinct = sample.dropDuplicates(["_digest"]).select("_text", "_toxic", "_half")
    totals = {(r[0], r[1]): r[2] for r in distinct.groupBy("_half", "_toxic").count().collect()}
    pick = lambda half, toxic: F.sum(F.when((F.col("half") == half) & (F.col("toxic") == toxic), F.col("n")).otherwise(0))
    counts = distinct.mapInArrow(count, "term string, half int, toxic int, n bigint").groupBy("term").agg(
        pick(0, 1).alias("a0"), pick(1, 1).alias("a1"), pick(0, 0).alias("b0"), pick(1, 0).alias("b1")
    )
    counts = written(counts.filter(F.col("a0") + F.col("a1") >= support), "terms")
    out = []
    for halves in ((1,), (0,), (0, 1)):  # the first is for rows of half 0
        bad = sum((F.col(f"a{h}") for h in halves), F.lit(0))
        good = sum((F.col(f"b{h}") for h in halves), F.lit(0))
        many, few = (sum(totals.get((h, t), 0) for h in halves) for t in (1, 0))
        weight = F.log((bad + 0.5) / (many + 1)) - F.log((good + 0.5) / (few + 1))
        need = support if len(halves) == 2 else max(2, support // 2)
        best = counts.filter(bad >= need).select("term", weight.alias("w")).filter(F.col("w") >= odds)
        out.append({r[0]: r[1] for r in best.orderBy(F.desc("w"), "term").limit(most).collect()})
    return out


def _features(scanners: list[Scanner]):
    @F.arrow_udf("array<double>")
    def scan(texts: pa.Array, which: pa.Array) -> pa.Array:
        rows = (scanners[w].features(t.as_py()) for t, w in zip(texts, which.to_pylist()))
        return pa.array([*rows], pa.list_(pa.float64()))

    return scan


class ToxicityModel:
    """Lexicon, trees and calibration; or a constant rate where there was nothing to tell apart."""

    def __init__(self, words: dict[str, float], trees, calibration, rate: float):
        self.words, self.trees, self.calibration, self.rate = words, trees, calibration, rate


def _raw(trees, rows: DataFrame) -> DataFrame:
    return trees.transform(rows).withColumn("_raw", vector_to_array("rawPrediction")[1])


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    sample_rows: int = 12_000, rounds: int = 20, depth: int = 3,
) -> ToxicityModel:
    """Trains on at most about ``sample_rows`` labelled documents, picked by a hash of the key."""
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), (F.col(label) != 0).cast("int").alias("_toxic")
    )
    n = known.count()
    drawn = known.filter(F.pmod(F.xxhash64(F.lit(21), "_key"), F.lit(1_000_000)) < F.lit(int(1e6 * min(1.0, sample_rows / max(n, 1))) + 1))
    # The sample has a bounded number of short rows, so it goes to the documents.
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    sample = written(
        texts.join(F.broadcast(drawn.groupBy("_key").agg(F.max("_toxic").alias("_toxic"))), "_key")
        .withColumn("_digest", F.xxhash64("_text"))
        .withColumn("_half", F.pmod(F.col("_digest"), F.lit(2)).cast("int"))
        .withColumn("_apart", F.pmod(F.shiftright("_digest", 8), F.lit(5)) == 0),
        "toxicity-sample",
    )
    rows, toxic = sample.agg(F.count(F.lit(1)), F.sum("_toxic")).first()
    if not rows or not toxic or toxic == rows:
        return ToxicityModel({}, None, None, float((toxic or 0) / rows) if rows else 0.0)
    by_half = lexicon(sample)
    scan = _features([Scanner(by_half[0]), Scanner(by_half[1])])
    scanned = written(sample.select("_toxic", "_apart", scan("_text", "_half").alias("_f")), "toxicity-features")
    scanned = scanned.select(F.col("_toxic").cast("double").alias("label"), "_apart", array_to_vector("_f").alias("features"))
    fitted, apart = scanned.filter(~F.col("_apart")), scanned.filter("_apart")
    if fitted.select("label").distinct().count() < 2 or apart.select("label").distinct().count() < 2:
        fitted = apart = scanned
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.2, seed=5, minInstancesPerNode=5).fit(fitted.coalesce(4))
    calibration = IsotonicRegression(featuresCol="_raw", predictionCol="_score").fit(_raw(trees, apart.coalesce(4)).select("label", "_raw"))
    return ToxicityModel(by_half[2], trees, calibration, toxic / rows)


def scored(model: ToxicityModel, df: DataFrame, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``df`` with ``score`` (double, 0 to 1) and ``predicted`` (int, 1 from ``threshold`` on)."""
    kept = [c for c in df.columns if c.lower() not in ("score", "predicted")]
    if model.trees is None:
        out = df.select(*kept, F.lit(model.rate).alias("score"))
    else:
        scan = _features([Scanner(model.words)])
        rows = df.select(*kept, array_to_vector(scan(F.col(text), F.lit(0))).alias("features"))
        out = model.calibration.transform(_raw(model.trees, rows)).select(*kept, F.col("_score").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

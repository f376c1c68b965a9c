"""Language identification by error-correcting output codes.

Every language gets a codeword. For each bit a binary classifier over hashed letter trigrams (log-odds
of the languages with the bit set against the others) gives a margin; loss-weighted decoding sums, per
language, the logistic loss of its bits, each weighted by how often that bit's classifier was right
for that language, and takes the language of least loss. A narrow lead is flagged as ambiguous.

Nulls: a null text, or one without a letter, is ``und`` with score 0. Rows with a null language teach
nothing; with nothing to learn from, every text is ``und``. Ties go to the first language in code
point order. Repeated rows get equal answers; an empty table gives an empty result. Input columns
named like a result column are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import written

FEATURES = 1 << 14
_LETTER = re.compile(r"[^\W\d_]")
_FOLD = bytes(c if chr(c).isalpha() and c < 128 or c >= 128 else 32 for c in range(256))
_CHUNK = 1 << 20


def trigrams(text: str) -> Iterator[np.ndarray]:
    """Hashed trigrams of the bytes of the lower-case words, in chunks. Words are set off by one space."""
    folded = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_FOLD).split()) + b" "
    for at in range(0, len(folded) - 2, _CHUNK):
        a = np.frombuffer(folded[at : at + _CHUNK + 2], dtype=np.uint8).astype(np.uint32)
        code = (a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:]
        yield (code * np.uint32(2654435761)) >> np.uint32(18)


def codewords(languages: int) -> np.ndarray:
    """A row of +1 and -1 per language. Up to five languages get every way to split them; more get the
    one of 200 seeded random codes of ``10 log2 n`` bits whose closest rows are farthest apart."""
    if languages < 2:
        return np.ones((languages, 1), dtype=np.int8)
    if languages <= 5:
        columns = range(1, 1 << (languages - 1))
        return np.array([[1 if k == 0 or not c >> (k - 1) & 1 else -1 for c in columns] for k in range(languages)], dtype=np.int8)
    bits = math.ceil(10 * math.log2(languages))
    rng = np.random.default_rng(7)
    best, apart = None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), (languages, bits))
        gap = (bits - code.astype(int) @ code.T + bits * 2 * np.eye(languages, dtype=int)).min()
        if gap > apart and (abs(code.sum(0)) < languages).all():
            best, apart = code, gap
    return best


class LanguageModel:
    """Languages, codewords, trigram weights per bit and the weight of each bit for each language."""

    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray, trust: np.ndarray):
        self.languages, self.code, self.weights, self.trust = languages, code, weights, trust

    def margins(self, text: str) -> np.ndarray:
        """Per bit: the summed log-odds over the square root of the number of trigrams, so that a long
        text is surer than a short one."""
        total, n = np.zeros(self.code.shape[1]), 0
        for ids in trigrams(text):
            total += self.weights[ids].sum(axis=0, dtype=np.float64)
            n += len(ids)
        return total / math.sqrt(max(n, 1))

    def shares(self, text: str) -> np.ndarray:
        """Shares of belief per language, from the summed weighted losses."""
        loss = np.logaddexp(0.0, -self.code * self.margins(text))
        total = (self.trust * loss).sum(axis=1) * self.code.shape[1]
        share = np.exp(total.min() - total)
        return share / share.sum()


def _sample(df: DataFrame, lang: str, text: str, key: str, per_language: int) -> DataFrame:
    """At most about ``per_language`` rows of each language, picked by a hash of the key."""
    known = df.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(lang).count().collect()}  # one row per language
    if not counts:
        return known.select(F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    shares = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_language / n))])
    drawn = F.pmod(F.xxhash64(F.lit(20), F.col(key)), F.lit(1_000_000)) / 1e6 < F.element_at(shares, F.col(lang))
    return known.filter(drawn).select(F.col(lang).alias("_lang"), F.col(text).alias("_text"))


def fit(df: DataFrame, lang: str = "lang", text: str = "text", key: str = "doc_id", per_language: int = 2000) -> LanguageModel:
    """Trains on at most about ``per_language`` documents of each language. The driver gets the
    trigram counts (languages times ``FEATURES`` numbers) and the hit rates (languages times bits)."""
    sample = written(_sample(df, lang, text, key, per_language), "language-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, text_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = sums.setdefault(name, np.zeros(FEATURES, dtype=np.int64))
                for ids in trigrams(text_):
                    own += np.bincount(ids, minlength=FEATURES)
        for name, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.record_batch([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(own[at])], names=["_lang", "f", "n"])

    counted = sample.mapInArrow(count, "_lang string, f bigint, n bigint").groupBy("_lang", "f").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(set(counted["_lang"]))
    code = codewords(len(languages))
    table = np.zeros((len(languages), FEATURES))
    table[counted["_lang"].map({k: i for i, k in enumerate(languages)}).to_numpy(dtype=int), counted["f"].to_numpy(dtype=int)] = counted["n"]
    chance = (table + 0.5) / (table.sum(axis=1, keepdims=True) + 0.5 * FEATURES)
    weights = np.zeros((FEATURES, code.shape[1]), dtype=np.float32)
    for bit in range(code.shape[1]):
        yes, no = code[:, bit] > 0, code[:, bit] < 0
        if yes.any() and no.any():
            weights[:, bit] = np.log(chance[yes].mean(axis=0)) - np.log(chance[no].mean(axis=0))
    model = LanguageModel(languages, code, weights, np.full(code.shape, 1 / code.shape[1]))
    if len(languages) < 2:
        return model

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {k: i for i, k in enumerate(languages)}
        right, seen = np.zeros(code.shape, dtype=np.int64), np.zeros(len(languages), dtype=np.int64)
        for batch in batches:
            for name, text_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                i = place[name]
                right[i] += model.margins(text_) * code[i] > 0
                seen[i] += 1
        i, bit = np.indices(code.shape)
        yield pa.record_batch(
            [pa.array(i.ravel()), pa.array(bit.ravel()), pa.array(right.ravel()), pa.array(np.repeat(seen, code.shape[1]))],
            names=["l", "b", "hit", "seen"],
        )

    rates = sample.mapInArrow(hits, "l bigint, b bigint, hit bigint, seen bigint").groupBy("l", "b").agg(F.sum("hit").alias("hit"), F.sum("seen").alias("seen")).toPandas()
    trust = np.zeros(code.shape)
    trust[rates["l"], rates["b"]] = (rates["hit"] + 0.5) / (rates["seen"] + 1)
    model.trust = trust / trust.sum(axis=1, keepdims=True)
    return model


def identified(model: LanguageModel, text: Column, lead: float = 0.1) -> Column:
    """Struct of ``lang_pred``, ``score`` (share of belief, 0 to 1) and ``ambiguous`` (the lead over
    the second language is below ``lead``)."""

    @F.arrow_udf("lang_pred string, score double, ambiguous boolean")
    def decode(texts: pa.Array) -> pa.Array:
        names, scores, doubts = [], [], []
        for value in texts:
            t = value.as_py()
            if t is None or not model.languages or not _LETTER.search(t):
                names.append("und"), scores.append(0.0), doubts.append(False)
                continue
            share = model.shares(t)
            order = np.argsort(-share, kind="stable")
            second = share[order[1]] if len(order) > 1 else 0.0
            names.append(model.languages[order[0]]), scores.append(float(share[order[0]]))
            doubts.append(bool(share[order[0]] - second < lead))
        columns = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(doubts, pa.bool_())]
        return pa.StructArray.from_arrays(columns, names=["lang_pred", "score", "ambiguous"])

    return decode(text)


def with_language(df: DataFrame, model: LanguageModel, text: str = "text", lead: float = 0.1) -> DataFrame:
    kept = [c for c in df.columns if c.lower() not in ("lang_pred", "score", "ambiguous")]
    return df.withColumn("_found", identified(model, F.col(text), lead)).select(*kept, "_found.*")


def held_out(key: str) -> Column:
    """Rows kept from learning: CRC-32 of the key as text leaves 2 when divided by 4. A null key is not."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(4)) == 2, F.lit(False))

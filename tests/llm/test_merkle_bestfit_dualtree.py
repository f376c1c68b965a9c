import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from carelake.llm import bestfit, dualtree, merkle
from .conftest import words

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- Merkle manifest ----------------------------------------------------------------------------------


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def steps_of(levels, i):
    steps = []
    for level in levels[:-1]:
        left = level[i - 1] if i % 2 else ""
        right = level[i + 1] if i % 2 == 0 and i + 1 < len(level) else ""
        steps.append((left, right))
        i //= 2
    return steps


def brute_proofs(rows):
    """(group, key, leaf) to the rows of a manifest."""
    groups = {}
    for g, key, leaf in rows:
        groups.setdefault(g, []).append((key is not None, key or 0, leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels_of([leaf for *_, leaf in sorted(groups[g])]) for g in order}
    whole = levels_of([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, (has, key, leaf) in enumerate(sorted(groups[g])):
            path = steps_of(trees[g], i) + steps_of(whole, k)
            out.append((key if has else None, leaf, trees[g][-1][0], whole[-1][0], tuple(path)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits,digits", [(1, 1), (2, 2), (4, 3)])
def test_manifest_equals_brute_force(spark, monkeypatch, bits, digits):
    """Blocks of 2 and 16 leaves make several storeys of the groups and of the tree over them."""
    monkeypatch.setattr(merkle, "BITS", bits)
    monkeypatch.setattr(merkle, "BASE", 1 << bits)
    monkeypatch.setattr(merkle, "DIGITS", digits)
    monkeypatch.setattr(merkle, "BLOCK", 1 << bits * digits)
    rows = [("big", i * 3 % 71, sha(f"b{i}")) for i in range(21 if bits == 1 else 71)] + [("é", 1, sha("x")), ("z", 9, sha("y")), (None, 4, sha("n"))]
    rows += [("pair", 5, sha("p")), ("pair", 5, sha("q")), ("pair", None, sha("r")), ("pair", 5, sha("p"))]
    df = spark.createDataFrame(rows, "g string, k long, leaf string")
    got = merkle.proofs(df, "leaf", "k", "g").collect()
    mine = sorted(((r.k, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.path)) for r in got), key=str)
    assert mine == brute_proofs(rows)


def test_manifest_of_documents_tells_tampering(docs):
    """Nulls, empty and long texts, a repeated row, further columns of clashing names."""
    clash = docs.withColumn("path", F.lit(1)).withColumn("root", F.lit("r")).withColumn("_hash", F.lit(0)).withColumn("_g", F.lit("g"))
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    leaf = merkle.entry_hash([F.col(c) for c in columns])
    leaves = clash.select("doc_id", "lang", leaf.alias("leaf"))
    rows = merkle.proofs(leaves, "leaf", "doc_id", "lang").withColumn("again", merkle.folded(F.col("leaf"), F.col("path")))
    rows = rows.withColumn("other", merkle.folded(F.sha2("leaf", 256), F.col("path"))).withColumn("digest", merkle.proof_digest(F.col("path"))).collect()
    assert len(rows) == docs.count()
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    given = [(r.lang, r.doc_id, sha("".join(part(r[c]) for c in columns))) for r in docs.collect()]
    expected = {e[:4] + (sha("".join(a + b for a, b in e[4])),) for e in brute_proofs(given)}
    assert {(r.doc_id, r.leaf, r.subroot, r.root, r.digest) for r in rows} == expected
    assert all(r.again == r.root and r.other != r.root for r in rows)


def test_manifest_of_nothing_and_of_one_row(spark, empty):
    assert merkle.proofs(empty.select("doc_id", "lang", "text"), "text", "doc_id", "lang").count() == 0
    one = spark.createDataFrame([(None, None, sha("a"))], "k long, g string, leaf string")
    r = merkle.proofs(one, "leaf", "k", "g").first()
    assert (r.subroot, r.root, r.path) == (sha("a"), sha("a"), [])


def test_manifest_carries_copies_of_one_row(spark):
    many = spark.range(5000).select(F.lit(7).cast("bigint").alias("k"), F.lit("en").alias("g"), F.lit(sha("same")).alias("leaf"))
    rows = merkle.proofs(many, "leaf", "k", "g").select(merkle.folded(F.col("leaf"), F.col("path")).alias("r"), "root", "path")
    assert rows.filter("r = root").count() == 5000 and rows.select(F.size("path")).distinct().collect() == [(13,)]


# -- best-two-fit ----------------------------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_ids_equal_the_tokenizer(texts):
    own, tokenizer = bestfit.encoder(BYTES), Tokenizer.from_file(BYTES)
    assert own.fast is not None
    assert own.encode(texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_ids_of_added_tokens_and_other_tokenizers():
    texts = ["a <|endoftext|> b", "", None, "x" * 5000 + " \t\r\n\x1c\x85　 é \U0001f600'LL don't"]
    for path in (BYTES, WORDS):
        tokenizer = Tokenizer.from_file(path)
        assert bestfit.encoder(path).encode(texts) == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert bestfit.encoder(WORDS).fast is None


def one_by_one(sizes, length):
    """The method a bin at a time on a multiset of documents."""
    left, bins = Counter(sizes), []
    while +left:
        bin_, gap = [], length
        while fits := [s for s in left if left[s] and s <= gap]:
            bin_.append(max(fits))
            left[max(fits)] -= 1
            gap -= max(fits)
        if gap and len(bin_) > 1:
            least = min(bin_)
            room = gap + least
            pairs = [(a + b, a, b) for a in left for b in left if left[a] and left[b] and a >= b and a + b <= room and (a != b or left[a] > 1)]
            if pairs and max(pairs)[0] > least:
                _, a, b = max(pairs)
                bin_.remove(least)
                left[least] += 1
                left[a] -= 1
                left[b] -= 1
                bin_ += [a, b]
        bins.append(tuple(sorted(bin_)))
    return Counter(bins)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=120), st.integers(60, 64))
def test_plan_equals_one_bin_at_a_time(sizes, length):
    plan = bestfit.planned(np.bincount(sizes, minlength=length + 1), length)
    seen, size, rank = Counter(), np.array(sizes), np.zeros(len(sizes), dtype=np.int64)
    for i, s in enumerate(sizes):
        rank[i] = seen[s]
        seen[s] += 1
    bins, offset = bestfit.placed(plan, size, rank, length)
    filled = {}
    for b, o, s in sorted(zip(bins.tolist(), offset.tolist(), sizes)):
        assert o == sum(filled.setdefault(b, []))
        filled[b].append(s)
    assert all(sum(b) <= length for b in filled.values())
    assert Counter(tuple(sorted(b)) for b in filled.values()) == one_by_one(sizes, length)


def test_exchange_packs_more_tightly():
    """60 + 30 leaves 10; 30 goes for 22 + 18, and 60 + 22 + 18 is full."""
    final, times = bestfit.pattern(np.bincount([60, 30, 22, 18], minlength=101), 100)
    assert (final, times) == ({60: 1, 22: 1, 18: 1}, 1)


def round_trip(df, pieces, path, length, end_id):
    tokenizer = Tokenizer.from_file(path)
    want = Counter((r.doc_id, tuple(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [end_id])) for r in df.collect())
    rows = pieces.collect()
    spans = {}
    for r in rows:
        assert len(r.ids) == 4 * r.length and 0 < r.length <= length
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in spans.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= length
    return want, rows, spans


def test_packing_round_trip(spark, docs):
    more = spark.createDataFrame([(100 + i, words(i, 3 + i * 7 % 90)) for i in range(120)], "doc_id long, text string")
    long = spark.createDataFrame([(900, words(5, 120_000)), (901, "y" * 300_000)], "doc_id long, text string")
    every = docs.dropDuplicates(["doc_id"]).select("doc_id", "text").unionByName(more).unionByName(long).repartition(5)
    clash = every.withColumn("piece", F.lit(1)).withColumn("ids", F.lit("x")).withColumn("_ids", F.lit(0))
    want, rows, spans = round_trip(every, bestfit.packed(clash, BYTES, length=256), BYTES, 256, 0)
    whole = {}
    for r in sorted(rows, key=lambda r: (r.doc_id or -1, r.piece)):
        got = whole.setdefault(r.doc_id, [])
        assert r.start == len(got) and (r.piece == 0 or r.length == 256)
        got.extend(np.frombuffer(r.ids, dtype="<u4").tolist())
    assert Counter((k, tuple(v)) for k, v in whole.items()) == want
    total = sum(len(ids) for _, ids in want)
    assert len(spans) <= math.ceil(total / 256) + 1


def test_packing_of_repeated_rows_and_nothing(docs, empty, spark):
    assert bestfit.packed(empty, BYTES).count() == 0
    rows = bestfit.packed(docs.filter("doc_id = 8"), BYTES).collect()
    assert len(rows) == 2 and len({r.offset for r in rows}) == 2
    same = spark.range(3000).selectExpr("id % 3 AS doc_id", "'one two three' AS text")
    spots = bestfit.packed(same, BYTES, length=64).select("sequence_id", "offset").distinct().count()
    assert spots == 3000


# -- dual-tree search ------------------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def brute_ranked(docs, items, k):
    split = lambda t: TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    held = [(i, split(t)) for i, t in docs]
    n, total = sum(bool(w) for _, w in held), sum(len(w) for _, w in held)
    df = Counter(t for _, w in held for t in set(w))
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(split(t))
    out = []
    for i, terms in asked.items():
        scores = []
        for d, w in held:
            tf, m = Counter(w), 100 - 90 + (90 * len(w) * n) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in terms if tf[t])
            if s > 0:
                scores.append((-s, d is not None, d or 0))
        out += [(i, r + 1, d if has else None, -s) for r, (s, has, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def ranked_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"pairs": 40, "cells": 600}, {"most_items": 3, "cells": 100_000}])
def test_ranked_equals_brute_force(spark, options):
    """Several batches of items, blocks down to a leaf, copies that tie, item ids that repeat."""
    rng = random.Random(4)
    vocabulary = words(1, 150).split()
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(400)]
    docs += [(1000 + i, docs[i % 7][1]) for i in range(40)] + [(5, "ÀÉ x-Y_z 3D é"), (None, None), (None, docs[0][1])]
    items = [(i, " ".join(rng.sample(vocabulary, rng.randint(1, 12)))) for i in range(25)] + [(3, "extra xyz"), (90, ""), (91, None), (None, "ÀÉ X y 3d é")]
    left = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("rank", F.lit(1)).withColumn("_n", F.lit(2))
    right = spark.createDataFrame(items, "item_id int, text string").withColumn("score", F.lit(1))
    assert ranked_rows(dualtree.ranked(left, right, k=5, **options)) == brute_ranked(docs, items, 5)


def test_search_drops_node_pairs():
    """Documents of another vocabulary than the items are never scored."""
    rng = np.random.default_rng(1)
    weights = np.zeros((64, 200))
    coords = np.zeros((2048, 200))
    for i in range(64):
        weights[i, (i % 8) * 10 : (i % 8) * 10 + 5] = rng.integers(1, 9, 5)
    for i in range(2048):
        coords[i, 100 + i % 90] = 7
    coords[::64, :80] = rng.integers(0, 9, (32, 80))
    own = dualtree.Search(weights, 10)
    own.block(coords, np.arange(2048))
    full = weights @ coords.T
    for row, item in enumerate(own.items.order):
        best = sorted(((-s, d) for d, s in enumerate(full[item]) if s > 0))[:10]
        assert [(s, d) for s, d in zip(-own.score[row], own.doc[row]) if s] == best
    assert own.compared < full.size / 10


def test_ranked_of_nothing(spark, empty, docs):
    items = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert dualtree.ranked(empty, items).count() == 0
    assert dualtree.ranked(docs, items.limit(0)).count() == 0
    assert [r.doc_id for r in dualtree.ranked(docs, items).collect()] == [1, 2]


def test_long_text_is_ranked_whole(spark):
    docs = spark.createDataFrame([(1, words(3, 200_000) + " needle"), (2, "needle"), (3, "hay")], "doc_id long, text string")
    items = spark.createDataFrame([("q", "NEEDLE")], "item_id string, text string")
    assert [(r.rank, r.doc_id) for r in dualtree.ranked(docs, items).collect()] == [(1, 2), (2, 1)]


def test_sizes_beyond_doubles_use_integers():
    import pyarrow as pa

    table = pa.table({"_item": pa.array([1, 1]), "_term": pa.array([b"a", b"b"], pa.binary())})
    _, weights = dualtree._weights(table, {b"a": 0, b"b": 1}, {0: 3}, 10)
    assert weights.dtype == np.float64
    big = dualtree._EXACT
    try:
        dualtree._EXACT = 1000
        _, weights = dualtree._weights(table, {b"a": 0, b"b": 1}, {0: 3}, 10)
    finally:
        dualtree._EXACT = big
    assert weights.dtype == np.int64


def test_crc_of_ids_is_the_unsigned_one(spark):
    value = spark.createDataFrame([(bytes([1, 0, 0, 0]),)], "ids binary").select(F.crc32("ids")).first()[0]
    assert value == zlib.crc32(bytes([1, 0, 0, 0]))

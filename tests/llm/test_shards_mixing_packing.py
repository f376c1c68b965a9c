import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from carelake.llm import mixing, packing, shards
from .conftest import words

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_shards_are_even_and_gapless(docs):
    rows = shards.sharded(docs, 3).collect()
    assert len(rows) == docs.count()
    per = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(3)}
    assert all(slots == list(range(len(slots))) for slots in per.values())
    assert max(map(len, per.values())) - min(map(len, per.values())) <= 1
    assert sorted(str(r.text) for r in rows) == sorted(str(r.text) for r in docs.collect())


def test_shards_repeat_and_follow_the_seed(spark):
    many = spark.range(500).selectExpr("id AS doc_id", "CAST(id % 3 AS STRING) AS text")
    place = lambda **o: {(r.doc_id, r.shard, r.slot) for r in shards.shuffled(many, 4, **o).collect()}
    first = place()
    assert first == place() and first != place(seed=21)
    order = [d for d, _, _ in sorted(first, key=lambda r: r[1:])]
    assert order != sorted(order) and sorted(order) == list(range(500))


def test_shuffle_is_uniform_over_shards(spark):
    many = spark.range(4000).selectExpr("id AS doc_id", "'x' AS text")
    rows = shards.shuffled(many, 4, least_buckets=16).collect()
    low = [sum(r.doc_id < 1000 for r in rows if r.shard == s) for s in range(4)]
    assert all(180 < n < 320 for n in low)


def test_empty_tables(empty):
    assert shards.sharded(empty, 4).count() == 0
    assert mixing.mixed(empty).count() == 0
    assert packing.packed(empty, PATH).count() == 0


def test_mix_of_odd_rows(docs):
    rows = mixing.mixed(docs).collect()
    assert len(rows) == docs.count()
    assert {r.source: r.source_size for r in rows}[None] == 5
    assert all(r.copies == 0 for r in rows if r["size"] == 0)
    assert all(0 <= r.copies <= 2 for r in rows)
    twice = [r.copies for r in rows if r.doc_id == 8]
    assert twice[0] == twice[1]


@pytest.mark.parametrize("rounds", [1, 3])
def test_mix_meets_targets(spark, rounds):
    rows = [(i, words(i, 5 + i % 40), "abcdef"[min(i % 9, 5)]) for i in range(900)]
    mix = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string"), rounds=rounds).collect()
    for s in "abcdef":
        own = [r for r in mix if r.source == s]
        size, target = own[0].source_size, own[0].target
        assert size == sum(r["size"] for r in own) and target <= 2 * size
        taken = sum(r["size"] * r.copies for r in own)
        assert target - 45 < taken <= target + 1e-6
    targets = {r.source: r.target for r in mix}
    assert abs(sum(targets.values()) - 1.5 * sum(r["size"] for r in mix)) < 1e-3
    free = [s for s in targets if targets[s] < 2 * next(r.source_size for r in mix if r.source == s) - 1e-9]
    weight = dict(zip("abcdef", (5, 2, 1, 5, 2, 1)))
    assert len({round(targets[s] / weight[s], 6) for s in free}) <= 1


def test_mix_prefers_no_document_of_a_source(spark):
    """Inclusion is equal within a source: small and large, early and late keys are taken alike."""
    rows = [(i, words(i, 10 if i % 2 else 30), "a" if i < 1500 else "b") for i in range(2000)]
    mix = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string"), share=0.5, weights=(1,)).collect()
    own = [r for r in mix if r.source == "a"]
    share = lambda part: sum(r.copies for r in part) / len(part)
    assert abs(share([r for r in own if r.doc_id % 2]) - share([r for r in own if r.doc_id % 2 == 0])) < 0.1
    assert abs(share(own[:750]) - share(own[750:])) < 0.1


def test_packing_round_trip(docs):
    pieces = packing.packed(docs, PATH, length=64).collect()
    plain = Tokenizer.from_file(PATH)
    expected = sorted(plain.encode(r.text or "", add_special_tokens=False).ids + [2] for r in docs.collect())
    line = np.concatenate([np.frombuffer(p.ids, dtype="<u4") for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset))])
    assert len(line) == sum(map(len, expected))
    sizes = {}
    for p in pieces:
        assert len(p.ids) == 4 * p.length and p.offset + p.length <= 64
        sizes[p.sequence_id] = sizes.get(p.sequence_id, 0) + p.length
    assert sorted(sizes) == list(range(len(sizes)))
    assert all(n == 64 for s, n in sizes.items() if s != max(sizes))
    cut = np.flatnonzero(line == 2) + 1
    got = sorted(part.tolist() for part in np.split(line, cut) if len(part))
    assert got == expected


@pytest.mark.parametrize("text", [
    "a b\x1cc d", "İstanbul İ x", "é ́e", "don't DON'T 'S it's.", "क़ क", "ß ẞ ŉ ǆ",
    "<|endoftext|> a<|startoftext|>b", "x1y2 ３４ ²", " a　b", "A.B. c... d?! .e", "日本 語", "...", "a" * 5000,
])
def test_encoder_agrees_with_the_tokenizer(text):
    own = packing.WordEncoder(PATH, limit=50)
    plain = Tokenizer.from_file(PATH)
    for t in (text, f"{text} {text}", words(5, 60)):
        assert np.frombuffer(own.encode([t])[0], dtype="<u4").tolist() == plain.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_of_odd_texts_are_those_of_the_tokenizer(name):
    """Random signs of many scripts, words met again, a small memory, and a tokenizer of another kind."""
    path = public_tokenizers.path(name)
    reference, rnd = Tokenizer.from_file(path), random.Random(5)
    pools = [
        [chr(c) for c in range(32, 127)], [chr(c) for c in range(9, 0x250)], [chr(c) for c in range(0x250, 0x3000)],
        list(".,!?;:%#'- aAbBzZ09\u0130\u0131\u00df\u00c0\u00e9"), ["the ", "The, ", "words%% ", "<|endoftext|>", "it's"],
    ]
    texts = ["".join(rnd.choice(rnd.choice(pools)) for _ in range(rnd.randrange(60))) for _ in range(3000)] + ["", None, "x" * 5000]
    own = packing.WordEncoder(path, limit=2000)
    assert own.by_word == name.startswith("word")
    for at in range(0, len(texts), 100):
        some = texts[at : at + 100]
        want = [reference.encode(t or "", add_special_tokens=False).ids for t in some]
        assert [np.frombuffer(code, "<u4").tolist() for code in own.encode(some)] == want

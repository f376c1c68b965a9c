import collections
import math
import re

import pytest

import corpus_pipeline
from carelake.llm import lm, queries
from carelake.session import written
from .conftest import words


def brute(texts, order, alpha=0.4, unseen=0.5):
    split = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) for t in texts]
    grams = lambda w: collections.Counter(tuple(w[i : i + k]) for k in range(1, order + 1) for i in range(len(w) - k + 1))
    total = sum((grams(w) for w in split), collections.Counter())
    n = sum(map(len, split))
    out = []
    for w in split:
        own, sum_ = grams(w), 0.0
        seen = lambda g: total[g] - own[g]  # noqa: B023, E731
        for i in range(len(w)):
            top = min(order, i + 1)
            for k in range(top, 0, -1):
                g = tuple(w[i - k + 1 : i + 1])
                if k == 1:
                    sum_ += math.log(alpha ** (top - 1) * max(seen(g), unseen) / max(n - len(w), 1))
                elif seen(g):
                    sum_ += math.log(alpha ** (top - k) * seen(g) / seen(g[:-1]))
                    break
        out.append((len(w), sum_))
    return out


@pytest.mark.parametrize("order,batch", [(1, 1 << 20), (2, 300), (3, 1 << 20), (4, 60)])
def test_scores_equal_brute_force(spark, order, batch):
    texts = [None, "", " ", "a", "a b", "a b a b a", "A  b\tc", "one", *[words(i % 7, 3 + i) for i in range(40)], "a b a b a"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in lm.scored(df, order=order, batch_bytes=batch, least_ranges=5).collect()}
    assert len(got) == len(texts)
    for i, (n, total) in enumerate(brute(texts, order)):
        assert got[i].n_words == n and got[i].log_score == pytest.approx(total, abs=1e-9)
        assert (got[i].mean_log_score is None) if n == 0 else got[i].mean_log_score == pytest.approx(total / n)


def test_the_query_backs_off_from_three_words(spark, tmp_path):
    texts = ["a b c d", "a b c e", "x b c d", "c b a d", *[words(i % 7, 3 + i) for i in range(20)]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.log_score for r in queries.QUERIES["op4_lm_scores"](spark, str(tmp_path)).collect()}
    assert got == pytest.approx({i: total for i, (_, total) in enumerate(brute(texts, 3))}, abs=1e-9)
    assert got != pytest.approx({i: total for i, (_, total) in enumerate(brute(texts, 2))}, abs=1e-9)


def test_scores_of_odd_rows(docs, empty):
    rows = lm.scored(docs).collect()
    assert len(rows) == docs.count() and lm.scored(empty).count() == 0


def test_stages_take_effect(spark, docs):
    clean = [(500 + i, words(i, 60), "en", f"s{i % 3}", 1) for i in range(30)]
    clean += [(600, clean[0][1], "en", "s0", 1), (601, "999 --- 111", "en", "s1", 1), (602, None, "en", "s1", 1)]
    clean += [(603, f"{words(70, 50)} ann@mail.example.org", "en", "s2", 1)]
    frame = spark.createDataFrame(clean, "doc_id long, text string, lang string, source string, n_chars long")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, frame, ""), f"test-{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == frame.columns
        frame = out
        seen[name] = out.collect()
    ids = lambda name: [r.doc_id for r in seen[name]]
    assert set(ids("known_language")) == {r[0] for r in clean} - {601, 602}
    assert set(ids("one_of_near_copies")) == set(ids("known_language")) - {600}
    text = next(r for r in seen["without_personal_data"] if r.doc_id == 603)
    assert "[EMAIL]" in text.text and "ann@" not in text.text and text.n_chars == len(text.text)
    copies = collections.Counter(ids("mixed_sources"))
    assert max(copies.values()) <= 2 and set(copies) <= set(ids("without_personal_data"))
    assert set(ids("packed_sequences")) == set(copies)


def test_stages_take_odd_and_empty_tables(spark, docs, empty):
    """Further columns named like results (size, score, shard, card) come through as they were."""
    named = lambda df: df.selectExpr("*", "'mine' AS card", "CAST(7 AS INT) AS copies")
    for frame in (named(docs), named(empty)):
        columns = frame.columns
        for name, stage in corpus_pipeline.STAGES:
            frame = written(stage(spark, frame, ""), f"odd-{name}")
            rows = frame.collect()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert frame.columns == columns
                assert all(r["size"] in (1, None) and r.card == "mine" and r.copies == 7 for r in rows)

import random

import numpy as np
import pytest

from carelake.llm import darts, graph, neighbours, topk
from .conftest import words
from pyspark.sql import functions as F


def roots(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("links", [
    [], [(1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 80)], [(i, 90) for i in range(90)],
    [(random.Random(i).randrange(200), 200 + random.Random(-i).randrange(200)) for i in range(250)],
])
def test_components(spark, links):
    df = spark.createDataFrame(links, "lo long, hi long")
    got = {r.node: r.root for r in graph.components(df).collect()}
    assert got == roots(links, {n for pair in links for n in pair})


def jaccard(a, b):
    x, y = ({}, {})
    for t, out in ((a, x), (b, y)):
        w = t.lower().split()
        for i in range(max(len(w) - 4, 1)):
            g = tuple(w[i : i + 5])
            out[g] = out.get(g, 0) + 1
    keys = x.keys() | y.keys()
    return sum(min(x.get(k, 0), y.get(k, 0)) for k in keys) / sum(max(x.get(k, 0), y.get(k, 0)) for k in keys)


def edited(text, seed, share):
    rng, w = random.Random(seed), text.split()
    for i in rng.sample(range(len(w)), int(len(w) * share)):
        w[i] = words(seed * 1000 + i, 1)
    return " ".join(w)


def test_document_classes_against_all_pairs(spark):
    texts = {}
    for base in range(12):
        text = words(base, 60 + 40 * base)
        for k in range(10):
            texts[base * 100 + k] = edited(text, base * 50 + k, (0, 0.01, 0.02, 0.03, 0.06)[k % 5])
    texts |= {5000 + i: words(700 + i, 80) for i in range(60)}
    texts |= {6000: "same line here " * 90, 6001: "same line here " * 100, 6002: "same line here " * 40}
    got = darts.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    ids = sorted(texts)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if jaccard(texts[a], texts[b]) >= 0.8]
    want = roots(links, ids)
    assert len(links) > 100
    assert {r.doc_id: r.class_id for r in got} == want
    assert all(r.kept == (r.class_id == r.doc_id) for r in got)


def test_signatures_estimate_weighted_similarity():
    a = darts.shingles(words(1, 300) + " " + "x y z " * 50)
    b = darts.shingles(words(1, 300) + " " + "x y z " * 20)
    s = darts.signatures([a, b, a], 2000)
    assert (s[0] == s[2]).all()
    assert abs((s[0] == s[1]).mean() - darts.similarity(a, b)) < 0.04
    short = darts.signatures([darts.shingles("one two"), darts.shingles("one two three four five six")], 64)
    assert (short != 0).all()


def test_buckets_larger_than_their_representative(spark, monkeypatch):
    """A chain: neighbours are similar, ends are not. All must come out as one class."""
    text = words(4, 400).split()
    chain = []
    for step in range(12):
        text = text[10:] + words(9000 + step, 10).split()
        chain.append((step, " ".join(text)))
    rows = darts.near_duplicates(spark.createDataFrame(chain, "doc_id long, text string")).collect()
    assert {r.class_id for r in rows} == {0}


def test_odd_documents(docs, empty):
    got = sorted(((r.doc_id, r.class_id, r.kept) for r in darts.near_duplicates(docs).collect()), key=str)
    assert len(got) == docs.count()
    by = {d: (c, k) for d, c, k in got}
    assert by[1] == (1, True) and by[2] == (1, False) and by[None] == (None, None)
    assert all(by[i] == (i, True) for i in (3, 4, 5, 6, 7, 8, 9))
    kept = darts.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "3", "4", "5", "6", "7", "8", "None", "9"])
    assert darts.near_duplicates(empty).count() == 0 and darts.deduplicated(empty).count() == 0


def _vectors(seed, groups, noise, size=16):
    rng = np.random.default_rng(seed)
    out = []
    for n in groups:
        centre = rng.standard_normal(size)
        out += [(centre + noise * rng.standard_normal(size)).tolist() for _ in range(n)]
    return out


def _cosine_links(rows, threshold=0.93):
    out = []
    for i, (a, v, l) in enumerate(rows):
        for b, w, m in rows[i + 1 :]:
            if l == m and l is not None and v and w and len(v) == len(w):
                x, y = np.array(v, dtype=float), np.array(w, dtype=float)
                if np.isfinite(x).all() and np.isfinite(y).all() and x.any() and y.any():
                    if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                        out.append((a, b))
    return out


def test_near_vectors_against_all_pairs(spark):
    vectors = _vectors(1, [40, 25, 8, 3, 2, 2] + [1] * 300, 0.12)
    rows = [(i, v, i % 2) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in neighbours.near_duplicates(df, room=4).collect()}
    links = _cosine_links(rows)
    degree = {i: 0 for i in range(len(rows))}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    found, all_ = sum(r.n_links for r in got.values()), sum(degree.values())
    assert all_ > 500 and found >= 0.99 * all_
    assert all(got[i].n_links <= degree[i] for i in degree)
    want = roots(links, degree)
    assert sum(got[i].component_id != want[i] for i in degree) <= 2
    assert all(r.kept == (r.component_id == r.vec_id) and r.recall > 0.9 for r in got.values())


def _isolated_pairs(seed, singles, pairs, dense, size=32):
    """Rows (c, _label, _v) of one label: a dense group, pairs of cosine 0.94 far from all others, single rows; and the pairs."""
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x)
    centre = unit(rng.standard_normal(size))
    out = [unit(centre + 0.02 * rng.standard_normal(size)) for _ in range(dense)]
    out += [unit(rng.standard_normal(size)) for _ in range(singles)]
    links = []
    for _ in range(pairs):
        x, y = unit(rng.standard_normal(size)), rng.standard_normal(size)
        y = unit(y - (y @ x) * x)
        links.append((len(out), len(out) + 1))
        out += [x, 0.94 * x + np.sqrt(1 - 0.94**2) * y]
    return [(i, "a", v.tolist()) for i, v in enumerate(out)], links


def _unit_links(rows):
    v = np.array([r[2] for r in rows])
    return {(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(v @ v.T >= 0.93, 1)))}


def test_recall_is_a_mean_over_rows(spark):
    """40 rows of a group hold nearly all links; of the ten isolated pairs one is found."""
    group = [(a, b) for a in range(40) for b in range(a + 1, 40)]
    pairs = [(100 + 2 * i, 101 + 2 * i) for i in range(10)]
    frame = lambda rows: spark.createDataFrame([(*r, 1.0) for r in rows], "a long, b long, sim double")
    truth = frame(group + pairs + [(b, a) for a, b in group + pairs]).select(F.col("a").alias("x"), "b")
    every, few = neighbours.row_recall(frame(group + pairs[:1]), truth, 6)
    assert every == pytest.approx((40 + 2) / 60) and few == pytest.approx(0.1)
    assert neighbours.row_recall(frame(group), truth.limit(0), 6) == (None, None)


def test_audit_grows_until_it_holds_linked_rows(spark):
    rows, pairs = _isolated_pairs(5, 3000, 40, 0)
    vectors = spark.createDataFrame(rows, "c long, _label string, _v array<double>")
    links, whole = neighbours.audit(vectors, 0.93, rows=4, most=8192, least=10, few=6)
    assert links.select("x").distinct().count() >= 10
    links, whole = neighbours.audit(vectors, 0.93, rows=4, most=8192, least=1000, few=6)
    assert whole and sorted((r.x, r.b) for r in links.collect() if r.x < r.b) == pairs


def test_all_rows_are_compared_where_trees_do_not_reach_the_goal(spark):
    rows, pairs = _isolated_pairs(6, 2500, 30, 60)
    vectors = spark.createDataFrame(rows, "c long, _label string, _v array<double>")
    links, recall = neighbours.near_links(vectors, 0.93, trees=1, most_trees=1)
    got = sorted((r.a, r.b) for r in links.collect())
    assert recall == 1.0 and len(got) == len(set(got))
    assert set(got) == _unit_links(rows) and set(pairs) < set(got)


def test_a_dense_group_is_filled(spark):
    """Every link of 400 rows is found from a ring and a few chords."""
    rows, _ = _isolated_pairs(7, 0, 0, 400)
    vectors = spark.createDataFrame(rows, "c long, _label string, _v array<double>")
    some = sorted({(min(i, j), max(i, j)) for i in range(400) for j in ((i + 1) % 400, (7 * i + 3) % 400) if i != j})
    known = neighbours.cosines(spark.createDataFrame(some, "a long, b long"), vectors)
    got = neighbours._closed(known, vectors, 0.93).filter("sim >= 0.93")
    assert got.count() == len(_unit_links(rows)) > 70_000


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1),
        (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (11, [1.0, 0.0, 0.0], 1), (12, [], 1),
        (13, [-0.0, 1.0], 1), (14, [0.0, 1.0], 1),
    ]
    df = spark.createDataFrame([(*r, 0, False) for r in rows], "vec_id long, embedding array<float>, label int, n_links int, kept boolean")
    got = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.near_duplicates(df).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 13: (1, 13), 14: (1, 13)} | {i: (0, i) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12)}
    assert neighbours.near_duplicates(df.limit(0)).count() == 0


def _best(rows, k, step):
    out = []
    able = [(i, np.floor(64 * np.array(v, dtype=float))) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, dtype=float)).all()]
    for q, x in dict((i, v) for i, v in able if i % step == 0).items():
        scores = []
        for i, y in able:
            if i != q:
                n = min(len(x), len(y))
                scores.append((-int(x[:n] @ y[:n]), i))
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 4096])
def test_top_k_against_brute_force(spark, block):
    rng = np.random.default_rng(3)
    rows = [(i, np.round(rng.standard_normal(6), 1).tolist()) for i in range(120)]
    rows += [(200, [0.5] * 6), (201, [0.5] * 6), (202, [0.5] * 6), (203, None), (204, [None] * 6), (205, [float("nan")] * 6)]
    rows += [(206, [float("inf")] * 6), (207, [1.0, 1.0]), (208, []), (210, [0.0] * 6), (None, [9.0] * 6)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 10 == 0, k=5, block=block).collect())
    assert got == _best([(i, None if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows], 5, 10)


def test_top_k_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 64 * 128)]
    assert topk.top_k(df, F.lit(False)).count() == 0 and topk.top_k(df.limit(0), F.lit(True)).count() == 0


def test_top_k_of_huge_weights(spark):
    """Sums beyond a long on the way are exact; a score or weight that does not fit is an error."""
    big = float(1 << 55)
    rows = [(20, [big, big, 1.0]), (1, [2.0, -2.0, 3.0]), (2, [64.0, -64.0, 1.0]), (3, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["rank"], r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") == 20, k=3, scale=1).orderBy("rank").collect()]
    assert got == [(1, 3, 1 << 55), (2, 1, 3), (3, 2, 1)]
    over = spark.createDataFrame([(20, [3e9]), (1, [3e9]), (2, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit a long"):
        topk.top_k(over, F.col("vec_id") == 20, k=2, scale=64).collect()
    wide = spark.createDataFrame([(20, [1e18]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit a long"):
        topk.top_k(wide, F.col("vec_id") == 20, k=2, scale=64).collect()


def test_least_vector_of_a_repeated_query_asks(spark):
    df = spark.createDataFrame([(20, [2.0, 0.0]), (20, [0.0, 1.0]), (20, [1.0, 0.0]), (1, [5.0, 7.0])], "vec_id long, embedding array<double>")
    for n in (1, 3):
        got = topk.top_k(df.repartition(n), F.col("vec_id") == 20, scale=1).collect()
        assert [(r.query_id, r.vec_id, r.score) for r in got] == [(20, 1, 7)]


def test_texts_that_share_a_key_are_all_compared(spark):
    """Of several texts under one key none is lost unless it is a copy of another."""
    a, b, c = words(1, 60), words(2, 60), words(3, 60)
    rows = [
        (1, a, "s"), (1, b, "s"), (1, a, "s"), (2, a + " one more word", "s"), (3, b, "s"), (4, c, None), (None, c, "s"), (None, c, "s"),
        (5, None, "s"), (6, "", "s"), (6, c, "s"), (7, words(4, 30), "s"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, _number string")
    got = sorted(((r.doc_id, r.text) for r in darts.deduplicated(df.withColumnRenamed("_number", "more")).collect()), key=str)
    want = [(1, a), (1, b), (4, c), (None, c), (None, c), (5, None), (6, ""), (7, words(4, 30))]
    assert got == sorted(want, key=str)

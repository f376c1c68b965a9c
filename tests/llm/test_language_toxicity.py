import numpy as np

from carelake.llm import language, toxicity
from .conftest import words


def _corpus(spark):
    """Three invented languages with letters of their own."""
    swap = {k: str.maketrans("bdfgklmnprst", own * 3) for k, own in (("qa", "bdfg"), ("qb", "klmn"), ("qc", "prst"))}
    rows = [(i, words(i, 12 + i % 50).translate(swap[k]), k) for i in range(360) for k in [("qa", "qb", "qc")[i % 3]]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_languages(spark):
    df = _corpus(spark)
    model = language.fit(df.filter(~language.held_out("doc_id")))
    rows = language.with_language(df.withColumn("out", language.held_out("doc_id")), model).collect()
    out = [r for r in rows if r.out]
    assert len(out) > 40 and sum(r.lang_pred == r.lang for r in out) / len(out) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_mixed_text_is_ambiguous(spark):
    df = _corpus(spark)
    model = language.fit(df)
    texts = {r.lang: r.text for r in df.filter("doc_id >= 120 and doc_id < 123").collect()}
    both = spark.createDataFrame([(1, f"{texts['qa']} {texts['qb']} {texts['qc']}"), (2, texts["qa"] * 5)], "doc_id long, text string")
    rows = {r.doc_id: r for r in language.with_language(both, model, lead=0.5).collect()}
    assert rows[2].lang_pred == "qa" and not rows[2].ambiguous
    assert rows[1].score < rows[2].score


def test_odd_texts(docs, empty):
    model = language.fit(docs)
    rows = language.with_language(docs, model).collect()
    assert len(rows) == docs.count() and "score" in rows[0] and rows[0]["score"] <= 1
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (3, 4, 5, 7))
    assert all(r.lang_pred in ("en", "fr", "xx") for r in rows if r.doc_id in (1, 2, 6, 8, 9))
    nothing = language.fit(empty)
    assert language.with_language(empty, model).count() == 0
    assert {r.lang_pred for r in language.with_language(docs, nothing).collect()} == {"und"}


def test_codewords():
    for n in (1, 2, 3, 4, 5, 9, 30):
        code = language.codewords(n)
        assert len(code) == n and len({tuple(r) for r in code}) == n
        if n > 1:
            assert all(len(set(column)) == 2 for column in code.T)
    gap = min((a != b).sum() for i, a in enumerate(language.codewords(30)) for b in language.codewords(30)[:i])
    assert gap >= 10


def test_long_text_in_chunks(monkeypatch):
    text = words(3, 400)
    whole = np.concatenate(list(language.trigrams(text)))
    monkeypatch.setattr(language, "_CHUNK", 100)
    assert (np.concatenate(list(language.trigrams(text))) == whole).all()


def _toxic(spark):
    bad = ["grumlo", "vexnit", "skorba", "skorbe"]
    rows = []
    for i in range(800):
        w = words(i, 40).split()
        if i % 8 == 0:
            w[i % 40] = bad[i // 8 % 4]
        rows.append((i, " ".join(w), int(i % 8 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_on_held_out_rows(spark):
    df = _toxic(spark)
    model = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic").filter(~language.held_out("doc_id")))
    rows = toxicity.scored(model, df.withColumn("out", language.held_out("doc_id"))).collect()
    out = [r for r in rows if r.out]
    caught = [r.predicted for r in out if r.toxic]
    assert len(caught) > 10 and sum(caught) / len(caught) > 0.9
    clean = [r.predicted for r in out if not r.toxic]
    assert sum(clean) / len(clean) < 0.05
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_toxicity_of_odd_texts(spark, docs, empty):
    df = _toxic(spark)
    labels = df.select("doc_id", "toxic")
    model = toxicity.fit(df.select("doc_id", "text"), labels)
    rows = toxicity.scored(model, docs).collect()
    assert len(rows) == docs.count() and all(r.score is not None for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4)}) == 1
    assert toxicity.scored(model, empty).count() == 0
    only = toxicity.fit(df.select("doc_id", "text"), labels.filter("toxic = 1"))
    assert {r.score for r in toxicity.scored(only, docs).collect()} == {1.0}
    none = toxicity.fit(df.select("doc_id", "text"), labels.limit(0))
    assert {r.score for r in toxicity.scored(none, docs).collect()} == {0.0}


def test_features():
    scan = toxicity.Scanner({"scoundrel": 5.0, "vequ*": 3.0})
    names = dict(zip(toxicity.FEATURES, scan.features("YOU are a sc0undrel, you scoundrel! vequilo sooo")))
    assert names["word_hits"] == np.log1p(1) and names["prefix_hits"] == np.log1p(1)
    assert names["disguised_density"] == 1 / 8 and names["second_person_near"] == 3 / 8
    assert names["stretched"] == 1 / 8 and names["capital_words"] == 1 / 8
    assert scan.features(None) == scan.features("") and not any(scan.features(""))

import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from carelake.llm import privacy
from .conftest import words

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def spans(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r[0] for r in privacy.found(df).orderBy("doc_id").select(privacy.listed(privacy.KINDS)).collect()]


TEXTS = [
    None, "", "a@b.c", "x a@b.c.d, q.w@e-f.gh.", "a@b.c_x@d.org", "a@b.c..d@e.f", "@a.b a@@b.c a@.b", "a@b.c@d.e",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.300 0001.2.3.4 1.2.3", "9" * 400 + ".1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111 4111  1111 1111 1111", "card 4111111111111111.", "- 4111111111111111 -",
    "4222222222222", "4222222222222 4222222222222", "0" * 13, "0" * 19, "0" * 20, "1- 4111111111111111", "4111111111111111 2",
    "+1 (555) 123-4567", "+1 555 123 4567 89012345", "+12", "+1-", "++1 555 123-4567.", "+1 (386) 555-3733 +1 (366) 555-9807",
    "\U0001f600 é a@b.c \U0001f600 1.2.3.4", "\x01 4111\x01111 1111\x011 a@b\x01c a@b.c", "a.b@c.d\n1.2.3.4\n+49 30 1234567",
    "x" * 20000, "1" * 20000, "1 " * 10000, "a@" + "b." * 5000, ("a@b.cc " * 300), "+" * 5000, "+1" + "(" * 20000, ".1" * 9000,
]


def test_base_spans_equal_plain_matching(spark):
    for text, got in zip(TEXTS, spans(spark, TEXTS)):
        assert got == brute(text), text and text[:60]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="a1@.-_ +()4é\n", max_size=60), min_size=40, max_size=40))
def test_base_spans_of_random_texts(spark, texts):
    assert spans(spark, texts) == [brute(t) for t in texts]


@pytest.fixture(scope="module")
def corpus(spark):
    """Ann's address stands next to 'grumlo' in texts that differ; 'often' is everywhere."""
    rows = [(i, f"{words(i, 12)} often {words(i + 900, 12)}") for i in range(60)]
    rows += [(100 + i, f"{words(i + 300, 20)} grumlo often ann@mail.example.org {words(i + 400, 20)}") for i in range(4)]
    rows += [(200 + i, "only copies hold zvardik bob@mail.example.org here") for i in range(5)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_terms_that_disclose(corpus):
    rows = {r.doc_id: r for r in privacy.protected(corpus).collect()}
    assert all(not r.term for r in rows.values() if r.doc_id < 100)
    assert all(not r.term for r in rows.values() if r.doc_id >= 200)  # copies are no evidence
    for r in (rows[100 + i] for i in range(4)):
        assert [r.text[t.s : t.e] for t in r.term] == ["grumlo"] and r.term[0].removed
        assert len(r.email) == 1


def test_a_signature_in_different_documents_discloses(spark):
    """The 64 characters around the value are the same everywhere, the documents are not."""
    footer = f"{'-' * 70} Grumlo Head Records ann@mail.example.org {'=' * 70}"
    rows = [(i, words(i, 24)) for i in range(60)] + [(100 + i, f"{words(i + 300, 20)} {footer}") for i in range(5)]
    out = privacy.protected(spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id >= 100").collect()
    assert len(out) == 5
    assert all([r.text[t.s : t.e] for t in r.term] == ["Grumlo", "Head", "Records"] for r in out)


def test_a_term_far_from_the_value_is_replaced_at_all_places(spark):
    rows = [(i, words(i, 24)) for i in range(60)]
    rows += [(100 + i, f"Dr Grumlo {words(i + 300, 60)} grumlo {words(i + 400, 60)} ann@mail.example.org") for i in range(5)]
    out = privacy.protected(spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id >= 100").collect()
    assert len(out) == 5
    for r in out:
        assert [r.text[t.s : t.e] for t in r.term] == ["Grumlo", "grumlo"]


def test_sanitised_texts(corpus):
    clean = {r.doc_id: r.text for r in privacy.sanitised(privacy.protected(corpus)).collect()}
    before = {r.doc_id: r.text for r in corpus.collect()}
    assert all(clean[i] == before[i] for i in range(60))
    for i in range(4):
        assert clean[100 + i] == before[100 + i].replace("grumlo", "").replace("ann@mail.example.org", "[EMAIL]")
    soft = privacy.sanitised(privacy.protected(corpus, remove=2.0)).filter("doc_id = 100").first().text
    assert " [WORD] often [EMAIL] " in soft


def test_odd_rows(docs, empty):
    rows = privacy.protected(docs.withColumn("card", F.lit("clash"))).collect()
    assert len(rows) == docs.count()
    for r in rows:
        got = ",".join(f"{k}:{x.s}:{x.e}" for k in privacy.KINDS for x in r[k])
        assert got == brute(r.text)
    clean = privacy.sanitised(privacy.protected(docs))
    assert clean.columns == docs.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[3] is None and texts[4] == "" and texts[8] == "write to [EMAIL] or [PHONE] now"
    assert privacy.sanitised(privacy.protected(empty)).count() == 0


def test_overlapping_spans_are_replaced_once(spark):
    df = spark.createDataFrame([(1, "call +49 4111 1111 1111 1111 x")], "doc_id long, text string")
    marked = privacy.protected(df).withColumn("card", F.expr("array(struct(9 AS s, 28 AS e, 'x' AS m))"))
    marked = marked.withColumn("phone", F.expr("array(struct(5 AS s, 12 AS e, 'x' AS m))"))
    assert privacy.sanitised(marked).first().text == "call [PHONE]1 1111 1111 1111 x"

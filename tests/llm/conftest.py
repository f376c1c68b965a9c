import pytest
from pyspark.sql import types as T

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, score int, shard string, title string"


def words(seed, n):
    """Invented words, the same for the same seed."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append("".join("bdfgklmnprst"[(x >> s) % 12] + "aeiou"[(x >> (s + 3)) % 5] for s in (4, 9, 14)))
    return " ".join(out)


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls in every column, empty and long texts, copies, a repeated row, and clashing extra columns."""
    long_text = words(99, 6000)
    rows = [
        (1, "alpha beta gamma delta epsilon", "en", "a", 30, 1, 1, "x", "t"),
        (2, "alpha beta gamma delta epsilon", "en", "a", 30, 1, 1, "x", "t"),
        (3, None, "en", "b", None, None, None, None, None),
        (4, "", "en", "b", 0, 1, 1, "x", "t"),
        (5, " \n\t ", None, None, 4, 1, 1, "x", "t"),
        (6, long_text, "xx", "c", len(long_text), 1, 1, "x", "t"),
        (7, "12345 !!! 678", "en", "c", 12, 1, 1, "x", "t"),
        (8, "write to ann@mail.example.org or +1 (555) 123-4567 now", "en", "c", 50, 1, 1, "x", "t"),
        (8, "write to ann@mail.example.org or +1 (555) 123-4567 now", "en", "c", 50, 1, 1, "x", "t"),
        (None, "no key but a text", None, None, 17, 1, 1, "x", "t"),
        (9, "één één été \U0001f600 naïve", "fr", "d", 20, 1, 1, "x", "t"),
    ]
    return spark.createDataFrame(rows, T._parse_datatype_string(SCHEMA))


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)

"""Personal data: patterns for the protected values, corpus statistics for what gives them away.

Emails, addresses, cards and phone numbers are found by pattern and are always protected. Then, as in
information-theoretic sanitisation, the terms of documents with a protected value are weighed by the corpus: a value
``c`` carries ``IC(c) = -log2 P(c)`` bits, and a term ``t`` of its document reveals ``PMI(c;t) = log2
P(c,t) / (P(c) P(t))`` of them, with probabilities over all documents. A term that reveals more than a
share ``disclose`` of a value is generalised at all its places in every document that holds the value, and
removed above ``remove``. Terms are words of three letters or more outside the protected values. One text
and its copies are no evidence: every distinct text counts once, a pair must be held by two of them, and
it must be so frequent that chance would give less than ``chance`` such terms for a value (the hypergeometric probability of the pair, times the number of terms).

Built-in functions only. Positions are code points from 0, ends exclusive. Patterns have no nested
repetition and look at each character a bounded number of times, so long texts are safe.

Nulls: a null text is empty and has no spans; a null or repeated key is fine, as rows are told apart by
key and text. An empty table gives an empty result. Input columns named like a result column are
replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..session import written

KINDS = ("email", "ip", "card", "phone")
_JOIN = "\x01"  # stands for an inner dot or separator while a pattern is applied; the length stays
_LOCAL = r"A-Za-z0-9._%+\x01-"
#: Character to hide, where it is inner; then the pattern over the text so prepared.
_PATTERNS = {
    "email": (r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])",
              rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++\x01[A-Za-z0-9\x01-]++"),
    "ip": (None, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"(?<=[0-9])[\x20-](?=[0-9])", r"(?<![0-9\x01])(?:[0-9]\x01?){13,19}(?![0-9\x01])"),
    "phone": (None, r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_SPAN = "array<struct<s:int,e:int,m:string>>"


def _located(text: Column, pattern: str) -> Column:
    """Matches with start and end. What lies between the matches comes from a split by the same
    pattern, so adding up lengths gives the places."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def add(acc: Column, part: Column) -> Column:
        s = acc["at"] + F.length(part["gap"])
        e = s + F.length(part["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), part["m"].alias("m")))).alias("out"))

    return F.aggregate(F.filter(parts, lambda p: p["m"].isNotNull()), start, add, lambda acc: acc["out"])


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), value), F.lit(0), lambda a, b: a + b) % 10 == 0


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: p.try_cast("double") <= 255)
    if kind == "card":
        return _luhn(_digits(match))
    return F.length(_digits(match)).between(9, 15) if kind == "phone" else F.lit(True)


def _possible(kind: str, text: Column) -> Column:
    """A cheap test that spares most texts the pattern."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    return F.contains(text, F.lit("+")) if kind == "phone" else F.rlike(text, F.lit("[0-9][ .-]?[0-9]"))


def base_spans(text: Column, kind: str) -> Column:
    """Valid matches of a kind, leftmost first and not overlapping."""
    inner, pattern = _PATTERNS[kind]
    plain = F.translate(text, _JOIN, "\x02")
    hidden = F.regexp_replace(plain, F.lit(inner), F.lit(_JOIN)) if inner else plain
    found = F.when(_possible(kind, text), _located(hidden, pattern)).otherwise(F.array().cast(_SPAN))
    return F.filter(found, lambda x: _valid(kind, x["m"]))


def found(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``_text`` (never null) and an array of spans per kind, named like the kind."""
    out = df.withColumn("_text", F.coalesce(F.col(text).cast("string"), F.lit("")))
    return out.withColumns({kind: base_spans(F.col("_text"), kind) for kind in KINDS})


def _bare(text: Column) -> Column:
    """The text with every base span replaced by a space."""
    marks = F.array_sort(F.concat(*[F.transform(F.col(k), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))) for k in KINDS]))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        more = F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, F.greatest(x["s"] - acc["at"], F.lit(0))), F.lit(" ")))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), more.alias("out"))

    tail = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text)))
    return F.when(F.size(marks) == 0, text).otherwise(F.aggregate(marks, start, add, tail))


def _forms(text: Column) -> Column:
    """The distinct words of three letters or more, as written."""
    return F.filter(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\p{L}+"), F.lit(0))), lambda w: F.length(w) >= 3)


def held_values(spans: DataFrame) -> DataFrame:
    """(_d, _c): the protected values of each distinct text."""
    name = lambda k: lambda x: F.xxhash64(
        F.lit(k), _digits(x["m"]) if k in ("card", "phone") else F.lower(F.translate(x["m"], _JOIN, "."))
    )
    every = F.array_distinct(F.concat(*[F.transform(F.col(k), name(k)) for k in KINDS]))
    return spans.select(F.xxhash64("_text").alias("_d"), F.explode(every).alias("_c")).distinct()


def _log_factorial(x: Column) -> Column:
    """Stirling's series; its error is below 0.0003 from 2 on."""
    series = x * F.log(x) - x + F.log(2 * math.pi * x) / 2 + 1 / (12 * x)
    return F.when(x < 2, F.lit(0.0)).otherwise(series)


def _log_chance(together: Column, values: Column, terms: Column, n: Column) -> Column:
    """Logarithm of the probability that ``terms`` of ``n`` texts, drawn at random, meet ``values`` of them ``together`` times."""
    choose = lambda m, k: _log_factorial(m) - _log_factorial(k) - _log_factorial(m - k)
    return choose(values, together) + choose(n - values, terms - together) - choose(n, terms)


def disclosing(spans: DataFrame, disclose: float, remove: float, chance: float) -> DataFrame:
    """(_d, _t, _removed): the terms of each distinct text that disclose a value it holds. Counts are of
    distinct texts. As no pair is held by more texts than its value, a term in more than ``(n / nc) ^ -disclose * n`` of the
    ``n`` texts cannot reach the share for a value in ``nc``; such terms are left out before pairs are made, which loses none."""
    texts = spans.select(F.xxhash64("_text").alias("_d"), _bare(F.col("_text")).alias("_bare")).dropDuplicates(["_d"])
    words = texts.select("_d", F.explode(F.array_distinct(F.transform(_forms(F.col("_bare")), lambda w: F.xxhash64(F.lower(w))))).alias("_t"))
    terms = written(words.groupBy("_t").agg(F.count(F.lit(1)).cast("double").alias("_nt")), "counts")
    n, kinds = texts.agg(F.count(F.lit(1)).cast("double")).scalar(), terms.agg(F.count(F.lit(1)).cast("double")).scalar()
    held = written(held_values(spans), "held")
    values = held.groupBy("_c").agg(F.count(F.lit(1)).cast("double").alias("_nc")).filter("_nc > 1")
    values = written(values.withColumn("_n", n).withColumn("_most", F.col("_n") * F.pow(F.col("_nc") / F.col("_n"), F.lit(disclose)) + 1e-6), "values")
    some = written(held.join(values, "_c"), "some")
    able = terms.filter(F.col("_nt") > 1).filter(F.col("_nt") <= values.agg(F.coalesce(F.max("_most"), F.lit(0.0))).scalar())
    rare = words.join(some.select("_d").distinct(), "_d", "left_semi").join(able, "_t")
    pairs = written(rare.join(some, "_d").filter(F.col("_nt") <= F.col("_most")).select("_d", "_c", "_t", "_nt", "_nc", "_n"), "pairs")
    known = pairs.groupBy("_c", "_t", "_nt", "_nc", "_n").agg(F.count(F.lit(1)).cast("double").alias("_ct")).filter("_ct > 1")
    pmi = F.log2(F.col("_ct") * F.col("_n") / (F.col("_nc") * F.col("_nt")))
    share = F.try_divide(pmi, F.log2(F.col("_n") / F.col("_nc")))
    unlikely = _log_chance(F.col("_ct"), F.col("_nc"), F.col("_nt"), F.col("_n")) + F.log(kinds) < math.log(chance)
    risky = known.withColumn("_share", share).filter((F.col("_share") >= disclose) & unlikely)
    risky = risky.select("_c", "_t", (F.col("_share") >= remove).alias("_removed"))
    return pairs.select("_d", "_c", "_t").join(risky, ["_c", "_t"]).groupBy("_d", "_t").agg(F.max("_removed").alias("_removed"))


def _places(text: Column, risky: Column) -> Column:
    """All places (s, e, removed) of the terms ``risky`` (t, removed) outside the base spans."""
    hash_ = lambda w: F.xxhash64(F.lower(w))
    forms = F.filter(_forms(_bare(text)), lambda w: F.array_contains(F.transform(risky, lambda x: x["t"]), hash_(w)))
    pattern = F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join(forms, "|"), F.lit(r")(?!\p{L})"))
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def add(acc: Column, part: Column) -> Column:
        s = acc["at"] + F.length(part["gap"])
        e = s + F.length(part["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), part["m"].alias("m")))).alias("out"))

    hits = F.aggregate(F.filter(parts, lambda p: p["m"].isNotNull()), start, add, lambda acc: acc["out"])
    taken = F.concat(*[F.transform(F.col(k), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))) for k in KINDS])
    clear = F.filter(hits, lambda h: ~F.exists(taken, lambda x: (x["s"] < h["e"]) & (x["e"] > h["s"])))
    gone = lambda h: F.exists(risky, lambda x: (x["t"] == hash_(h["m"])) & x["removed"])
    return F.transform(clear, lambda h: F.struct(h["s"].alias("s"), h["e"].alias("e"), gone(h).alias("removed")))


def protected(
    df: DataFrame, key: str = "doc_id", text: str = "text", disclose: float = 0.8, remove: float = 0.95, chance: float = 0.05
) -> DataFrame:
    """``df`` with a span array for every kind (email, ip, card, phone) and ``term``: (s, e, removed)."""
    names = {*KINDS, "term", "_text"}
    spans = found(df.drop(*[c for c in df.columns if c.lower() in names]), text)
    risky = disclosing(spans, disclose, remove, chance)
    terms = risky.groupBy("_d").agg(F.collect_list(F.struct(F.col("_t").alias("t"), F.col("_removed").alias("removed"))).alias("_risky"))
    none = F.array().cast("array<struct<s:int,e:int,removed:boolean>>")
    marked = spans.withColumn("_d", F.xxhash64("_text")).join(written(terms, "terms"), "_d", "left")
    places = F.when(F.col("_risky").isNotNull(), _places(F.col("_text"), F.col("_risky"))).otherwise(none)
    return marked.withColumn("term", places).drop("_d", "_risky")


def listed(kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of the spans, by kind as listed and then by start, joined by commas."""
    name = lambda k: lambda x: F.concat_ws(":", F.lit(k), x["s"].cast("string"), x["e"].cast("string"))
    return F.array_join(F.concat(*[F.transform(F.col(k), name(k)) for k in kinds]), ",")


def sanitised(spans: DataFrame, text: str = "text") -> DataFrame:
    """The columns of the document with every span replaced: a base span by its kind, a generalised
    term by NAME (capital first) or WORD, a removed term by nothing. Of overlapping spans the first,
    then the longest, stands. A null text stays null."""
    as_name = lambda k: lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), F.lit(f"[{k.upper()}]").alias("by"))
    piece = lambda s, e: F.substring(F.col("_text"), s + 1, e - s)

    def as_term(x: Column) -> Column:
        first = F.substring(F.col("_text"), x["s"] + 1, F.lit(1))
        kind = F.when(x["removed"], "").when(first != F.lower(first), "[NAME]").otherwise("[WORD]")
        return F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), kind.alias("by"))

    marks = F.array_sort(F.concat(*[F.transform(F.col(k), as_name(k)) for k in KINDS], F.transform(F.col("term"), as_term)))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        keep = x["s"] >= acc["at"]
        more = F.concat(acc["out"], F.array(piece(acc["at"], x["s"]), x["by"]))
        return F.struct(F.when(keep, -x["e"]).otherwise(acc["at"]).alias("at"), F.when(keep, more).otherwise(acc["out"]).alias("out"))

    tail = lambda acc: F.concat(F.array_join(acc["out"], ""), piece(acc["at"], F.length(F.col("_text"))))
    clean = F.when(F.size(marks) == 0, F.col("_text")).otherwise(F.aggregate(marks, start, add, tail))
    return spans.withColumn(text, F.when(F.col(text).isNotNull(), clean)).drop(*KINDS, "term", "_text")

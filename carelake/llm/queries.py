"""The operators bound to the tables, with production parameters, next to their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bestfit, darts, dualtree, language, lm, merkle, mixing, neighbours, packing, privacy, shards, topk, toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_shards")
def op1_shards(spark, sf_dir):
    placed = shards.sharded(table(spark, sf_dir, "documents"), 16)
    return placed.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32("text").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


NEAR_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
      AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
l AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e)) / sqrt(list_inner_product(b.e, b.e)) >= 0.93),
r(id, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.root FROM r JOIN l ON r.id = l.a)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = vec_id) AS n_links, root AS component_id, vec_id = root AS kept, 1.0::DOUBLE AS recall
FROM (SELECT id AS vec_id, min(root) AS root FROM r GROUP BY id)
"""


@query("op2_near_vectors", NEAR_SQL)
def op2_near_vectors(spark, sf_dir):
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op3_near_documents")
def op3_near_documents(spark, sf_dir):
    return darts.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_lm_scores")
def op4_lm_scores(spark, sf_dir):
    return lm.scored(table(spark, sf_dir, "documents"), order=3)


def _mix_rounds(rounds: int) -> str:
    """SQL for the rounds of the mix: each takes the front of the ranks among what still fits."""
    steps = []
    for k in range(rounds):
        earlier = "".join(f" AND NOT EXISTS (SELECT 1 FROM t{j} WHERE t{j}.doc_id = r.doc_id)" for j in range(k))
        spent = "".join(
            f" - coalesce((SELECT sum(size) FROM t{j} WHERE t{j}.source IS NOT DISTINCT FROM s.source), 0)" for j in range(k)
        )
        steps.append(f"""
        n{k} AS MATERIALIZED (SELECT source, need{spent} AS need FROM split s),
        t{k} AS MATERIALIZED (SELECT doc_id, source, size FROM (
            SELECT r.doc_id, r.source, r.size, n.need,
                   sum(r.size) OVER (PARTITION BY r.source ORDER BY r.q, r.doc_id) AS cum
            FROM ranks r JOIN n{k} n ON r.source IS NOT DISTINCT FROM n.source
            WHERE r.size > 0 AND r.size <= n.need AND r.q IS NOT NULL{earlier}) WHERE cum <= need)""")
    return ",".join(steps)


MIX_SQL = f"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
           (CAST('0x' || substr(md5('20|' || doc_id), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496 AS u
    FROM documents),
s AS (
    SELECT source, sum(size)::DOUBLE AS total,
           [5, 2, 1][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS weight
    FROM d GROUP BY source),
c AS (
    SELECT *, 2 * total AS cap, 1.5::DOUBLE * sum(total) OVER () AS whole,
           coalesce(sum(2 * total) OVER (ORDER BY 2 * total / weight ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
           sum(weight) OVER (ORDER BY 2 * total / weight ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
    FROM s),
l AS (SELECT arg_min((whole - held) / free, cap / weight) FILTER (weight * ((whole - held) / free) <= cap) AS level FROM c),
g AS (SELECT source, total, CASE WHEN level IS NULL THEN cap ELSE least(cap, weight * level) END AS target FROM c, l),
split AS (
    SELECT *, target - whole * total AS need, factor - whole AS p
    FROM (SELECT *, least(floor(factor), 2) AS whole
          FROM (SELECT *, CASE WHEN total > 0 THEN target / total ELSE 0 END AS factor FROM g))),
ranks AS (
    SELECT d.*, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q
    FROM d JOIN split ON d.source IS NOT DISTINCT FROM split.source),
{_mix_rounds(3)}
SELECT d.doc_id, d.size, split.total::BIGINT AS source_size, split.target,
       CAST(d.size * (whole + (EXISTS (SELECT 1 FROM t0 WHERE t0.doc_id = d.doc_id)
           OR EXISTS (SELECT 1 FROM t1 WHERE t1.doc_id = d.doc_id)
           OR EXISTS (SELECT 1 FROM t2 WHERE t2.doc_id = d.doc_id))::INT) AS BIGINT) AS taken
FROM d JOIN split ON d.source IS NOT DISTINCT FROM split.source
"""


@query("op5_mix", MIX_SQL)
def op5_mix(spark, sf_dir):
    mix = mixing.mixed(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op6_top_k", """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
    WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.w) + 1), lambda i: q.w[i] * c.w[i])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
""")
def op6_top_k(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op7_language")
def op7_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.filter(~language.held_out("doc_id")))
    rows = docs.select("doc_id", "text", language.held_out("doc_id").alias("held_out"))
    return language.with_language(rows, model).drop("text")


@query("op8_privacy")
def op8_privacy(spark, sf_dir):
    spans = privacy.protected(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return spans.select(
        "doc_id",
        *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in privacy.KINDS],
        F.sha2(privacy.listed(privacy.KINDS), 256).alias("base_sha256"),
        privacy.listed((*privacy.KINDS, "term")).alias("spans"),
    )


@query("op9_packing")
def op9_packing(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.packed(table(spark, sf_dir, "documents"), path)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~language.held_out("doc_id"))
    model = toxicity.fit(docs, labels)
    rows = docs.select("doc_id", "text", language.held_out("doc_id").alias("held_out"))
    return toxicity.scored(model, rows).drop("text")


MERKLE_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def _entry(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf_sql(n_chars: str) -> str:
    values = {"doc_id": "d.doc_id::VARCHAR", "n_chars": f"({n_chars})::VARCHAR"}
    return "sha256(" + " || ".join(_entry(values.get(c, c)) for c in MERKLE_COLUMNS) + ")"


#: The levels of all trees by recursion, then each leaf walked up them; crc32 by its bits, as DuckDB has none.
MERKLE_SQL = f"""
WITH RECURSIVE
bits AS (
    SELECT doc_id, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
            lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS crc
    FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
leaves AS (
    SELECT d.doc_id, coalesce('=' || lang, '') AS g, {_leaf_sql("n_chars")} AS leaf,
           CASE WHEN xor(b.crc, 4294967295) % 7 = 0 THEN {_leaf_sql("n_chars + 1")} ELSE {_leaf_sql("n_chars")} END AS given
    FROM documents d LEFT JOIN bits b ON d.doc_id = b.doc_id),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaves),
low AS (
    SELECT g, 0 AS lv, i, n, leaf AS h FROM ranked
    UNION ALL
    SELECT g, lv + 1, i // 2, (n + 1) // 2, sha256(h || coalesce(nxt, ''))
    FROM (SELECT *, lead(h) OVER (PARTITION BY g ORDER BY i) AS nxt FROM low WHERE n > 1) WHERE i % 2 = 0),
subs AS (SELECT g, h AS sub, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
    SELECT 0 AS lv, i, n, sub AS h FROM subs
    UNION ALL
    SELECT lv + 1, i // 2, (n + 1) // 2, sha256(h || coalesce(nxt, ''))
    FROM (SELECT *, lead(h) OVER (ORDER BY i) AS nxt FROM high WHERE n > 1) WHERE i % 2 = 0),
walk AS (
    SELECT doc_id, g, leaf, i AS place, 0 AS lv, i, n, '' AS proof, given AS h FROM ranked
    UNION ALL
    SELECT w.doc_id, w.g, w.leaf, w.place, w.lv + 1, w.i // 2, (w.n + 1) // 2, w.proof || coalesce(s.h, ''),
           sha256(CASE WHEN w.i % 2 = 1 THEN s.h || w.h ELSE w.h || coalesce(s.h, '') END)
    FROM walk w LEFT JOIN low s ON s.g = w.g AND s.lv = w.lv AND s.i = xor(w.i, 1) WHERE w.n > 1),
rise AS (
    SELECT w.doc_id, w.g, w.leaf, w.place, 0 AS lv, s.i, s.n, w.proof, w.h FROM walk w JOIN subs s ON s.g = w.g WHERE w.n = 1
    UNION ALL
    SELECT w.doc_id, w.g, w.leaf, w.place, w.lv + 1, w.i // 2, (w.n + 1) // 2, w.proof || coalesce(s.h, ''),
           sha256(CASE WHEN w.i % 2 = 1 THEN s.h || w.h ELSE w.h || coalesce(s.h, '') END)
    FROM rise w LEFT JOIN high s ON s.lv = w.lv AND s.i = xor(w.i, 1) WHERE w.n > 1)
SELECT r.doc_id, r.leaf, subs.sub AS subroot, high.h AS root, sha256(r.proof) AS proof_sha256, r.h AS folded_root, r.h = high.h AS verified
FROM rise r JOIN subs ON subs.g = r.g JOIN high ON high.n = 1 WHERE r.n = 1
"""


@query("op11_merkle", MERKLE_SQL)
def op11_merkle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(*MERKLE_COLUMNS)
    columns = {c: F.col(c) for c in MERKLE_COLUMNS}
    changed = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    leaf = merkle.entry_hash(list(columns.values()))
    tampered = merkle.entry_hash(list((columns | {"n_chars": F.col("n_chars") + 1}).values()))
    leaves = docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(changed, tampered).alias("tampered"))
    proved = merkle.proofs(leaves, "leaf", "doc_id", "lang", carry=("tampered",))
    folded = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return proved.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op12_best_fit")
def op12_best_fit(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = bestfit.packed(table(spark, sf_dir, "documents"), path)
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _terms_sql(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_CAPITALS}', '{_CAPITALS.lower()}'), '{_TERM}')"


RANKED_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_terms_sql("text")} AS terms FROM documents),
size AS (SELECT count(*) FILTER (len(terms) > 0) AS n, sum(len(terms))::BIGINT AS l FROM d),
asked AS MATERIALIZED (SELECT DISTINCT item_id, unnest({_terms_sql("text")}) AS term FROM benchmark),
tf AS MATERIALIZED (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d)
    WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, size GROUP BY term, n),
scores AS (
    SELECT item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * len(terms) * n) // l))))::BIGINT AS score
    FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN d USING (r), size GROUP BY item_id, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
    SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank
    FROM scores JOIN d USING (r) WHERE score > 0) WHERE rank <= 10
"""


@query("op13_ranked", RANKED_SQL)
def op13_ranked(spark, sf_dir):
    return dualtree.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

"""A corpus pipeline from the operators of ``carelake.llm``: language, near copies, personal data, mix, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of
``documents``. ``run`` writes what a stage returns and reads it again for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from carelake.llm import darts, language, mixing, packing, privacy
from carelake.session import written

TOKENIZER = "word_bpe_49k.json"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _keeping_columns(stage):
    """A stage over the columns of ``documents``; further columns pass by under names of their own, so
    none of them meets a column that an operator adds, and come back as they were."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inner = {c: c if c in COLUMNS else f"_further{i}" for i, c in enumerate(docs.columns)}
        out = stage(spark, docs.select(*[F.col(f"`{c}`").alias(name) for c, name in inner.items()]), sf_dir)
        return out.select(*[F.col(name).alias(c) for c, name in inner.items()])

    run_stage.__name__, run_stage.__doc__ = stage.__name__, stage.__doc__
    return run_stage


@_keeping_columns
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told: those without a letter and those between two languages go."""
    model = language.fit(docs.filter(~language.held_out("doc_id")))
    named = docs.withColumn("_found", language.identified(model, F.col("text")))
    return named.filter((F.col("_found.lang_pred") != "und") & ~F.col("_found.ambiguous"))


@_keeping_columns
def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return darts.deduplicated(docs)


@_keeping_columns
def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and what discloses it replaced; ``n_chars`` follows the text."""
    clean = privacy.sanitised(privacy.protected(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@_keeping_columns
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    mix = mixing.mixed(docs).filter(F.col("copies") > 0)
    return mix.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies")))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 ids."""
    return packing.packed(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("known_language", known_language),
    ("one_of_near_copies", one_of_near_copies),
    ("without_personal_data", without_personal_data),
    ("mixed_sources", mixed_sources),
    ("packed_sequences", packed_sequences),
]

#: Learned models, signatures and a tokenizer: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs

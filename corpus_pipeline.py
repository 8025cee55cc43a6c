"""Training corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Language ID drops texts whose language can't be told; line dedup keeps a long line in its first document only;
the n-gram Jaccard join (five words, 0.8) keeps the first document of each class of near copies; mixing takes each source's
share, some documents twice, some not; packing returns the pieces of all that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tokenloom.llm import jaccard_join, language_id, line_dedup, mixing, packing
from tokenloom.llm.common import stage, table


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language."""
    return language_id.keep_identified(spark, docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long lines that an earlier document holds; ``n_chars`` follows the text."""
    return line_dedup.rewrite_texts(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near copies."""
    return jaccard_join.keep_one(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the amounts that the mix takes."""
    return mixing.apply_mix(spark, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequence and place."""
    return packing.pack(spark, docs)


STAGES = [
    ("language_id", identify_languages),
    ("line_dedup", dedup_lines),
    ("jaccard_join", drop_near_copies),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: A trained model, similarity classes and a linear program aren't SQL-expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(spark, step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Vector aggregation: mean embeddings and L2 normalisation.

Means of ``array<float>`` rows are partial vector aggregates: a group with a third of all rows is
one vector per task before the shuffle.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def l2_norm(vec) -> Column:
    v = F.col(vec) if isinstance(vec, str) else vec
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(vec) -> Column:
    """``v / ||v||``; null for a zero vector (the original divides by zero)."""
    v = F.col(vec) if isinstance(vec, str) else vec
    n = l2_norm(v)
    return F.when(n > 0, F.transform(v, lambda x: x.cast("double") / n))


def mean_vector(df: DataFrame, group: str | list[str], vec: str, out: str = "mean") -> DataFrame:
    """Element-wise mean of ``vec`` per group, as ``array<double>`` in index order.

    A vector stays one row: Spark's vector summariser adds vectors up within each task before the shuffle.
    """
    keys = [group] if isinstance(group, str) else list(group)
    vector = array_to_vector(F.col(vec).cast("array<double>"))
    return df.where(F.col(vec).isNotNull()).groupBy(*keys).agg(vector_to_array(Summarizer.mean(vector)).alias(out))


def utterance_embedding(partials: DataFrame, key: str = "key", vec: str = "vec", out: str = "embedding") -> DataFrame:
    """A4: mean of an utterance's partial embeddings, then unit L2 norm."""
    m = mean_vector(partials, key, vec, "_tl_mean")
    return m.select(key, l2_normalize("_tl_mean").alias(out))


def speaker_embedding(utterances: DataFrame, speaker: str = "speaker", vec: str = "embedding",
                      out: str = "embedding") -> DataFrame:
    """A5: mean of a speaker's (unit) utterance embeddings, re-normalised."""
    m = mean_vector(utterances, speaker, vec, "_tl_mean")
    return m.select(speaker, l2_normalize("_tl_mean").alias(out))


def check_embedding_dims(df: DataFrame, dim: int, vec: str = "embedding") -> DataFrame:
    """Width invariant per table: rows, rows of the wrong width, null vectors."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(F.size(vec) != dim, 1).otherwise(0)).alias("n_bad_width"),
        F.sum(F.when(F.col(vec).isNull(), 1).otherwise(0)).alias("n_null"),
        F.min(F.size(vec)).alias("min_width"),
        F.max(F.size(vec)).alias("max_width"),
    )

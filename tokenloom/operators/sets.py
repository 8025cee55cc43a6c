"""Unions, split leakage, repetition."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_outputs(*dfs: DataFrame) -> DataFrame:
    """G1: union by column name (cached ∪ computed, or train ∪ val ∪ test)."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def split_leakage(a: DataFrame, b: DataFrame, key: str = "key") -> DataFrame:
    """Keys of ``a`` that also occur in ``b`` (semi join: no pair explosion)."""
    return a.join(b.select(key), key, "left_semi")


def repeat_samples(df: DataFrame, n: int, out: str = "sample_id") -> DataFrame:
    """Every row ``n`` times with ``sample_id`` 0..n-1 (explode; no join)."""
    return df.withColumn(out, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))

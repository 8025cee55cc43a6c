"""Small aggregates over manifests and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_dirs(manifest: DataFrame, key: str = "key", out: str = "dir") -> DataFrame:
    """A1: distinct first path segment of the keys, in code-point order."""
    return manifest.select(F.element_at(F.split(key, "/", -1), 1).alias(out)).distinct().orderBy(out)


def manifest_count(manifest: DataFrame) -> DataFrame:
    """A2: row count as a one-row table (scalar for shard / split arithmetic)."""
    return manifest.agg(F.count(F.lit(1)).alias("n_rows"))


def batch_token_len(batches: DataFrame, max_new: int, batch: str = "batch_id", length: str = "length") -> DataFrame:
    """Over length-sorted batches, the largest (shortest length in batch + max_new)."""
    per = batches.groupBy(batch).agg(F.min(length).alias("_tl_min"))
    return per.agg((F.max("_tl_min") + max_new).alias("max_token_len"))


def hierarchy_lengths(rows) -> tuple[F.Column, F.Column, F.Column]:
    """(distinct lengths, min, max) across the codebook rows of one sample."""
    r = F.col(rows) if isinstance(rows, str) else rows
    sizes = F.transform(r, lambda x: F.size(x))
    return F.array_sort(F.array_distinct(sizes)), F.array_min(sizes), F.array_max(sizes)


def length_guard(df: DataFrame, max_new: int, block: int, length: str = "length", by: str | None = None) -> DataFrame:
    """``max(len) + max_new >= block`` is an error naming the largest legal max_new; per ``by`` if given."""
    mx = F.max(length)
    return df.groupBy(*([by] if by else [])).agg(mx.alias("max_len"), F.when(mx + max_new >= block, F.concat(
        F.lit("at most "), (F.lit(block) - mx - 1).cast("string"), F.lit(f" new tokens fit, not {max_new}"))).alias("error"))

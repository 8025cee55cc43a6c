"""Training-data plan: manifest -> artifacts -> samples -> batches -> collated tensors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators.collate import collate, frame_size, text_size
from tokenloom.operators.joins import admit, assemble_samples
from tokenloom.operators.position import fixed_batches, with_position
from tokenloom.sources import tables


def admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest rows ``(key, pos, reason)``; ``reason`` is null for rows that have all artifacts."""
    return admit(tables.manifest(spark, sf_dir).select("key", "pos"), {
        "text": tables.text_token_artifact(spark, sf_dir), "embedding": tables.embedding_artifact(spark, sf_dir),
        "codes": tables.code_artifact(spark, sf_dir)})


def training_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 over the derived artifact tables, of the admitted rows; :func:`admission` shows the others."""
    return assemble_samples(
        admission(spark, sf_dir).where("reason is null").drop("reason"),
        tables.text_token_artifact(spark, sf_dir, by_key=True),
        tables.embedding_artifact(spark, sf_dir),
        tables.code_artifact(spark, sf_dir, by_key=True),
    )


def batched_samples(spark: SparkSession, sf_dir: str, batch_size: int = 16) -> DataFrame:
    """J1 samples with dense row numbers (O1) and fixed batch ids.

    Row numbers and batch ids are computed on a narrow ``(key, pos)`` projection of the
    admitted rows, which O1 stores once; the wide artifacts are then joined on ``key``, every side
    hash-partitioned on it. A missing artifact there is an error.
    """
    return assemble_samples(_batched_rows(spark, sf_dir, batch_size), tables.text_token_artifact(spark, sf_dir, by_key=True),
                            tables.embedding_artifact(spark, sf_dir), tables.code_artifact(spark, sf_dir, by_key=True))


def _batched_rows(spark: SparkSession, sf_dir: str, batch_size: int) -> DataFrame:
    present = admission(spark, sf_dir).where("reason is null").drop("reason")
    return fixed_batches(with_position(present, ["pos"], out="row"), batch_size, pos="row")


def sized_samples(spark: SparkSession, sf_dir: str, batch_size: int = 16) -> DataFrame:
    """:func:`batched_samples` with the sizes of its arrays in place of them.

    Sizes are taken where an artifact is made, so the joins on ``key`` move and sort one number a row instead of arrays.
    A missing artifact is an error here too.
    """
    return assemble_samples(
        _batched_rows(spark, sf_dir, batch_size),
        tables.text_token_artifact(spark, sf_dir).select("key", text_size("tokens").alias("tokens")),
        tables.embedding_artifact(spark, sf_dir).select("key", F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("embedding")),
        tables.code_artifact(spark, sf_dir).select("key", frame_size("codes").alias("codes")))


def training_batches(spark: SparkSession, sf_dir: str, batch_size: int = 16, max_len: int | None = 2048,
                     ) -> DataFrame:
    """Flagship: J1 -> O1 (dense row numbers) -> O4 -> T5 with L2 cut at ``max_len``.

    See :func:`batched_samples` for the join layout; one more shuffle by batch id feeds
    collation, so wide rows cross the network twice.
    """
    return collate(batched_samples(spark, sf_dir, batch_size), max_len=max_len).select(
        "batch_id", "row", "pos", "key", "text", "embedding", "codes", "input", "target")

"""Batch collation: shapes, padding and next-token layout per batch (A3, T5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tokenloom.functions.tokens import interleave, pad_codes, pad_right, stage1_input, stage1_target
from tokenloom.layout import STAGE1, TokenLayout


def text_size(text: str) -> Column:
    return F.when(F.col(text).isNotNull(), F.size(text)).cast("long")


def frame_size(codes: str) -> Column:
    return F.when(F.col(codes)[0].isNotNull(), F.size(F.col(codes)[0])).cast("long")


def batch_shape(samples: DataFrame, batch: str = "batch_id", text: str = "text_tokens",
                codes: str = "codes") -> DataFrame:
    """A3: per batch the longest text, the most frames and the longest ``text + 2T``.

    ``samples`` may hold :func:`text_size` and :func:`frame_size` in place of the arrays.
    """
    array = lambda c: isinstance(samples.schema[c].dataType, ArrayType)
    t = text_size(text) if array(text) else F.col(text)
    c = frame_size(codes) if array(codes) else F.col(codes)
    return samples.groupBy(batch).agg(
        F.max(t).alias("max_text"), F.max(c).alias("max_frames"), F.max(t + 2 * c).alias("max_seq"),
        F.count(F.lit(1)).alias("n_rows"))


def collate(samples: DataFrame, batch: str = "batch_id", layout: TokenLayout = STAGE1,
            max_len: int | None = None, text: str = "text_tokens", codes: str = "codes",
            embedding: str = "embedding") -> DataFrame:
    """T5: pad text (0), embeddings (0) and codes (codebook size) to the batch maximum and
    build first-stage ``input`` / ``target`` of the batch width.

    Batch maxima come from a window partitioned by batch id: one shuffle of the samples,
    and a batch holds at most ``batch size`` rows, so no partition can be skewed.
    ``max_len`` (L2) cuts input/target while they are built.
    """
    w = Window.partitionBy(batch)
    t, c = F.size(text), F.size(F.col(codes)[0])
    shaped = (
        samples.withColumn("_tl_max_text", F.max(t).over(w))
        .withColumn("_tl_max_frames", F.max(c).over(w))
        .withColumn("_tl_max_seq", F.max(t + 2 * c).over(w))
        .withColumn("_tl_max_emb", F.max(F.size(embedding)).over(w))
        .withColumn("_tl_inter", interleave(codes, 2, layout.codebook_size))  # shared by input and target
    )
    return shaped.select(
        *[x for x in samples.columns if x not in (text, codes, embedding)],
        pad_right(text, F.col("_tl_max_text"), 0).alias("text"),
        pad_right(embedding, F.col("_tl_max_emb"), F.lit(0.0).cast("float")).alias("embedding"),
        pad_codes(codes, F.col("_tl_max_frames"), layout.codebook_size).alias("codes"),
        stage1_input(text, codes, F.col("_tl_max_seq"), layout, max_len, "_tl_inter").alias("input"),
        stage1_target(text, codes, F.col("_tl_max_seq"), layout, max_len, "_tl_inter").alias("target"),
    )

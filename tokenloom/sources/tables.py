"""Typed access to the driver tables and the artifact tables derived from them.

The derivations are the fixture formulas of FIXTURES.md section 3; each one is a
projection (or one key join) over a driver table, so its size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.text import normalize_text
from tokenloom.functions.tokens import byte_tokens, token_count
from tokenloom.functions.util import once
from tokenloom.layout import STAGE1, STAGE2, TokenLayout

N_CODEBOOKS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest rows ``(key, text, pos)``: key = source/doc_id, pos = doc_id."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("key"),
        F.col("text"),
        F.col("doc_id").alias("pos"),
    )


def frames_of(doc_id) -> F.Column:
    return (F.lit(30) + F.pmod(doc_id, F.lit(50))).cast("int")


def codes_of(doc_id, n_codebooks: int = N_CODEBOOKS) -> F.Column:
    """Deterministic audio codes ``[n_codebooks, T]`` in 0..1023 for a document id."""
    d = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    t = frames_of(d)
    return F.transform(
        F.sequence(F.lit(0), F.lit(n_codebooks - 1)),
        lambda b: F.transform(F.sequence(F.lit(0), t - 1),
                              lambda f: F.pmod(d * 31 + b * 17 + f * 7, F.lit(1024)).cast("int")),
    )


def text_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(key, pos, length)``: number of byte tokens of the whole normalised text, without making them."""
    return manifest(spark, sf_dir).select("key", "pos", token_count(normalize_text("text")).alias("length"))


def code_artifact(spark: SparkSession, sf_dir: str, by_key: bool = False) -> DataFrame:
    """``tok`` artifact: ``(key, codes array<array<int>>)``.

    ``by_key=True`` hash-partitions on ``key`` first, so a following key join ships
    only ids through the shuffle and builds the code matrices afterwards.
    """
    d = table(spark, sf_dir, "documents").select(
        F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("key"), "doc_id")
    if by_key:
        d = d.repartition("key")
    return d.select("key", codes_of("doc_id").alias("codes"))


def text_token_artifact(spark: SparkSession, sf_dir: str, layout: TokenLayout = STAGE1,
                        by_key: bool = False) -> DataFrame:
    """``txt`` artifact: byte tokens of the whole normalised text, ``(key, tokens array<int>)``.

    ``by_key=True`` hash-partitions the raw text on ``key`` before tokenising: the shuffle
    a key join needs anyway then carries text (1 byte per token) instead of int arrays.
    """
    m = manifest(spark, sf_dir).select("key", "text")
    if by_key:
        m = m.repartition("key")
    return m.select("key", byte_tokens(normalize_text("text"), layout).alias("tokens"))


def embedding_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``emb`` artifact: ``(key, embedding array<float>)`` for documents with a vector."""
    e = table(spark, sf_dir, "embeddings")
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    return e.join(d, e.vec_id == d.doc_id, "inner").select(
        F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("key"),
        F.col("embedding"),
    )


def generated_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-stage generated sequences ``(pos, tokens)``: text ++ interleaved codes ++ [2048],
    then ``doc_id % 3`` extra band-0 values so the two bands differ in length."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select(F.col("doc_id").alias("pos"), generated_of("doc_id", "text").alias("tokens"))


def generated_of(doc_id: str, text: str) -> F.Column:
    """The sequence of :func:`generated_tokens` of one document; made after a join, so that the join carries its text instead."""
    return generated_from(doc_id, byte_tokens(normalize_text(text), STAGE1))


def generated_from(doc_id: str, txt: F.Column) -> F.Column:
    """:func:`generated_of` from the text's tokens."""
    from tokenloom.functions.tokens import interleave, repeat

    extra = repeat(F.pmod(F.col(doc_id), F.lit(1024)).cast("int"), F.pmod(F.col(doc_id), F.lit(3)).cast("int"))
    return F.concat(txt, interleave(codes_of(doc_id)), F.array(F.lit(STAGE1.eoa)), extra)


def tilted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second-stage hierarchy rows ``(pos, rows)``: row 0 = text ++ c0 ++ [1024], row b = c_b ++ [1024];
    row 1 is shortened by ``doc_id % 4`` so hierarchies differ in length."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    txt = byte_tokens(normalize_text("text"), STAGE2)
    c = codes_of("doc_id")
    short = F.pmod(F.col("doc_id"), F.lit(4)).cast("int")
    eoa = F.array(F.lit(STAGE2.eoa))
    rows = once(txt, lambda t: F.transform(
        c,
        lambda row, b: F.when(b == 0, F.concat(t, row, eoa))
        .when(b == 1, F.slice(F.concat(row, eoa), F.lit(1), F.size(row) + 1 - short))
        .otherwise(F.concat(row, eoa)),
    ))
    return d.select(F.col("doc_id").alias("pos"), rows.alias("rows"))


def scores(spark: SparkSession, sf_dir: str, reverse: bool = False) -> DataFrame:
    """Logit table ``(grp, item, logit double)``: one group per vector, 64 items."""
    e = table(spark, sf_dir, "embeddings")
    vals = F.reverse("embedding") if reverse else F.col("embedding")
    return e.select(F.col("vec_id").alias("grp"), F.posexplode(vals).alias("item", "logit")).select(
        "grp", F.col("item").cast("int").alias("item"), F.col("logit").cast("double").alias("logit"))


def partial_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial embeddings ``(key, part, vec)`` with key = label, part = vec_id."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("label").cast("string").alias("key"), F.col("vec_id").alias("part"),
                    F.col("embedding").alias("vec"))


def losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-rank loss log ``(rank, batch_id, step, name, value)`` from ``events``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("step"),
        F.pmod(F.col("event_id"), F.lit(4)).cast("int").alias("rank"),
        F.floor(F.col("event_id") / 32).cast("long").alias("batch_id"),
        F.col("event_type").alias("name"),
        F.col("value"),
    )


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Utterance lengths ``(utt_id, sample_rate, n_samples)`` from ``events``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("utt_id"),
        F.lit(16000).alias("sample_rate"),
        (F.lit(8000) + F.pmod(F.col("event_id") * 377, F.lit(400000))).cast("long").alias("n_samples"),
    )


def token_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long logits table ``(row, head, t, target, item, logit)``: one scored position per vector,
    target -1 (ignored) when ``vec_id % 5 = 0`` else ``vec_id % 64``."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("row"),
        F.pmod(F.col("vec_id"), F.lit(2)).cast("int").alias("head"),
        F.floor(F.col("vec_id") / 2).cast("int").alias("t"),
        F.when(F.pmod(F.col("vec_id"), F.lit(5)) == 0, F.lit(-1))
        .otherwise(F.pmod(F.col("vec_id"), F.lit(64))).cast("int").alias("target"),
        F.posexplode("embedding").alias("item", "logit"),
    ).select("row", "head", "t", "target", F.col("item").cast("int").alias("item"),
             F.col("logit").cast("double").alias("logit"))


def run_log(spark: SparkSession, sf_dir: str, model_bytes: int = 2_400_000_000, day: bool = False) -> DataFrame:
    """Generation run log ``(tokens, seconds, model_bytes, audio_seconds)`` from ``lineitem``, with the ``day`` of the run if asked for."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_quantity").cast("long").alias("tokens"),
        (F.lit(1.0) + F.col("l_discount")).alias("seconds"),
        F.lit(model_bytes).cast("long").alias("model_bytes"),
        (F.col("l_quantity") / 75.0).alias("audio_seconds"),
        *([F.col("l_shipdate").alias("day")] if day else []),
    )

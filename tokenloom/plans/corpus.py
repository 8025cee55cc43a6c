"""Corpus preparation and speaker vectors as whole plans."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.functions.text import normalize_text
from tokenloom.functions.tokens import byte_tokens
from tokenloom.operators.joins import pending
from tokenloom.operators.models import map_model
from tokenloom.operators.position import tail_split, with_position
from tokenloom.operators.vectors import speaker_embedding, utterance_embedding
from tokenloom.sources import audio as AU
from tokenloom.sources import files as FS


def prepare_corpus(spark: SparkSession, tsv: str, out: str, val_size: int = 500) -> None:
    """S1 -> O1 -> J2 -> tokens -> S6 -> O3 -> S3: a TSV manifest to stored tokens and split files.

    Rows without text go to ``quarantine``; the others are numbered in key order. Tokens of keys that the
    store lacks are made and stored; each split is written as JSON lines under ``splits/split=<name>``.
    """
    good, bad = FS.quarantine(FS.read_tsv_manifest(spark, tsv))
    FS.write_jsonl(bad, os.path.join(out, "quarantine"))
    rows = FS.stage(with_position(good, ["key"]), "manifest")
    todo = rows
    if FS.path_exists(spark, os.path.join(out, "txt")):
        todo = pending(rows, FS.read_artifact(spark, out, "txt"))
    FS.write_artifact(todo.select("key", byte_tokens(normalize_text("text")).alias("tokens")), out, "txt")
    split = tail_split(rows, val_size, "disjoint")
    split.write.mode("overwrite").partitionBy("split").option("ignoreNullFields", "false").json(os.path.join(out, "splits"))


def speaker_vectors(audio: DataFrame, loader: Callable[[], object], fn, speaker: str = "speaker", key: str = "key") -> DataFrame:
    """S5 rows -> mono 16 kHz (U3) -> trim (U4) -> pad (T21) -> mel (U5) -> segments (U6) -> model
    -> utterance mean and unit norm (A4) -> speaker mean and unit norm (A5)."""
    waves = AU.trim_audio(AU.resample_audio(audio.where("error is null"), 16000, "mean", keep=[key]))
    parts = map_model(AU.partial_mels(waves.select(key, "wave"), key=key), loader, fn, "vec", T.ArrayType(T.DoubleType()), keep=[key])
    utterances = utterance_embedding(parts.where("vec_error is null"), key, "vec")
    return speaker_embedding(utterances.join(audio.select(key, speaker), key), speaker)

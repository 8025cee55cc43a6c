"""Request preparation shared by batch and stream, dead-letter routing.

The same column code runs on a batch DataFrame and on a ``readStream`` file source;
the stream is stateless (no watermark needed) and joins a static preset table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import requests as R
from tokenloom.functions.text import normalize_text
from tokenloom.operators.joins import resolve_preset
from tokenloom.sources.files import path_exists
from tokenloom.sources.requests import PRESET_NAMES

REQUEST_FILE_SCHEMA = "conv_id long, turn long, payload string"


def prepare_requests(df: DataFrame, presets: DataFrame, max_chars: int | None = None, keep: tuple = ()) -> DataFrame:
    """S8 -> P9 -> P11 -> J6 -> P1 for batch or streaming input ``(conv_id, turn, payload)``.

    Requests without a reference path get the preset voice chosen by ``conv_id % 4``.
    ``error`` carries the first failure (parse, then validation); failed rows keep flowing.
    ``max_chars`` cuts texts as the UI does; the server takes them whole. Columns named in ``keep`` pass through.
    """
    text = F.col("text") if max_chars is None else R.cut_text("text", max_chars)
    parsed = df.select("conv_id", "turn", *keep, R.parse_request("payload").alias("r")).select("conv_id", "turn", *keep, "r.*")
    preset = F.element_at(F.array(*[F.lit(n) for n in PRESET_NAMES]), (F.pmod("conv_id", F.lit(4)) + 1).cast("int"))
    tagged = parsed.withColumn("preset", preset)
    joined = resolve_preset(tagged, presets)
    return joined.select(
        "conv_id", "turn", *keep,
        normalize_text(text).alias("text"),
        "guidance", "top_p", "top_k",
        F.coalesce(F.col("speaker_ref_path"), F.col("url")).alias("reference"),
        F.coalesce(F.col("error"), R.validation_error("text")).alias("error"),
    )


def split_dead_letters(batch: DataFrame, batch_id: int, out_dir: str) -> None:
    """R2 (``foreachBatch``): good rows to ``status=ok``, failed rows to ``status=err``, in one write.

    Each micro-batch writes its own ``batch=<id>`` folder in overwrite mode, so a
    replayed batch replaces its earlier output instead of duplicating it.
    """
    status = F.when(F.col("error").isNull(), "ok").otherwise("err")
    (batch.withColumn("status", status).write.mode("overwrite").partitionBy("status")
     .parquet(os.path.join(out_dir, f"batch={batch_id}")))


def stream_prepare_requests(spark: SparkSession, src_dir: str, out_dir: str, checkpoint: str,
                            presets: DataFrame) -> None:
    """R1 + R2: process every request file present under ``src_dir`` once, then stop
    (``availableNow``); the checkpoint remembers processed files across runs."""
    stream = spark.readStream.schema(REQUEST_FILE_SCHEMA).json(src_dir)
    q = (prepare_requests(stream, presets).writeStream
         .foreachBatch(lambda b, i: split_dead_letters(b, i, out_dir))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_outputs(spark: SparkSession, out_dir: str, which: str) -> DataFrame:
    return spark.read.parquet(out_dir).where(F.col("status") == which).drop("status")


# ---------------------------------------------------------------- each request once

ONCE_SCHEMA = f"{REQUEST_FILE_SCHEMA}, request_id string, event_time timestamp"
LATE = "late: older than the watermark"


def stream_requests_once(spark: SparkSession, src_dir: str, out_dir: str, checkpoint: str, presets: DataFrame, delay: str = "1 day") -> None:
    """R1 + R2 with each ``request_id`` answered once: files dropped again add nothing.

    Ids are kept in the stream's state until the watermark (``delay`` behind the latest ``event_time``) has passed them. Rows behind the
    watermark are not answered; a second pass over the new files finds those whose id has no output and routes them to the dead
    letters (``status=late``) with a reason. Rows without an id or event time are dead letters of that pass too.
    """
    def read():
        return spark.readStream.schema(ONCE_SCHEMA).json(src_dir)

    def run(df: DataFrame, write, name: str) -> None:
        q = (df.writeStream.foreachBatch(write).option("checkpointLocation", os.path.join(checkpoint, name))
             .trigger(availableNow=True).start())
        q.awaitTermination()

    def answer(batch: DataFrame, batch_id: int) -> None:
        ids = batch.select("conv_id", "turn", "payload", "request_id")
        done = prepare_requests(ids, presets, keep=("request_id",))
        split_dead_letters(done, batch_id, os.path.join(out_dir, "answers"))

    def rest(batch: DataFrame, batch_id: int) -> None:
        answers = os.path.join(out_dir, "answers")
        rows = batch.dropDuplicates(["request_id", "conv_id", "turn", "event_time"])
        if path_exists(spark, answers):
            rows = rows.join(spark.read.parquet(answers).select("request_id"), "request_id", "left_anti")
        reason = F.when(F.col("request_id").isNull(), "no request id").when(F.col("event_time").isNull(), "no event time").otherwise(LATE)
        (rows.select("conv_id", "turn", "request_id", "payload", reason.alias("error")).write.mode("overwrite")
         .parquet(os.path.join(out_dir, "late", f"batch={batch_id}")))

    whole = F.col("request_id").isNotNull() & F.col("event_time").isNotNull()
    run(read().where(whole).withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["request_id"]), answer, "answers")
    run(read(), rest, "late")


def read_once(spark: SparkSession, out_dir: str) -> DataFrame:
    """``(conv_id, turn, request_id, status, error)`` of every request that arrived: ok, err or late."""
    cols = ("conv_id", "turn", "request_id", "status", "error")
    answers = spark.read.parquet(os.path.join(out_dir, "answers")).select(*cols)
    late = spark.read.parquet(os.path.join(out_dir, "late")).withColumn("status", F.lit("late"))
    return answers.unionByName(late.select(*cols))

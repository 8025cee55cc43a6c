"""Incremental corpus preparation: new manifest files processed once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tokenloom.functions.text import normalize_text
from tokenloom.functions.tokens import byte_tokens
from tokenloom.sources.files import MANIFEST_SCHEMA, write_artifact
from tokenloom.sources.keyindex import KeyedStore


def tokenise_batch(batch: DataFrame, store: str) -> None:
    """``foreachBatch`` body: first row per key wins (O7), keys already stored are skipped."""
    firsts = batch.groupBy("key").agg(F.min_by(F.col("text"), F.col("pos")).alias("text"))
    tokens = firsts.select("key", byte_tokens(normalize_text("text")).alias("tokens"))
    write_artifact(tokens, store, "txt", unique=True)  # the groups have made keys unique


def tokenise_indexed(batch: DataFrame, store: str) -> None:
    """``foreachBatch`` body over an indexed store: only files that may hold a key of the batch are read."""
    target = KeyedStore(batch.sparkSession, store, "txt")
    new = target.pending(batch.groupBy("key").agg(F.min_by(F.col("text"), F.col("pos")).alias("text")))
    target.add(new.select("key", byte_tokens(normalize_text("text")).alias("tokens")))


def append_tokens(batch: DataFrame, batch_id: int, store: str) -> None:
    """``foreachBatch`` body for state-deduplicated input: tokenise into the batch's own folder,
    which a replay replaces."""
    tokens = batch.select("key", byte_tokens(normalize_text("text")).alias("tokens"))
    tokens.write.mode("overwrite").parquet(f"{store.rstrip('/')}/txt/run=batch-{batch_id}")


def _first_seen(key: tuple, batches, state: GroupState):
    """The lowest-position row of a key the first time it is seen, nothing later."""
    best = None
    for pdf in batches:
        row = pdf if len(pdf) == 1 else pdf.sort_values("pos", kind="stable").iloc[:1]  # most keys come once
        if best is None or row["pos"].iloc[0] < best["pos"].iloc[0]:
            best = row
    if not state.exists and best is not None:
        state.update((True,))
        yield best[["key", "text", "pos"]]


def stream_text_tokens(spark: SparkSession, manifest_dir: str, store: str, checkpoint: str,
                       dedupe: str = "table") -> None:
    """Tokenise manifest JSON-lines files as they arrive; each file once (checkpoint),
    each key once, the first by ``pos`` within a micro-batch.

    ``dedupe="table"``: an anti join against the stored keys (reads only the key column of the store).
    ``dedupe="index"``: the same join, over the files of an indexed store whose key ranges and Bloom filters let a key of the batch in.
    ``dedupe="state"``: keys seen so far live in the streaming state store, one flag each, so a batch never
    rescans the store. The state grows with the number of keys; use the RocksDB state store for large corpora.
    """
    stream = spark.readStream.schema(MANIFEST_SCHEMA).json(manifest_dir)
    if dedupe == "state":
        firsts = stream.groupBy("key").applyInPandasWithState(
            _first_seen, MANIFEST_SCHEMA, "seen boolean", "append", GroupStateTimeout.NoTimeout)
        w = firsts.writeStream.outputMode("append").foreachBatch(lambda b, i: append_tokens(b, i, store))
    elif dedupe == "table":
        w = stream.writeStream.foreachBatch(lambda b, i: tokenise_batch(b, store))
    elif dedupe == "index":
        w = stream.writeStream.foreachBatch(lambda b, i: tokenise_indexed(b, store))
    else:
        raise ValueError(f"unknown dedupe mode {dedupe!r}")
    q = w.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()

"""R3/O7 with the first position of every key in the streaming state: no store is read, and a lower position that comes later is seen.

The state is one number per key in RocksDB, checkpointed with the stream; it grows with the keys and doesn't expire. The first row of a key goes on as ``first``; a
row with a lower position than the stored one is reported as ``earlier`` with that position, which it replaces.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tokenloom.functions.text import normalize_text
from tokenloom.functions.tokens import byte_tokens
from tokenloom.sources.files import MANIFEST_SCHEMA

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "key string, text string, pos long, kind string, stored long"


class FirstPosition(StatefulProcessor):
    """Rows ``(key, text, pos)`` of a key in any order; see the module text."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "pos long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = None
        for row in rows:
            if best is None or row["pos"] < best["pos"]:
                best = row
        if best is None:
            return
        pos = best["pos"]
        stored = int(self.first.get()[0]) if self.first.exists() else None
        if stored is None or pos < stored:
            self.first.update((pos,))
            yield Row(key=key[0], text=best["text"], pos=pos, kind="first" if stored is None else "earlier", stored=stored)

    def close(self) -> None:
        pass


def write_firsts(batch: DataFrame, batch_id: int, store: str) -> None:
    """``foreachBatch`` body: tokens of first rows and reports of earlier ones, in folders of the batch that a replay replaces."""
    base, run = store.rstrip("/"), f"run=batch-{batch_id}"
    rows = batch.select("key", "pos", "kind", "stored", byte_tokens(normalize_text("text")).alias("tokens")).persist()
    try:
        rows.where("kind = 'first'").select("key", "pos", "tokens").write.mode("overwrite").parquet(os.path.join(base, "txt", run))
        rows.where("kind = 'earlier'").select("key", "pos", "stored", "tokens").write.mode("overwrite").parquet(
            os.path.join(base, "earlier", run))
    finally:
        rows.unpersist()


def stream_first_positions(spark: SparkSession, manifest_dir: str, store: str, checkpoint: str) -> None:
    """Tokenise manifest JSON-lines files as they arrive, each key once; ``store/txt`` gets the first row of each key, ``store/earlier``
    rows with a lower position than the one known.

    Rows need a key and a position; rows without one are left out (see S1/S2's quarantine).
    """
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        rows = spark.readStream.schema(MANIFEST_SCHEMA).json(manifest_dir).where("key is not null and pos is not null")
        firsts = rows.groupBy("key").transformWithState(
            FirstPosition(), OUTPUT, "append", "none")
        q = (firsts.writeStream.outputMode("append").foreachBatch(lambda b, i: write_firsts(b, i, store))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)

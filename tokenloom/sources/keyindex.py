"""A store of keyed rows that can tell which of its files may hold a key.

Each run writes one folder, range-partitioned and sorted by key, with a Parquet Bloom filter on the key column, and
one index row per file: its smallest and largest key and its rows. A resume tests the new keys against these ranges where the keys
are, reads only the files that may hold one, and finishes with an exact anti join. A batch of at most ``PUSHED`` keys is pushed into
that scan as well, where row-group statistics and Bloom filters skip what is left. ``compact`` rewrites all
runs as one with disjoint file ranges.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.sources.files import move, path_exists, stage

#: Keys of a batch that are pushed into the scan; above it file ranges and the join decide alone.
PUSHED = 5_000
#: Files whose ranges a worker holds (about 100 bytes each); a store with more has to be compacted.
MAX_FILES = 1_000_000
#: Most rows of a file, and most bytes of it as Parquet: one task sorts and writes a file.
ROWS_PER_FILE = 1_000_000
BYTES_PER_FILE = 64 << 20


@dataclass(frozen=True)
class KeyedStore:
    """``kind`` rows under ``base``, at most one per ``key`` (not null). One writer at a time."""

    spark: SparkSession
    base: str
    kind: str
    key: str = "key"

    @property
    def _rows(self) -> str:
        return os.path.join(self.base, self.kind)

    @property
    def _index(self) -> str:
        return os.path.join(self.base, f"{self.kind}.index")

    def exists(self) -> bool:
        return path_exists(self.spark, self._index)

    def files(self) -> DataFrame:
        """``(file, low, high, n, run)``: one row per stored file."""
        return self.spark.read.parquet(self._index)

    def read(self) -> DataFrame:
        """All stored rows."""
        return self.spark.read.parquet(self._rows).drop("run")

    def _write(self, df: DataFrame, run: str, n: int) -> None:
        """Store ``df``, rows read from files, as one run."""
        staged = os.path.join(self.base, f"_{self.kind}-{run}")
        size = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).distinct().agg(F.sum("s")).first()[0] or 0
        n_files = max(1, -(-n // ROWS_PER_FILE), min(-(-size // BYTES_PER_FILE), n))
        # as many keys as an even share has, and as many again for a range that comes out larger
        keys = min(2 * -(-max(n, 1) // n_files), ROWS_PER_FILE) if n_files > 1 else min(max(n, 1), ROWS_PER_FILE)
        (df.repartitionByRange(n_files, self.key).sortWithinPartitions(self.key).write
         .option(f"parquet.bloom.filter.enabled#{self.key}", "true")
         .option(f"parquet.bloom.filter.expected.ndv#{self.key}", str(keys))
         .parquet(staged))
        ranges = (self.spark.read.schema(df.schema).parquet(staged).groupBy(F.col("_metadata.file_name").alias("file"))
                  .agg(F.min(self.key).alias("low"), F.max(self.key).alias("high"), F.count(F.lit(1)).alias("n")))
        index = os.path.join(self.base, f"_{self.kind}.index-{run}")
        ranges.coalesce(1).write.parquet(index)
        # rows first: a run without an index row is not part of the store
        move(self.spark, staged, os.path.join(self._rows, f"run={run}"))
        move(self.spark, index, os.path.join(self._index, f"run={run}"))

    def candidates(self, keys: DataFrame) -> list[str]:
        """Paths of the files whose key range holds one of ``keys`` (its first column)."""
        if not self.exists():
            return []
        # a run whose index was not moved into place is not read
        rows = self.files().limit(MAX_FILES + 1).select("file", "low", "high", F.col("run").cast("string")).collect()
        if len(rows) > MAX_FILES:
            raise ValueError(f"{self._index} lists more than {MAX_FILES} files; compact the store")
        if not rows:
            return []
        held = self.spark.sparkContext.broadcast(([r["low"] for r in rows], [r["high"] for r in rows]))

        def run(batches):
            low, high = (np.array(x, dtype=object) for x in held.value)
            hit = np.zeros(len(low), bool)
            for b in batches:
                own = np.sort(np.array(b.column(0).drop_null().to_pylist(), dtype=object))
                hit |= np.searchsorted(own, low, "left") < np.searchsorted(own, high, "right")
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(hit), pa.int32())], names=["i"])

        hits = keys.select(keys.columns[0]).mapInArrow(run, "i int").distinct().collect()
        return sorted(os.path.join(self._rows, f"run={rows[r['i']]['run']}", rows[r["i"]]["file"]) for r in hits)

    def _holding(self, keys: DataFrame, columns: list[str]) -> DataFrame | None:
        """Stored rows that may have one of ``keys`` (staged, distinct), or None if no file may."""
        paths = self.candidates(keys)
        if not paths:
            return None
        schema = self.read().schema
        d = self.spark.read.schema(schema).parquet(*paths).select(*columns)
        few = keys.limit(PUSHED + 1).collect()
        return d.where(F.col(self.key).isin([r[0] for r in few])) if len(few) <= PUSHED else d

    def _keys(self, df: DataFrame) -> DataFrame:
        return stage(df.select(self.key).where(F.col(self.key).isNotNull()).distinct(), "keys")

    def pending(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` whose key is not stored; rows without a key are pending."""
        held = self._holding(self._keys(df), [self.key])
        return df if held is None else df.join(held, self.key, "left_anti")

    def lookup(self, df: DataFrame, columns: list[str]) -> DataFrame:
        """``df`` with ``columns`` of the stored row of its key, and ``stored`` (whether there is one)."""
        held = self._holding(self._keys(df), [self.key, *columns])
        if held is None:
            kinds = {c: self.read().schema[c].dataType if self.exists() else "string" for c in columns}
            return df.withColumns({**{c: F.lit(None).cast(t) for c, t in kinds.items()}, "stored": F.lit(False)})
        d = df.join(held.withColumn("stored", F.lit(True)), self.key, "left")
        return d.withColumn("stored", F.coalesce("stored", F.lit(False)))

    def add(self, df: DataFrame) -> int:
        """Store the rows of ``df`` whose key is not stored yet, the first by ``pos`` (if there is one) of each key; returns their number.

        Rows without a key are not stored.
        """
        from tokenloom.operators.position import first_wins

        new = self.pending(df.where(F.col(self.key).isNotNull()))
        new = first_wins(new, self.key, "pos") if "pos" in df.columns else new.dropDuplicates([self.key])
        new = stage(new, f"new-{self.kind}")
        n = new.count()
        if n:
            self._write(new, uuid.uuid4().hex[:12], n)
        return n

    def compact(self) -> "KeyedStore":
        """A store of the same rows in one run, in a folder of its own; the old one stays as it is."""
        out = KeyedStore(self.spark, os.path.join(self.base, f"compact-{uuid.uuid4().hex[:8]}"), self.kind, self.key)
        if self.exists():
            d = self.read()
            out._write(d, uuid.uuid4().hex[:12], d.count())
        return out


def memoize_in(store: KeyedStore, df: DataFrame, compute, value: str) -> DataFrame:
    """J3 over an indexed store: ``df`` with ``value`` and ``cache_hit``; misses go through ``compute`` and are stored.

    ``compute`` gets rows of ``df`` whose key isn't stored and returns them with ``value`` added.
    """
    d = stage(store.lookup(df, [value]), "memo")
    hits = d.where("stored").drop("stored").withColumn("cache_hit", F.lit(True))
    made = stage(compute(d.where("not stored").drop("stored", value)), "made")
    store.add(made.select(store.key, value))
    return hits.select(*df.columns, value, "cache_hit").unionByName(
        made.withColumn("cache_hit", F.lit(False)).select(*df.columns, value, "cache_hit"))

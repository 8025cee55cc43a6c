"""O1 over a growing manifest: new rows are numbered after the old ones, which keep their positions."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators.position import with_position
from tokenloom.sources.files import move, path_exists, stage


@dataclass(frozen=True)
class PositionLog:
    """Stored dense positions of ``key`` (unique, not null) under ``base``: a folder of rows and one total per append.

    An append numbers its own rows only and adds the stored totals to them; no stored row is read but the keys, and none is written
    again. An append that fails leaves nothing. One writer at a time.
    """

    spark: SparkSession
    base: str
    key: str = "key"

    def _folder(self, name: str) -> str:
        return os.path.join(self.base, name)

    def totals(self) -> DataFrame:
        """``(start, n, run)`` of every append."""
        return self.spark.read.parquet(self._folder("totals"))

    def size(self) -> int:
        """Rows numbered so far."""
        return (self.totals().agg(F.sum("n")).first()[0] or 0) if path_exists(self.spark, self._folder("totals")) else 0

    def read(self) -> DataFrame:
        """Stored rows with ``pos``, of appends whose total is stored."""
        rows = self.spark.read.parquet(self._folder("rows"))
        return rows.join(F.broadcast(self.totals().select("run")), "run", "left_semi").drop("run")

    def append(self, df: DataFrame, order) -> int:
        """Number the rows of ``df`` whose key is not stored yet, in ``order``, after all stored ones; returns how many there are.

        ``order`` must be total within ``df`` (see O1).
        """
        start = self.size()
        if start:
            df = df.join(self.read().select(self.key), self.key, "left_anti")
        new = stage(with_position(df, order, out="pos"), "append")
        n = new.count()
        if not n:
            return 0
        run = uuid.uuid4().hex[:12]
        rows, total = self._folder(f"_rows-{run}"), self._folder(f"_totals-{run}")
        new.withColumn("pos", F.col("pos") + F.lit(start)).write.parquet(rows)
        self.spark.createDataFrame([(start, n)], "start long, n long").coalesce(1).write.parquet(total)
        move(self.spark, rows, os.path.join(self._folder("rows"), f"run={run}"))
        move(self.spark, total, os.path.join(self._folder("totals"), f"run={run}"))
        return n

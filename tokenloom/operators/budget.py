"""O6/A11 by tokens: consecutive batches of at most a budget of tokens, cut greedily without one task walking the corpus.

A batch takes rows in order while their lengths sum up to the budget; a row longer than the budget is a batch of its own. Where a range
of rows is cut depends on what came before only through the tokens in the batch that is open at its start. So a range is summed up as a function
from those tokens to (cuts inside, tokens open at its end), which is a step function with one step per row of its first
budget of tokens. Functions of ``FAN`` neighbours are composed in a task, level by level, up to one; back down, every range gets
its true start, and cuts its rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.operators import position
from tokenloom.sources.files import stage

FAN = 64


class Steps:
    """What a run of rows does to the tokens ``u`` of the open batch (budget + 1: more than the budget, or no open batch).

    With ``ends`` the sums of lengths up to each row, the first cut is before the first row with ``u + ends > budget``. After a cut
    there, ``cuts`` batches begin and ``open`` tokens are in the last one. ``total`` is the sum of all lengths.
    """

    def __init__(self, budget: int, ends, cuts, open_, total: int):
        self.budget, self.total = budget, int(total)
        self.ends, self.cuts, self.open = (np.asarray(x, np.int64) for x in (ends, cuts, open_))

    @classmethod
    def of(cls, lengths: np.ndarray, budget: int) -> "Steps":
        ends = np.cumsum(lengths)
        follow = _follow(lengths, ends, budget)
        # rows that can be the first cut: of equal sums the first, up to the first sum above the budget
        can = np.flatnonzero(np.r_[True, ends[1:] > ends[:-1]][:len(ends)])
        can = can[:np.searchsorted(ends[can], budget, "right") + 1]
        at, last, cuts = can.copy(), can.copy(), np.zeros(len(can), np.int64)
        while (on := at < len(lengths)).any():
            last[on] = at[on]
            cuts[on] += 1
            at[on] = follow[at[on]]
        total = int(ends[-1]) if len(ends) else 0
        open_ = total - (ends[last] - lengths[last])
        return cls(budget, ends[can], cuts, np.minimum(open_, budget + 1), total)

    def apply(self, u) -> tuple:
        """(open tokens, cuts) for an array of ``u``."""
        u = np.asarray(u, np.int64)
        j = np.searchsorted(self.ends, self.budget - u, "right")
        hit = j < len(self.ends)
        k = np.where(hit, j, 0)
        through = np.minimum(u + self.total, self.budget + 1)
        if not len(self.ends):
            return through, np.zeros(len(u), np.int64)
        return np.where(hit, self.open[k], through), np.where(hit, self.cuts[k], 0)

    def then(self, other: "Steps") -> "Steps":
        out, more = other.apply(self.open)
        past = other.ends + self.total
        past_on = np.flatnonzero(past > (self.ends[-1] if len(self.ends) else -1))
        if len(self.ends) and self.ends[-1] > self.budget:
            past_on = past_on[:0]
        past_on = past_on[:np.searchsorted(past[past_on], self.budget, "right") + 1]
        return Steps(self.budget, np.r_[self.ends, past[past_on]], np.r_[self.cuts + more, other.cuts[past_on]],
                     np.r_[out, other.open[past_on]], self.total + other.total)


def _follow(lengths: np.ndarray, ends: np.ndarray, budget: int) -> np.ndarray:
    """Row at which the batch that begins at each row is cut."""
    return np.maximum(np.searchsorted(ends, ends - lengths + budget, "right"), np.arange(len(ends)) + 1)


_FUNCTION = "node long, ends array<long>, cuts array<long>, open array<long>, total long"


def _row(node: int, s: Steps) -> pd.DataFrame:
    return pd.DataFrame({"node": [node], "ends": [s.ends], "cuts": [s.cuts], "open": [s.open], "total": [s.total]})


def budget_batches(df: DataFrame, budget: int, length: str, order, key: str, out: str = "batch_id") -> DataFrame:
    """``(key, length, batch_id)``: rows in ``order`` (ending in a unique column) cut into batches of at most ``budget`` tokens.

    Lengths are whole numbers from 0, not null. Only key, order and length are handled; join the payload on ``key``.
    """
    spark = df.sparkSession
    keys = position._cols(order)
    names = [f"_tl_k{i}" for i in range(len(keys))]
    narrow = stage(df.select(F.col(key).alias("_tl_key"), F.col(length).cast("long").alias("_tl_len"), *[
        k.alias(n) for k, n in zip(keys, names)]), "budget")
    n_ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-narrow.count() // position.ROWS_PER_RANGE))
    ranged = stage(narrow.repartitionByRange(n_ranges, *names).sortWithinPartitions(*names)
                   .withColumn("node", F.spark_partition_id().cast("long")), "ranges")
    rows = stage(ranged.withColumn("i", F.row_number().over(Window.partitionBy("node").orderBy(*names)))
                 .select("node", "i", "_tl_key", "_tl_len"), "rows")

    def summed(pdf: pd.DataFrame) -> pd.DataFrame:
        return _row(int(pdf["node"].iloc[0]), Steps.of(pdf.sort_values("i")["_tl_len"].to_numpy(np.int64), budget))

    def steps(r) -> Steps:
        return Steps(budget, r.ends, r.cuts, r.open, r.total)

    fan = FAN

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, whole = pdf.sort_values("node"), None
        for r in pdf.itertuples():
            whole = steps(r) if whole is None else whole.then(steps(r))
        return _row(int(pdf["node"].iloc[0]) // fan, whole)

    def descend(pdf: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        u, at, out_ = int(start["u"].iloc[0]), int(start["batch"].iloc[0]), []
        for r in pdf.sort_values("node").itertuples():
            out_.append((r.node, u, at))
            (u,), (cuts,) = steps(r).apply([u])
            u, at = int(u), at + int(cuts)
        return pd.DataFrame(out_, columns=["node", "u", "batch"])

    levels = [stage(rows.select("node", "i", "_tl_len").groupBy("node").applyInPandas(summed, _FUNCTION), "steps")]
    parent = F.floor(F.col("node") / fan).cast("long")
    while levels[-1].where("node > 0").head(1):
        levels.append(stage(levels[-1].groupBy(parent.alias("up")).applyInPandas(compose, _FUNCTION), "steps"))
    # nothing is open before the first row
    starts = spark.createDataFrame([(0, budget + 1, -1)], "node long, u long, batch long")
    for level in reversed(levels[:-1]):
        starts = stage(level.withColumn("up", parent).groupBy("up").cogroup(starts.withColumnRenamed("node", "up").groupBy("up"))
                       .applyInPandas(descend, "node long, u long, batch long"), "starts")
    kind = df.schema[key].dataType.simpleString()

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i")
        lengths = pdf["_tl_len"].to_numpy(np.int64)
        ends = np.cumsum(lengths)
        follow = _follow(lengths, ends, budget)
        new = np.zeros(len(pdf), np.int64)
        at = int(np.searchsorted(ends, budget - int(pdf["u"].iloc[0]), "right"))
        while at < len(pdf):
            new[at] = 1
            at = int(follow[at])
        return pd.DataFrame({"_tl_key": pdf["_tl_key"], "_tl_len": lengths, "batch": pdf["batch"] + np.cumsum(new)})

    made = rows.join(starts, "node").groupBy("node").applyInPandas(cut, f"_tl_key {kind}, _tl_len long, batch long")
    return made.select(F.col("_tl_key").alias(key), F.col("_tl_len").alias(length), F.col("batch").alias(out))

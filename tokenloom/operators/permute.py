"""O5 without a sort: a keyed permutation of 0..n-1 as a projection.

A position is split as (l, r) over an a x b grid just larger than n; rounds add a hash of one half to the other modulo its size
(a Feistel network), which can be undone and so hits every cell once. A cell beyond n goes round again until it falls
below n (cycle walking), which keeps it a permutation of 0..n-1. Rows stay where they are: no sort and no shuffle.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.util import col_of
from tokenloom.operators.position import dense_count, fixed_batches

ROUNDS = 6  # even, so that the halves end where they began


def grid(n: int) -> tuple[int, int]:
    """Sides a, b with a * b >= n and less than a cells too many."""
    a = max(1, isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _mix(value: Column, i: Column, epoch: int, seed: int) -> Column:
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(str(epoch)), i.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("long")


def permuted(pos, n: int, epoch: int, seed: int) -> Column:
    """Place of each position 0..n-1 in the order of ``epoch``; another ``epoch`` or ``seed`` is another order."""
    a, b = grid(n)
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(a if i % 2 == 0 else b).cast("long").alias("m")) for i in range(ROUNDS)])

    def once(x: Column) -> Column:
        start = F.struct(F.floor(x / b).cast("long").alias("l"), F.pmod(x, F.lit(b)).cast("long").alias("r"))
        return F.aggregate(steps, start, lambda s, k: F.struct(
            s["r"].alias("l"), F.pmod(s["l"] + _mix(s["r"], k["i"], epoch, seed), k["m"]).alias("r")), lambda s: s["l"] * b + s["r"])

    # less than a cells lie beyond n, so a walk through them alone has less than a steps; 40 steps have a chance below 40^-40
    walk = F.sequence(F.lit(1), F.lit(min(a, 40)))
    x = col_of(pos).cast("long")
    end = F.aggregate(walk, once(x), lambda y, _: F.when(y < n, y).otherwise(once(y)))
    return F.aggregate(F.array(end), F.lit(0).cast("long"), lambda _, y: F.when(y < n, y).otherwise(
        F.raise_error(F.lit("no place found for a position")).cast("long")))


def permuted_batches(df: DataFrame, size: int, epoch: int, seed: int, pos: str = "pos", out: str = "batch_id",
                     order_out: str = "shuffled_pos", n_rows: int | None = None) -> DataFrame:
    """O5 then O4 on rows with dense positions: a projection, whatever the size of the rows.

    Unless ``n_rows`` is given, positions are counted and checked to be dense first.
    """
    n = dense_count(df, pos) if n_rows is None else n_rows
    return fixed_batches(df.withColumn(order_out, permuted(pos, n, epoch, seed)), size, pos=order_out, out=out)

"""Manifest order: dense positions, shards, splits, batches, first-wins.

Dense global positions are the one operator every shard, split and batch depends on.
They take the same path at every size, with no single-partition window:

1. the rows to number (keys and a payload key, or rows that are narrow anyway) are written
   once to the shared folder, so the input is evaluated once;
2. that table is range-partitioned on the order into ranges of about ``ROWS_PER_RANGE``
   rows and written again with its range number; as the order ends in a unique column,
   a key value that holds a third of the rows is still split over many ranges;
3. the stored ranges are counted (one number per range) and prefix offsets follow;
4. ``row_number`` runs within each range; a wide payload is joined back on its key.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.sources.files import stage

ROWS_PER_RANGE = 1_000_000


def _cols(order) -> list[Column]:
    if isinstance(order, (str, Column)):
        order = [order]
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _number(df: DataFrame, names: list[str], out: str) -> DataFrame:
    """Positions of rows by the (null-first ascending) columns ``names``; drops these columns."""
    spark = df.sparkSession
    rows = stage(df, "order")
    n_ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_PER_RANGE))
    ranged = rows.repartitionByRange(n_ranges, *names).sortWithinPartitions(*names)
    ranged = stage(ranged.withColumn("_tl_range", F.spark_partition_id()), "ranges")
    counts = sorted(map(tuple, ranged.groupBy("_tl_range").count().collect()))
    starts = [0, *accumulate(n for _, n in counts)]
    offsets = spark.createDataFrame([(r, o) for (r, _), o in zip(counts, starts)], "_tl_range int, _tl_start long")
    w = Window.partitionBy("_tl_range").orderBy(*names)
    return (ranged.withColumn("_tl_row", F.row_number().over(w)).join(F.broadcast(offsets), "_tl_range")
            .withColumn(out, F.col("_tl_start") + F.col("_tl_row") - 1)
            .drop("_tl_range", "_tl_row", "_tl_start", *names))


def with_position(df: DataFrame, order, out: str = "pos", key: str | None = None) -> DataFrame:
    """O1: add a dense 0-based position ``out`` following ``order``.

    ``order`` must be total (end it with a unique column such as ``pos``); null keys sort
    first, as in an ascending Spark sort. ``key`` names a unique column: only it and
    the order go through the numbering, and the rest of the row is joined back on it. Without ``key``
    whole rows go through, which suits narrow tables. The driver sees one count per range.
    """
    keys = _cols(order)
    names = [f"_tl_k{i}" for i in range(len(keys))]
    tagged = [k.alias(n) for k, n in zip(keys, names)]
    if key is None:
        return _number(df.select("*", *tagged), names, out)
    return df.join(_number(df.select(key, *tagged), names, out), key)


def dense_count(df: DataFrame, pos: str = "pos") -> int:
    """Number of rows, after checking in the same pass that ``pos`` is 0..n-1 (run O1 first if not)."""
    r = df.agg(F.count("*").alias("n"), F.count(pos).alias("have"), F.min(pos).alias("lo"), F.max(pos).alias("hi"),
               F.sum(F.col(pos).cast("decimal(38,0)")).alias("total")).first()
    n = r["n"]
    if n and (r["have"] != n or r["lo"] != 0 or r["hi"] != n - 1 or 2 * int(r["total"]) != n * (n - 1)):
        raise ValueError(f"column {pos!r} isn't a dense position: {n} rows, {r['lo']}..{r['hi']}; number the rows first")
    return n


def shard_of(pos, n_rows: int, n_shards: int) -> Column:
    """O2: contiguous balanced shard of a 0-based position, remainder to the first shards."""
    p = F.col(pos) if isinstance(pos, str) else pos
    size, rem = divmod(n_rows, n_shards)
    head = rem * (size + 1)
    if size == 0:
        return p.cast("int")
    return F.when(p < head, F.floor(p / (size + 1))).otherwise(
        F.lit(rem) + F.floor((p - F.lit(head)) / size)).cast("int")


def assign_shard(df: DataFrame, n_shards: int, pos: str = "pos", out: str = "shard",
                 n_rows: int | None = None) -> DataFrame:
    """O2 on a DataFrame with dense positions; unless ``n_rows`` is given they are counted and checked."""
    n = dense_count(df, pos) if n_rows is None else n_rows
    return df.withColumn(out, shard_of(pos, n, n_shards))


def _norm(i: int, n: int) -> int:
    """Python slice-bound normalisation."""
    return max(i + n, 0) if i < 0 else min(i, n)


def split_bounds(n_rows: int, val_size: int = 500, mode: str = "disjoint") -> dict[str, tuple[int, int]]:
    """O3: ``[start, end)`` of train/val/test over ``n_rows`` positions.

    ``overlap`` mirrors the original (train = everything but the tail, so val lies inside
    train); ``disjoint`` takes train only up to the val block.
    """
    n, v = n_rows, val_size
    if mode == "overlap":
        # Python slice rules, negative bounds wrap around: parity with the original
        raw = {"train": (0, _norm(n - v, n)), "val": (_norm(n - 2 * v, n), _norm(n - v, n)),
               "test": (_norm(n - v, n), n)}
    elif mode == "disjoint":
        # bounds clamp at 0, so the three ranges always partition the rows
        a, b = max(n - 2 * v, 0), max(n - v, 0)
        raw = {"train": (0, a), "val": (a, b), "test": (b, n)}
    else:
        raise ValueError(f"unknown split mode {mode!r}")
    return {k: (lo, max(lo, hi)) for k, (lo, hi) in raw.items()}


def tail_split(df: DataFrame, val_size: int = 500, mode: str = "disjoint", pos: str = "pos",
               out: str = "split", n_rows: int | None = None) -> DataFrame:
    """O3: tag each row with its split(s); a row in two splits (overlap mode) appears twice.

    One pass: the matching split names are built as an array and exploded. Unless ``n_rows``
    is given, positions are counted and checked to be dense first.
    """
    n = dense_count(df, pos) if n_rows is None else n_rows
    bounds = split_bounds(n, val_size, mode)
    p = F.col(pos)
    tags = F.array(*[F.when((p >= lo) & (p < hi), F.lit(name)) for name, (lo, hi) in bounds.items()])
    return df.withColumn(out, F.explode(F.filter(tags, lambda s: s.isNotNull())))


def fixed_batches(df: DataFrame, size: int, pos: str = "pos", out: str = "batch_id") -> DataFrame:
    """Consecutive chunks of ``size`` rows in position order (last one may be partial)."""
    return df.withColumn(out, F.floor(F.col(pos) / size).cast("long"))


def hash_unit(*parts) -> Column:
    """Reproducible uniform [0,1) from md5 of the ':'-joined parts (same formula in SQL engines)."""
    s = F.concat_ws(":", *[F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 13), 16, 10).cast("double") / float(16 ** 13)


def shuffled_batches(df: DataFrame, size: int, epoch: int, seed: int, key: str = "key",
                     out: str = "batch_id", order_out: str = "shuffled_pos") -> DataFrame:
    """Reproducible per-epoch shuffle (md5 of key:epoch:seed, key breaks ties), then O4."""
    h = F.md5(F.concat_ws(":", F.col(key), F.lit(str(epoch)), F.lit(str(seed))))
    tagged = df.withColumn("_tl_h", h)
    ranked = with_position(tagged, ["_tl_h", key], out=order_out).drop("_tl_h")
    return fixed_batches(ranked, size, pos=order_out, out=out)


def length_sorted_batches(df: DataFrame, size: int, length, pos: str = "pos", out: str = "batch_id",
                          order_out: str = "sorted_pos") -> DataFrame:
    """Sort by (length, pos), chunk into batches; ``pos`` restores the input order (L1).

    Only ``(pos, length)`` is numbered: lengths are computed once and no payload is sorted.
    """
    ln = F.col(length) if isinstance(length, str) else length
    ranked = with_position(df, [ln, pos], out=order_out, key=pos)
    return fixed_batches(ranked, size, pos=order_out, out=out)


def first_wins(df: DataFrame, key: str = "key", pos: str = "pos") -> DataFrame:
    """Keep the lowest-position row of each key (positions are unique within a key).

    The lowest position is a partial (map-side) aggregate of ``(key, pos)`` alone; whole
    rows meet it in a semi join, which can split a key that holds a large share of them.
    """
    k, p = F.col(key).alias("_tl_key"), F.min(pos).alias("_tl_first")
    first = df.groupBy(key).agg(p).select(k, "_tl_first")
    return df.join(first, F.col(key).eqNullSafe(F.col("_tl_key")) & (F.col(pos) == F.col("_tl_first")), "left_semi")


def order_restore(df: DataFrame, pos: str = "pos") -> DataFrame:
    """L1: back to input order (global sort: range-partitioned, not one task)."""
    return df.orderBy(pos)

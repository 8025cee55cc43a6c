"""Helpers shared by the training-data operators: shared-folder staging, whitespace, components."""

from __future__ import annotations

import functools
import re
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.session import checkpoint_dir

#: ASCII white space: what ``bytes.split()`` and ``bytes.strip()`` use.
WS = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"
#: Internal id of rows whose id is null: after every other id.
NULL_ID = (1 << 63) - 1


def id_of(col: str = "doc_id"):
    """Row id as a long; null ids count as one id after all others."""
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID).cast("long"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage is cut, every executor sees the files."""
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete the folder behind a staged table that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts_of(col: pa.Array) -> list:
    """UTF-8 bytes of a string column, None for null."""
    return col.cast(pa.binary()).to_pylist()


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (the public splitmix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def components(spark: SparkSession, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a long, b long)`` as ``(node, comp)``, comp the smallest node.

    Alternates large-star and small-star rewiring. A round keeps at most one row per
    edge, is aggregated before the shuffle, and is written to the shared folder; a hub with
    very many neighbours appears only as a key of a minimum and of a splittable join.
    Ends when a round changes nothing. Nodes without an edge to another node are absent.
    """
    def keep(df):
        """The staged edges, their number and a sum of their hashes, taken while they are written."""
        seen = Observation()
        out = stage(spark, df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(
            F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("sum")), "cc")
        return out, (seen.get["n"], seen.get["sum"])

    cur, last = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    for _ in range(max_rounds):
        if not last[0]:
            break
        both = cur.unionAll(cur.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy(F.col("hi").alias("u")).agg(F.least(F.min("lo"), F.first("hi")).alias("m"))
        # large star: every larger neighbour of u points to the least around u
        large = (both.where("lo > hi").withColumnRenamed("hi", "u").join(least, "u")
                 .select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct())
        large = stage(spark, large, "cc")
        # small star: u and its smaller neighbours point to the least of them
        least = large.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        small = (large.withColumnRenamed("hi", "u").join(least, "u")
                 .select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo")
                 .unionAll(least.select(F.col("u").alias("hi"), F.col("m").alias("lo"))).distinct())
        nxt, now = keep(small)
        unstage(large)
        unstage(cur)
        cur = nxt
        # done when every node hangs on one other that hangs on none
        tops = cur.select(F.col("lo").alias("top")).distinct()
        loose = (cur.groupBy("hi").agg(F.count("*").alias("n")).join(tops, F.col("hi") == F.col("top"), "left")
                 .where("n > 1 or top is not null"))
        if now == last or not loose.head(1):
            break
        last = now
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("hi").alias("node"), F.col("lo").alias("comp")).unionAll(
        cur.select(F.col("lo").alias("node"), F.col("lo").alias("comp")).distinct())


#: Bytes hashed at once; longer texts are taken in portions that end at white space.
_PORTION = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[list(WS.encode())] = True


@functools.cache
def _powers(n: int, base: int) -> np.ndarray:
    """``base ** i`` modulo 2**64."""
    return np.cumprod(np.r_[np.uint64(1), np.full(n, base, np.uint64)])


def powers(n: int) -> tuple:
    """Powers of the base and of its inverse, of at least ``n`` steps."""
    size = max(_PORTION, 1 << n.bit_length())
    return _powers(size, _BASE), _powers(size, pow(_BASE, -1, 1 << 64))


def word_hashes(text: bytes | None) -> np.ndarray:
    """64-bit hash of every word (run of bytes other than ASCII white space) of a UTF-8 text, in order."""
    parts, at = [], 0
    text = text or b""
    while at < len(text):
        end = at + _PORTION
        if end < len(text):
            m = _WHITE.search(text, end)
            end = m.start() if m else len(text)
        parts.append(_portion_hashes(np.frombuffer(text[at:end], np.uint8)))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


_WHITE = re.compile(rb"[\x20\x09-\x0D]")


def _portion_hashes(b: np.ndarray) -> np.ndarray:
    n = len(b)
    edge = np.zeros(n + 2, np.int8)
    edge[1:-1] = ~_SPACE[b]
    change = np.diff(edge)
    start, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    up, down = powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    return mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every run of ``k`` word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[i:i + n]
        out ^= out >> np.uint64(29)
    return mix64(out)


def dense_counts(docs: DataFrame, size: int, count, segments: int = 64) -> np.ndarray:
    """Sum over all texts of a count array of fixed ``size``; ``count(list of UTF-8 texts, array)`` adds a batch.

    ``docs`` has the text in its first column. Each task sends its array in segments, which meet in
    groups of 256 tasks, then of 256 groups; the driver receives ``size`` numbers whatever the input.
    """
    width = -(-size // segments)

    def run(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            count(texts_of(b.column(0)), total)
        rows = np.pad(total, (0, width * segments - size)).reshape(segments, width)
        part = TaskContext.get().partitionId() // 256
        small = np.int32 if rows.max(initial=0) < 1 << 31 else np.int64
        for i, r in enumerate(rows):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([part], pa.int32()), pa.array([np.dtype(small).itemsize], pa.int32()),
                 pa.array([r.astype(small).tobytes()], pa.binary())], names=["segment", "part", "width", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, np.int64)
        for w, blob in zip(pdf["width"], pdf["counts"]):
            total += np.frombuffer(blob, np.int32 if w == 4 else np.int64)
        return pd.DataFrame({"segment": pdf["segment"].iloc[:1], "part": pdf["part"].iloc[:1] // 256,
                             "width": [8], "counts": [total.tobytes()]})

    kind = "segment int, part int, width int, counts binary"
    d = docs.mapInArrow(run, kind)
    for _ in range(2):
        d = d.groupBy("segment", "part").applyInPandas(add, kind)
    total = np.zeros((segments, width), np.int64)
    for r in d.collect():
        total[r["segment"]] += np.frombuffer(r["counts"], np.int64)
    return total.ravel()[:size]


def portions(texts: list, size: int):
    """Lists of consecutive texts of about ``size`` characters or bytes together; a longer text is alone."""
    part, total = [], 0
    for t in texts:
        n = len(t or "")
        if part and total + n > size:
            yield part
            part, total = [], 0
        part.append(t)
        total += n
    if part:
        yield part


def numbered(spark: SparkSession, df: DataFrame, key: str, order: list, name: str) -> DataFrame:
    """``df``, staged, with ``pos``: each row's place (from 1) among the rows of its long ``key`` in ``order``.

    Rows are range-partitioned on key and order and numbered as they stream by, so a key with any share of the rows
    spreads over ranges; rows of a range are numbered on from the counts of the key's earlier ranges. A null key is a key.
    Rows that agree in ``order`` get different numbers.
    """
    d = df.withColumn("__tie", F.monotonically_increasing_id())
    by = [F.col(key).asc_nulls_first(), *order, F.col("__tie").asc()]
    d = d.repartitionByRange(*by).sortWithinPartitions(*by).drop("__tie")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema)}, __range int, __place long"

    def run(batches):
        at, last = 0, None
        part = TaskContext.get().partitionId()
        for b in batches:
            if not b.num_rows:
                continue
            col = b.column(b.schema.get_field_index(key))
            ids, none = col.fill_null(0).to_numpy(zero_copy_only=False), col.is_null().to_numpy(zero_copy_only=False)
            new = np.r_[last != (ids[0], none[0]), (ids[1:] != ids[:-1]) | (none[1:] != none[:-1])]
            idx = np.arange(b.num_rows)
            start = np.maximum.accumulate(np.where(new, idx, -at))
            place = idx - start + 1
            at, last = int(place[-1]), (ids[-1], none[-1])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(len(idx), part, np.int32)), pa.array(place.astype(np.int64))],
                names=[*b.schema.names, "__range", "__place"])

    d = stage(spark, d.mapInArrow(run, schema), name)
    counts = d.groupBy(key, "__range").agg(F.max("__place").alias("n"))
    earlier = Window.partitionBy(key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per range: only the keys that go on from one range into the next
    starts = counts.withColumn("__before", F.sum("n").over(earlier)).where("__before is not null").select(
        F.col(key).alias("__key"), F.col("__range").alias("__r"), "__before")
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.col("__range") == F.col("__r"))
    return d.join(starts, same, "left").select(
        *df.columns, (F.col("__place") + F.coalesce("__before", F.lit(0))).alias("pos"))

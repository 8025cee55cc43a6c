"""Line dedup: sharded cuckoo filters backed by exact reference-count tables.

State of a :class:`LineIndex`, all of it Parquet in the shared folder:

* ``postings (k1, k2, id, n)`` - one row per line key and document (128-bit key hash);
* ``counts (k1, k2, docs, lines, keeper)`` - exact reference counts of every key;
* ``filters (shard, room, keys, blob)`` - one cuckoo filter per shard of the key space.

``insert`` asks the shard's filter about each distinct key of the batch: a miss proves the key
new, so its counts are stored as they are; only hits are merged with the exact table.
``delete`` takes documents out again: touched keys are recounted exactly from the remaining
postings and keys without a reference leave their filter. Each call returns a new index
and leaves the old one readable, so a lost executor or a failed job never damages state.

A filter is one table with room for a known number of keys. A shard that would outgrow it gets a larger one, filled from the exact
table; when the keys outgrow all shards, their number doubles and all filters are filled anew. So a fingerprint belongs to one table,
and taking it out never touches a key that isn't its equal.

Memory: a shard holds at most about ``SHARD_KEYS`` distinct keys whatever the table's size, and there
are at least two shards per shuffle task. A key that
is in a third of all documents is one row per map task after partial aggregation; postings of hot keys
meet their keeper in a join that Spark can split.
"""

from __future__ import annotations

import hashlib
import pickle
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.llm.common import id_of, mix64, stage, texts_of

#: Production parameters.
MIN_KEY_CHARS = 10
SHARD_KEYS = 1 << 20
#: Batches in which a corpus is loaded: the filters tell which keys of a batch are known from those before.
BATCHES = 3

_KEYS = "k1 long, k2 long"
_COUNTS = f"{_KEYS}, docs long, lines long, keeper long"


class CuckooFilter:
    """One cuckoo table with four 16-bit slots per bucket, for a known number of keys.

    Keys are given as two int64 arrays and must be distinct within a call. A key's fingerprint lies in one of two buckets, each of which
    follows from the other and the fingerprint, so keys with one fingerprint that share a bucket share both and are
    interchangeable. The few fingerprints that find no slot are kept beside the table.
    """

    SLOTS = 4
    LOAD = 0.8
    KICKS = 200

    def __init__(self, room: int):
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, room) / (self.SLOTS * self.LOAD)))))
        self.table = np.zeros((buckets, self.SLOTS), np.uint16)
        self.over = np.zeros((0, 2), np.int64)  # bucket (the lesser of the two), fingerprint
        self.keys = 0

    @property
    def room(self) -> int:
        """Keys that the table is meant for."""
        return int(self.table.size * self.LOAD)

    def _places(self, k1, k2) -> tuple:
        """Fingerprint and the two buckets, the lesser first."""
        fp = (mix64(k2.view(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)
        fp[fp == 0] = 1
        mask = np.uint64(len(self.table) - 1)
        one = (mix64(k1.view(np.uint64)) & mask).astype(np.int64)
        two = self._other(one, fp)
        return fp, np.minimum(one, two), np.maximum(one, two)

    def _other(self, bucket, fp):
        return bucket ^ (mix64(fp.astype(np.uint64)) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def contains(self, k1, k2) -> np.ndarray:
        fp, one, two = self._places(k1, k2)
        hit = (self.table[one] == fp[:, None]).any(axis=1) | (self.table[two] == fp[:, None]).any(axis=1)
        if len(self.over):
            hit |= np.isin(one << 16 | fp, self.over[:, 0] << 16 | self.over[:, 1])
        return hit

    def insert(self, k1, k2) -> None:
        fp, one, two = self._places(k1, k2)
        self.keys += len(fp)
        at, rng = one, np.random.default_rng(7)
        for turn in range(self.KICKS):
            # fill free slots: the r-th of a bucket's comers takes its r-th free slot
            order = np.argsort(at, kind="stable")
            fp, at = fp[order], at[order]
            rank = np.arange(len(at)) - np.searchsorted(at, at)
            taken = self.table[at] != 0
            ok = rank < self.SLOTS - taken.sum(axis=1)
            slot = np.argsort(taken, axis=1, kind="stable")[ok, rank[ok]]
            self.table[at[ok], slot] = fp[ok]
            fp, at = fp[~ok], at[~ok]
            if not len(fp):
                return
            if turn:
                # one comer of each full bucket throws out one of its fingerprints, which moves to its other bucket
                first = np.r_[True, at[1:] != at[:-1]]
                who, slot = np.flatnonzero(first), rng.integers(self.SLOTS, size=int(first.sum()))
                out = self.table[at[who], slot]
                self.table[at[who], slot] = fp[who]
                fp[who] = out
            at = self._other(at, fp)
        self.over = np.r_[self.over, np.stack([np.minimum(at, self._other(at, fp)), fp.astype(np.int64)], axis=1)]

    def delete(self, k1, k2) -> None:
        """Remove one entry for each key; the keys must have been inserted."""
        fp, one, two = self._places(k1, k2)
        self.keys -= len(fp)
        # of keys that can't be told apart, the r-th takes the r-th entry
        name = one << 16 | fp
        order = np.argsort(name, kind="stable")
        fp, one, two, name = fp[order], one[order], two[order], name[order]
        rank = np.arange(len(name)) - np.searchsorted(name, name)
        there = np.concatenate([self.table[one] == fp[:, None], (self.table[two] == fp[:, None]) & (one != two)[:, None]], axis=1)
        place = there & (there.cumsum(axis=1) == rank[:, None] + 1)
        has, slot = place.any(axis=1), place.argmax(axis=1)
        bucket = np.where(slot < self.SLOTS, one, two)
        self.table[bucket[has], slot[has] % self.SLOTS] = 0
        for x in name[~has].tolist():
            at = np.flatnonzero((self.over[:, 0] << 16 | self.over[:, 1]) == x)
            if not len(at):
                raise KeyError("a key that was never inserted")
            self.over = np.delete(self.over, at[0], axis=0)

    def dump(self) -> bytes:
        return pickle.dumps((self.keys, len(self.table), zlib.compress(self.table.tobytes(), 1), self.over))

    @classmethod
    def load(cls, blob: bytes) -> CuckooFilter:
        out = cls.__new__(cls)
        out.keys, buckets, table, out.over = pickle.loads(blob)
        out.table = np.frombuffer(zlib.decompress(table), np.uint16).reshape(buckets, cls.SLOTS).copy()
        return out


def line_key(line: bytes) -> bytes:
    """ASCII white space stripped at both ends, A-Z lower-cased."""
    return line.strip().lower()


def key_hash(key: bytes) -> tuple[int, int] | None:
    """128-bit hash of a key that is long enough to count, else None."""
    n = len(key)
    if n < MIN_KEY_CHARS or n < 4 * MIN_KEY_CHARS and not key.isascii() and len(key.decode("utf-8", "replace")) < MIN_KEY_CHARS:
        return None
    return struct.unpack("<qq", hashlib.blake2b(key, digest_size=16).digest())


def line_postings(docs: DataFrame) -> DataFrame:
    """``(k1, k2, id, n)``: each counted line key of each document and its number of lines there."""

    def run(batches):
        for b in batches:
            k1, k2, ids, ns = [], [], [], []
            for i, text in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                seen: dict = {}
                for line in (text or b"").split(b"\n"):
                    h = key_hash(line_key(line))
                    if h is not None:
                        seen[h] = seen.get(h, 0) + 1
                for (x, y), n in seen.items():
                    k1.append(x)
                    k2.append(y)
                    ids.append(i)
                    ns.append(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.int64()) for v in (k1, k2, ids, ns)], names=["k1", "k2", "id", "n"])

    return docs.select(id_of().alias("id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"{_KEYS}, id long, n long")


def _count(postings: DataFrame) -> DataFrame:
    """Reference counts; rows that repeat a document id count as that one document."""
    return (postings.groupBy("k1", "k2").agg(
        F.when(F.min("id") == F.max("id"), F.lit(1)).otherwise(F.count("*")).cast("long").alias("docs"),
        F.sum("n").alias("lines"), F.min("id").alias("keeper")))


_FILTERS = "shard int, room long, keys long, blob binary"


def _keys(rows: pd.DataFrame) -> tuple:
    return rows["k1"].to_numpy(np.int64), rows["k2"].to_numpy(np.int64)


def _probe(key, old: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """One shard: ask the filter about each new key, put the misses in, return both.

    ``rows`` with ``docs`` 0 are the shard's stored keys, given if the filter has to be made anew.
    """
    known, new = rows[rows["docs"] == 0], rows[rows["docs"] > 0]
    if len(old) and not len(known):
        f = CuckooFilter.load(bytes(old["blob"].iloc[0]))
    else:
        f = CuckooFilter(2 * len(rows))
        f.insert(*_keys(known))
    k1, k2 = _keys(new)
    seen = f.contains(k1, k2)
    f.insert(k1[~seen], k2[~seen])
    # a hit may be a false positive: the exact table decides, and only then is the key put in
    out = new.assign(shard=key[0], seen=seen, room=0, keys=0, blob=None)
    row = {"shard": [key[0]], "k1": [0], "k2": [0], "docs": [0], "lines": [0], "keeper": [0], "seen": [False],
           "room": [f.room], "keys": [f.keys], "blob": [f.dump()]}  # whole numbers: a missing one would turn the key columns into floats
    return pd.concat([out[list(row)], pd.DataFrame(row)], ignore_index=True) if len(out) else pd.DataFrame(row)


def _adjust(key, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
    f = CuckooFilter.load(bytes(old["blob"].iloc[0]))
    for sign, change in ((1, f.insert), (-1, f.delete)):
        change(*_keys(new[new["sign"] == sign]))
    return pd.DataFrame({"shard": [key[0]], "room": [f.room], "keys": [f.keys], "blob": [f.dump()]})


@dataclass(frozen=True)
class LineIndex:
    """Reversible index of line keys; see the module text. Build with :meth:`empty` or :meth:`of`."""

    spark: SparkSession
    shards: int
    postings: DataFrame
    counts: DataFrame
    filters: DataFrame

    @classmethod
    def empty(cls, spark: SparkSession, shards: int | None = None) -> LineIndex:
        shards = shards or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        return cls(spark, shards, spark.createDataFrame([], f"{_KEYS}, id long, n long"),
                   spark.createDataFrame([], _COUNTS), spark.createDataFrame([], _FILTERS))

    @classmethod
    def of(cls, spark: SparkSession, docs: DataFrame, batches: int = 1) -> LineIndex:
        """Index of ``docs``, loaded in ``batches`` that split the ids."""
        postings = stage(spark, line_postings(docs), "postings")
        index = cls.empty(spark)
        for i in range(batches):
            index = index._insert(postings.where(F.pmod(F.xxhash64("id"), F.lit(batches)) == i))
        return cls(spark, index.shards, postings, index.counts, index.filters)

    def insert(self, docs: DataFrame) -> LineIndex:
        """Add documents whose ids are not in the index yet."""
        return self._insert(stage(self.spark, line_postings(docs), "postings"))

    def _shard(self):
        return F.pmod(F.xxhash64("k1", "k2"), F.lit(self.shards)).cast("int")

    def _grown(self, keys: int) -> LineIndex:
        """The index with shards for so many keys; if they are more than before, without filters."""
        shards = self.shards
        while keys > shards * SHARD_KEYS:
            shards *= 2
        if shards == self.shards:
            return self
        return LineIndex(self.spark, shards, self.postings, self.counts, self.spark.createDataFrame([], _FILTERS))

    def _insert(self, postings: DataFrame) -> LineIndex:
        new = stage(self.spark, _count(postings), "new")
        held = self.filters.select("shard", "room", "keys").collect()  # one row per shard
        now = self._grown(sum(r["keys"] for r in held) + new.count())
        new = new.withColumn("shard", now._shard())
        # shards whose table is too small, or not there: their keys come from the exact table again
        held = self.spark.createDataFrame(held if now is self else [], "part int, room long, keys long")
        small = (new.groupBy(F.col("shard").alias("part")).agg(F.count(F.lit(1)).alias("more")).join(held, "part", "left")
                 .where("room is null or keys + more > room").select("part"))
        stored = self.counts.withColumn("shard", now._shard())
        if now is self:
            stored = stored.join(small, F.col("shard") == F.col("part"), "left_semi")
        again = stored.select("k1", "k2", *[F.lit(0).cast("long").alias(c) for c in ("docs", "lines", "keeper")], "shard")
        rows = new.unionByName(again).select("k1", "k2", "docs", "lines", "keeper", F.col("shard").alias("part"))
        probed = stage(self.spark, now.filters.groupBy("shard").cogroup(rows.groupBy("part")).applyInPandas(
            _probe, f"shard int, {_COUNTS}, seen boolean, room long, keys long, blob binary"), "probed")
        keys, filters = probed.where("blob is null"), probed.where("blob is not null").select("shard", "room", "keys", "blob")
        cols = ["k1", "k2", "docs", "lines", "keeper"]
        fresh, maybe = keys.where("not seen").select(cols), keys.where("seen")
        known = maybe.join(self.counts.select("k1", "k2"), ["k1", "k2"], "left_semi").select("k1", "k2")
        merged = (self.counts.unionByName(maybe.select(cols)).groupBy("k1", "k2")
                  .agg(F.sum("docs").alias("docs"), F.sum("lines").alias("lines"), F.min("keeper").alias("keeper")))
        wrong = maybe.join(known, ["k1", "k2"], "left_anti").select(F.col("shard").alias("part"), "k1", "k2", F.lit(1).alias("sign"))
        filters = filters.groupBy("shard").cogroup(wrong.groupBy("part")).applyInPandas(_adjust, _FILTERS)
        return LineIndex(self.spark, now.shards, self.postings.unionByName(postings),
                         stage(self.spark, fresh.unionByName(merged), "counts"),
                         stage(self.spark, filters, "filters"))

    def delete(self, ids: DataFrame) -> LineIndex:
        """Take documents out: ``ids`` has a column ``doc_id``."""
        gone = ids.select(id_of().alias("id")).distinct()
        rest = stage(self.spark, self.postings.join(gone, "id", "left_anti").select("k1", "k2", "id", "n"), "postings")
        touched = self.postings.join(gone, "id", "left_semi").select("k1", "k2").distinct()
        again = _count(rest.join(touched, ["k1", "k2"], "left_semi"))
        counts = stage(self.spark, self.counts.join(touched, ["k1", "k2"], "left_anti").unionByName(again), "counts")
        out = (touched.join(counts, ["k1", "k2"], "left_anti")
               .select(self._shard().alias("shard"), "k1", "k2", F.lit(-1).alias("sign")))
        filters = self.filters.groupBy("shard").cogroup(out.groupBy("shard")).applyInPandas(_adjust, _FILTERS)
        return LineIndex(self.spark, self.shards, rest, counts, stage(self.spark, filters, "filters"))

    def drops(self) -> DataFrame:
        """``(id, keys)``: the line keys that each document loses to an earlier document."""
        shared = self.counts.where("docs > 1").select("k1", "k2", "keeper")
        return (self.postings.join(shared, ["k1", "k2"]).where("id <> keeper")
                .groupBy("id").agg(F.collect_set(F.struct("k1", "k2")).alias("keys")))

    def cut(self, docs: DataFrame) -> DataFrame:
        """``docs`` plus a column ``__cut`` of ``n_lines``, ``n_dropped`` and ``kept_text``."""
        drops = self.drops().select(F.col("id").alias("__id"), F.col("keys").alias("__keys"))
        d = docs.withColumn("__id", id_of()).join(drops, "__id", "left")
        return d.withColumn("__cut", _cut(F.col("text").cast("string"), F.col("__keys"))).drop("__keys", "__id")

    def apply(self, docs: DataFrame) -> DataFrame:
        """``docs`` plus ``n_lines``, ``n_dropped`` and ``kept_text``; columns of these names are replaced."""
        names = ("n_lines", "n_dropped", "kept_text")
        return self.cut(docs).withColumns({n: F.col(f"__cut.{n}") for n in names}).drop("__cut")


@F.arrow_udf(T.StructType().add("n_lines", "long").add("n_dropped", "long").add("kept_text", "string"))
def _cut(text: pa.Array, keys: pa.Array) -> pa.Array:
    lines, dropped, kept = [], [], []
    for t, drop in zip(texts_of(text), keys.to_pylist()):
        t = t or b""
        if not drop:
            lines.append(t.count(b"\n") + 1)
            dropped.append(0)
            kept.append(t)
            continue
        gone = {(k["k1"], k["k2"]) for k in drop}
        every = t.split(b"\n")
        keep = [x for x in every if key_hash(line_key(x)) not in gone]
        lines.append(len(every))
        dropped.append(len(every) - len(keep))
        kept.append(b"\n".join(keep))
    return pa.StructArray.from_arrays(
        [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
        names=["n_lines", "n_dropped", "kept_text"])


def dedup_lines(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Keep each long line only in the smallest document that holds it.

    Adds ``n_lines``, ``n_dropped`` and ``kept_text``. A null or empty text is one empty line.
    Lines whose key has fewer than 10 code points always stay. Rows with the same doc_id are one document and do
    not take lines from each other; null ids are one document after all others. Other columns pass through.
    """
    return LineIndex.of(spark, docs, BATCHES).apply(docs)


def rewrite_texts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with the kept lines as ``text`` (and ``n_chars`` to match); its columns, no others."""
    d = LineIndex.of(spark, docs, BATCHES).cut(docs).withColumn("text", F.col("__cut.kept_text"))
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return d.select(*docs.columns)

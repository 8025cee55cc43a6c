"""Document fingerprints by locally consistent parsing.

A text is a sequence of names, at first its code points. One level of parsing turns it into a shorter one: runs of an
equal name become one name; deterministic coin tossing (the position of the lowest bit in which a name differs from its left
neighbour, and that bit, applied until labels are below six) gives neighbours different small labels; a label larger than its
neighbours' starts a phrase; a phrase's name is a hash of its names. Where a phrase starts depends on a few names around it only, so equal
substrings get equal phrases except at their ends, at any offset. Levels follow until one name is left.

The fingerprint is a one-permutation min-hash of the phrase names of level ``LOW_LEVEL`` and above, ``SLOTS`` bytes in
hexadecimal; 00 marks an empty slot. Texts go through once, whole, in batches of bounded size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.llm.common import id_of, mix64, portions

#: Production parameters.
SLOTS = 128
LOW_LEVEL = 2
CHARS_AT_ONCE = 400_000
BUCKETS_PER_TASK = 4

_LOWEST = np.array([0] + [(i & -i).bit_length() - 1 for i in range(1, 256)], np.uint8)


def _labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Small labels by coin tossing against the left neighbour; a first name is tossed against its complement."""
    left = np.empty_like(names)
    left[1:], left[0] = names[:-1], 0
    x = names ^ left
    low = np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)).astype(np.uint64)
    low[first | (x == 0)] = 0
    lab = (2 * low + ((names >> low) & np.uint64(1))).astype(np.uint8)
    for _ in range(3):
        prev = np.empty_like(lab)
        prev[1:], prev[0] = lab[:-1], 0
        low8 = _LOWEST[lab ^ prev]
        low8[first] = 0
        lab = 2 * low8 + ((lab >> low8) & 1)
    return lab


def _parse(names: np.ndarray, doc: np.ndarray, level: int) -> tuple:
    """One level: names and documents of the phrases."""
    edge = np.empty(len(doc), bool)
    edge[0], edge[1:] = True, doc[1:] != doc[:-1]
    start = edge.copy()
    start[1:] |= names[1:] != names[:-1]
    at = np.flatnonzero(start)
    if len(at) < len(names):
        run = np.diff(np.append(at, len(names)))
        names, doc, edge = names[at], doc[at], edge[at]
        names = np.where(run > 1, mix64(names + run.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), names)
    lab = _labels(names, edge)
    start = edge.copy()
    start[1:-1] |= (lab[1:-1] > lab[:-2]) & (lab[1:-1] >= lab[2:])
    # a larger label right before another document's first name, or at the very end, has no right neighbour
    last = np.append(edge[1:], True)
    start[1:] |= (lab[1:] > lab[:-1]) & last[1:]
    at = np.flatnonzero(start)
    size = np.diff(np.append(at, len(names)))
    place = np.arange(len(names)) - np.repeat(at, size)
    power = np.cumprod(np.full(int(size.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    total = np.add.reduceat(names * power[place], at)
    return mix64(total + size.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(level)), doc[at]


def signatures(texts: list) -> np.ndarray:
    """One row of ``SLOTS`` bytes per text."""
    n = len(texts)
    least = np.full(n * SLOTS, np.iinfo(np.uint64).max, np.uint64)

    def add(names, doc):
        h = mix64(names)
        np.minimum.at(least, doc * SLOTS + (h % np.uint64(SLOTS)).astype(np.int64), h)

    names = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    doc = np.repeat(np.arange(n), [len(t) for t in texts])
    level = 0
    while len(names):
        if level >= LOW_LEVEL:
            add(names, doc)
        count = np.bincount(doc, minlength=n)
        alone = count[doc] == 1
        if level < LOW_LEVEL:
            add(names[alone], doc[alone])
        names, doc = names[~alone], doc[~alone]
        level += 1
        if len(names):
            names, doc = _parse(names, doc, level)
    sig = (mix64(least) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    sig[least == np.iinfo(np.uint64).max] = 0
    return sig.reshape(n, SLOTS)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal slots among those used on either side; two empty fingerprints are alike."""
    used = ((a != 0) | (b != 0)).sum(axis=-1)
    same = ((a == b) & (a != 0)).sum(axis=-1)
    return np.where(used > 0, same / np.maximum(used, 1), 1.0)


def compare(a: str, b: str) -> float:
    """Likeness of two fingerprint strings."""
    return float(likeness(np.frombuffer(bytes.fromhex(a), np.uint8), np.frombuffer(bytes.fromhex(b), np.uint8)))


def fingerprint(col) -> F.Column:
    """Fingerprint string of a text column; null counts as empty."""

    @F.arrow_udf("string")
    def run(text: pa.Array) -> pa.Array:
        out = []
        for part in portions([t or "" for t in text.to_pylist()], CHARS_AT_ONCE):
            out += [s.tobytes().hex() for s in signatures(part)]
        return pa.array(out, pa.string())

    return run(F.col(col) if isinstance(col, str) else col)


def beside_next(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``(bucket, extra, id, text)`` dealt and sorted so that each document is followed by the next one by id.

    Ids are dealt to ranges at sampled bounds. The first document of each range goes to the range before it too, as an extra row
    at its end; the first of all follows the last. Only range bounds and first ids, one per range, reach the driver.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = BUCKETS_PER_TASK * tasks
    d = docs.select(id_of().alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = d.select("id")
    bounds = np.unique(np.array(ids.approxQuantile("id", [i / n for i in range(1, n)], 1 / (4 * n)) or [], np.float64))

    @F.arrow_udf("int")
    def bucket(col: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, col.to_numpy(zero_copy_only=False).astype(np.float64), side="right"), pa.int32())

    firsts = sorted((r["b"], r["first"]) for r in ids.withColumn("b", bucket("id")).groupBy("b").agg(F.min("id").alias("first")).collect())
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}

    place = T.StructType().add("bucket", "integer").add("extra", "boolean")

    @F.arrow_udf(T.ArrayType(place))
    def places(col: pa.Array) -> pa.Array:
        i = col.to_numpy(zero_copy_only=False)
        own = np.searchsorted(bounds, i.astype(np.float64), side="right")
        rows = [[(int(b), False)] + ([(before[x], True)] if x in before else []) for b, x in zip(own, i.tolist())]
        return pa.array([[{"bucket": b, "extra": e} for b, e in r] for r in rows],
                        pa.list_(pa.struct([("bucket", pa.int32()), ("extra", pa.bool_())])))

    dealt = d.withColumn("p", F.explode(places("id"))).select("p.bucket", "p.extra", "id", "text")
    return dealt.repartition(tasks, "bucket").sortWithinPartitions("bucket", "extra", "id", "text")


def edited(text: str, following: str) -> str:
    """The last quarter of the code points, rounded down, replaced by as many of the following text, or all of it."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def _fingerprint_rows(rows: list) -> pa.RecordBatch:
    """``rows``: (id, text, next text)."""
    ids, texts, after = zip(*rows)
    changed = [edited(t, a) for t, a in zip(texts, after)]
    # each text's successor is the next row's text, but for the last row and at a range's end
    wanted = list(dict.fromkeys([*texts, *changed, *after]))
    at = {t: i for i, t in enumerate(wanted)}
    sig = np.concatenate([signatures(part) for part in portions(wanted, CHARS_AT_ONCE)])
    own, ed, nx = (sig[[at[t] for t in c]] for c in (texts, changed, after))
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed]),
        pa.array([s.tobytes().hex() for s in own]), pa.array([s.tobytes().hex() for s in ed]),
        pa.array(likeness(own, ed)), pa.array(likeness(own, nx))],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def compare_edits(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` of every document.

    A null text is empty. Order is by id, null ids last, equal ids by text. A single document follows
    itself. No documents give no rows.
    """

    def run(batches):
        rows, chars, held = [], 0, None  # held: (bucket, extra, id, text) that waits for its successor
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if held is not None and held[0] == row[0] and not held[1]:
                    rows.append((held[2], held[3], row[3]))
                    chars += len(held[3])
                held = row
                if chars > 4 * CHARS_AT_ONCE:
                    yield _fingerprint_rows(rows)
                    rows, chars = [], 0
        if rows:
            yield _fingerprint_rows(rows)

    out = beside_next(spark, docs).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != F.lit((1 << 63) - 1), F.col("doc_id")))

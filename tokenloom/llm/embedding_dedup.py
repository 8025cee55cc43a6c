"""Embedding near-dedup: epsilon grid order join on leading principal dimensions.

Unit vectors with cosine >= s are at most eps = sqrt(2 - 2 s) apart, and no projection on orthonormal axes
makes them further. So:

1. Equal vectors of a label collapse into one class with a count.
2. Principal axes come from a bounded sample (``SAMPLE`` vectors; the axes only steer pruning, any axes give the same
   links). Vectors are range-sorted by label and grid cell (projections / eps) and cut into blocks of ``BLOCK`` vectors with a bounding box.
3. The sorted sequence is joined with itself recursively: intervals of blocks whose boxes are provably
   further apart than eps are skipped, the others are split into ``2**FANOUT_BITS`` parts, down to pairs of blocks.
4. A pair of blocks is one matrix product in double precision. It yields link counts per vector and one edge per vector to a
   representative of its local component, never the list of pairs.

Memory is two blocks per task, also when one label or one cell holds a third of all rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.common import NULL_ID, components, id_of, stage

#: Production parameters.
COSINE = 0.98
AXES = 4
SAMPLE = 4000
BLOCK = 256
FANOUT_BITS = 3
#: Slack for rounding in projections and boxes.
SLACK = 1e-6


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, safe from overflow."""
    v = vectors.astype(np.float64)
    if not v.size:
        return v
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def vector_classes(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``(id, label, node, vec binary)``: ``node`` names the class of equal usable vectors, null if not usable."""

    def run(batches):
        for b in batches:
            nodes, vecs = [], []
            for label, v in zip(b.column(1), b.column(2)):
                node = raw = None
                if label.is_valid and v.is_valid and len(v) and v.values.null_count == 0:
                    x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                    if np.isfinite(x).all() and x.any():
                        raw = x.tobytes()
                        digest = hashlib.blake2b(repr(label.as_py()).encode() + b"/" + raw, digest_size=8).digest()
                        node = int.from_bytes(digest, "little", signed=True)
                nodes.append(node)
                vecs.append(raw)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(nodes, pa.int64()), pa.array(vecs, pa.binary())],
                names=["id", "label", "node", "vec"])

    kind = vectors.schema[label_col].dataType.simpleString()
    return vectors.select(id_of(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("vec")).mapInArrow(
        run, f"id long, label {kind}, node long, vec binary")


def principal_axes(classes: DataFrame) -> dict:
    """Leading axes per dimension, from the ``SAMPLE`` classes with the smallest hashes."""
    rows = classes.orderBy(F.xxhash64("node")).limit(SAMPLE).select("vec").collect()
    by_dim: dict = {}
    for r in rows:
        x = np.frombuffer(bytes(r["vec"]), np.float64)
        by_dim.setdefault(len(x), []).append(x)
    axes = {}
    for dim, vs in by_dim.items():
        u = _unit(np.array(vs))
        _, _, right = np.linalg.svd(u - u.mean(axis=0), full_matrices=False)
        axes[dim] = right[:AXES].T.copy()
    return axes


def _project(u: np.ndarray, axes: dict) -> np.ndarray:
    """``AXES`` coordinates; a dimension without fitted axes uses its first coordinates."""
    a = axes.get(u.shape[1])
    p = u @ a if a is not None else u[:, :AXES]
    return np.pad(p, ((0, 0), (0, AXES - p.shape[1])))


def grid_blocks(spark: SparkSession, classes: DataFrame, eps: float) -> DataFrame:
    """``(label, dim, code, n, lo array, hi array, nodes, counts, vecs)``: the sorted sequence cut into blocks."""
    axes = principal_axes(classes)

    def cells(batches):
        for b in batches:
            dims, cell = [], []
            for v in b.column(3).to_pylist():
                u = _unit(np.frombuffer(v, np.float64)[None, :])
                dims.append(u.shape[1])
                cell.append(np.floor(_project(u, axes)[0] / eps).astype(np.int32).tolist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(dims, pa.int32()), pa.array(cell, pa.list_(pa.int32()))],
                names=[*b.schema.names, "dim", "cell"])

    kind = classes.schema["label"].dataType.simpleString()
    placed = classes.select("label", "node", "n", "vec").mapInArrow(
        cells, f"label {kind}, node long, n long, vec binary, dim int, cell array<int>")
    order = ["label", "dim", *[F.element_at("cell", i + 1) for i in range(AXES)], "node"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("label", "dim", "node", "n", "vec")

    def cut(batches):
        part, seq = TaskContext.get().partitionId(), 0
        key, nodes, counts, vecs = None, [], [], []

        def block():
            nonlocal seq
            p = _project(_unit(np.frombuffer(b"".join(vecs), np.float64).reshape(len(vecs), -1)), axes)
            out = pa.RecordBatch.from_pylist([{
                "label": key[0], "dim": key[1], "part": part, "seq": seq, "lo": p.min(axis=0).tolist(), "hi": p.max(axis=0).tolist(),
                "nodes": np.array(nodes, np.int64).tobytes(), "counts": np.array(counts, np.int64).tobytes(),
                "vecs": b"".join(vecs)}], schema=arrow)
            seq += 1
            nodes.clear(), counts.clear(), vecs.clear()
            return out

        arrow = None
        for b in batches:
            arrow = arrow or pa.schema([
                ("label", b.schema.field("label").type), ("dim", pa.int32()), ("part", pa.int64()), ("seq", pa.int64()),
                ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())), ("nodes", pa.binary()),
                ("counts", pa.binary()), ("vecs", pa.binary())])
            for label, dim, node, n, vec in zip(*(c.to_pylist() for c in b.columns)):
                if vecs and ((label, dim) != key or len(vecs) >= BLOCK):
                    yield block()
                key = (label, dim)
                nodes.append(node), counts.append(n), vecs.append(vec)
        if vecs:
            yield block()

    return stage(spark, placed.mapInArrow(
        cut, f"label {kind}, dim int, part long, seq long, lo array<double>, hi array<double>, nodes binary, counts binary, vecs binary"), "blocks")


def near_blocks(blocks: DataFrame, eps: float) -> DataFrame:
    """``(a, b)`` codes of the block pairs, a <= b, that aren't provably further apart than ``eps``."""
    boxes = blocks.select("label", "dim", "code", "lo", "hi")
    top = (boxes.agg(F.max("code")).first()[0] or 0).bit_length()
    levels = -(-top // FANOUT_BITS)
    low = [F.min(F.element_at("lo", i + 1)) for i in range(AXES)]
    high = [F.max(F.element_at("hi", i + 1)) for i in range(AXES)]

    def nodes(level: int, side: str) -> DataFrame:
        shift = FANOUT_BITS * level
        d = boxes.groupBy("label", "dim", F.shiftright("code", shift).alias("at")).agg(F.array(*low).alias("lo"), F.array(*high).alias("hi"))
        return d.select("label", "dim", F.shiftright("at", FANOUT_BITS).alias(f"p{side}"), F.col("at").alias(side),
                        F.col("lo").alias(f"lo_{side}"), F.col("hi").alias(f"hi_{side}"))

    pairs = boxes.select("label", "dim", F.lit(0).cast("long").alias("pa"), F.lit(0).cast("long").alias("pb")).distinct()
    gap = sum((F.pow(F.greatest(F.lit(0.0), F.element_at("lo_b", i) - F.element_at("hi_a", i),
                                F.element_at("lo_a", i) - F.element_at("hi_b", i)), 2) for i in range(1, AXES + 1)), F.lit(0.0))
    for level in range(levels, -1, -1):
        pairs = (pairs.join(nodes(level, "a"), ["label", "dim", "pa"]).join(nodes(level, "b"), ["label", "dim", "pb"])
                 .where((F.col("a") <= F.col("b")) & (gap <= (eps + SLACK) ** 2))
                 .select("label", "dim", F.col("a").alias("pa"), F.col("b").alias("pb")))
    return pairs.select(F.col("pa").alias("a"), F.col("pb").alias("b"))


def _local_labels(link: np.ndarray) -> np.ndarray:
    """Smallest index of each row's component in a symmetric link matrix."""
    lab = np.arange(len(link))
    while True:
        low = np.minimum(lab, np.where(link, lab[None, :], len(link)).min(axis=1))
        low = low[low]
        if (low == lab).all():
            return lab
        lab = low


def block_links(spark: SparkSession, blocks: DataFrame, pairs: DataFrame, cosine: float) -> DataFrame:
    """``(a, b, n)``: link counts of node a (b null), and edges a - b that span the links (n null)."""
    side = lambda s: blocks.select(F.col("code").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("nodes", "counts", "vecs")])

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                same = r["a"] == r["b"]
                na, nb = (np.frombuffer(r[f"nodes_{s}"], np.int64) for s in "ab")
                ca, cb = (np.frombuffer(r[f"counts_{s}"], np.int64) for s in "ab")
                ua, ub = (_unit(np.frombuffer(r[f"vecs_{s}"], np.float64).reshape(len(n), -1)) for s, n in (("a", na), ("b", nb)))
                link = ua @ ub.T >= cosine
                if same:
                    np.fill_diagonal(link, False)
                    node, n, full = na, link @ cb, link
                else:
                    node, n = np.concatenate([na, nb]), np.concatenate([link @ cb, link.T @ ca])
                    k = len(na)
                    full = np.zeros((len(node), len(node)), bool)
                    full[:k, k:], full[k:, :k] = link, link.T
                hit = np.flatnonzero(n)
                if not len(hit):
                    continue
                to = node[hit][_local_labels(full[np.ix_(hit, hit)])]
                node, n = node[hit], n[hit]
                off = node != to
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([node, node[off]])), pa.array([None] * len(node) + to[off].tolist(), pa.int64()),
                     pa.array(n.tolist() + [None] * int(off.sum()), pa.int64())], names=["a", "b", "n"])

    # the pair carries one block through the second shuffle; each row is a few hundred KB at most
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return stage(spark, joined.mapInArrow(run, "a long, b long, n long"), "vec-links")


def embedding_classes(spark: SparkSession, vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id",
                      vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per vector.

    Vectors of equal non-null label and equal length link at cosine >= ``cosine``. Null or empty vectors, zero vectors, vectors with null
    or non-finite components and rows without a label link with nothing. ``component_id`` is the smallest id reachable
    (null ids after all others). Rows that repeat an id are vectors of their own.
    """
    eps = float(np.sqrt(2 - 2 * cosine))
    rows = stage(spark, vector_classes(vectors, id_col, vec_col, label_col), "vectors")
    usable = rows.where("node is not null")
    classes = usable.groupBy("label", "node").agg(F.count("*").alias("n"), F.min("id").alias("least"), F.first("vec").alias("vec"))
    classes = stage(spark, classes, "classes")
    blocks = grid_blocks(spark, classes, eps)
    bits = ((blocks.agg(F.max("seq")).first()[0] or 0) + 1).bit_length()
    blocks = blocks.withColumn("code", F.shiftleft("part", bits) + F.col("seq"))
    found = block_links(spark, blocks, near_blocks(blocks, eps), cosine)
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    comps = components(spark, found.where("n is null").select("a", "b"))
    info = (classes.select("node", "n", "least").join(counts, "node", "left").join(comps, "node", "left")
            .select("node", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "least", F.coalesce("comp", "node").alias("comp")))
    info = stage(spark, info, "classes")
    least = info.groupBy("comp").agg(F.min("least").alias("component"))
    info = info.join(least, "comp").select("node", "n_links", "component")
    null_id = lambda c: F.when(c != F.lit(NULL_ID), c)
    out = rows.select("id", "node").join(info, "node", "left").select(
        null_id(F.col("id")).alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        null_id(F.coalesce("component", "id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

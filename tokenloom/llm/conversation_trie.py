"""Prefix trie of conversations: double-array tries per prefix shard, upper nodes merged globally.

Every turn is named by a 128-bit hash of role and text. A conversation is a sequence of names, cut into bands of ``BAND`` turns, so that no
row grows with a conversation; a band hangs below the node at which the band before it ends (its root). Equal pieces are one row with a
count. Pieces are dealt by prefix: the shortest of the first 1, 2, 4, ... names that at most ``SHARD`` different pieces of that root
share, so a first turn in a third of all conversations is split by the turns that follow.

A task takes whole shards in chunks, gives the names of a chunk dense ids, packs the trie into BASE and CHECK (the child of state s by id c is
slot BASE[s] + c, valid if CHECK there is s), walks all pieces through it level by level and sums up from the deepest level. Nodes at or
below a shard's prefix are complete there. Nodes above it are shared: every shard adds its totals to them,
partially aggregated per task, and they are merged in a shuffle on the node's key. Bands are taken from the deepest up, one round each.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tokenloom.llm.common import numbered, stage

#: Turns of a band; a conversation of n turns takes n / BAND rounds.
BAND = 256
#: Different pieces of one shard at most; a chunk of small shards has at most CHUNK turns before its last shard.
SHARD = 128
CHUNK = 1 << 14
#: Shared nodes that a task holds before it passes their totals on.
HELD = 1 << 14
NAME = 16
_NO_ENDS = hashlib.sha256().hexdigest()
_BIG = (1 << 63) - 1


class DoubleArray:
    """Trie of integer sequences in BASE and CHECK arrays; slot 0 is the root. Codes are small, dense and not negative."""

    def __init__(self):
        self.base, self.check = np.zeros(64, np.int64), np.full(64, -1, np.int64)
        self.used = np.zeros(64, bool)
        self.used[0] = True
        self.low = 1  # no free slot before it

    def _grow(self, size: int) -> None:
        more = max(size, 2 * len(self.base)) - len(self.base)
        self.base = np.r_[self.base, np.zeros(more, np.int64)]
        self.check = np.r_[self.check, np.full(more, -1, np.int64)]
        self.used = np.r_[self.used, np.zeros(more, bool)]

    def _free(self, n: int) -> np.ndarray:
        """The first ``n`` free slots."""
        while True:
            free = np.flatnonzero(~self.used[self.low:])[:n] + self.low
            if len(free) == n:
                return free
            self._grow(len(self.base) + n)

    def _take(self, slots: np.ndarray, parents) -> None:
        self.check[slots] = parents
        self.used[slots] = True
        while self.low < len(self.used) and self.used[self.low]:
            rest = np.flatnonzero(~self.used[self.low:])
            self.low = self.low + int(rest[0]) if len(rest) else len(self.used)

    def add_level(self, states: np.ndarray, codes: np.ndarray) -> None:
        """Give every state its children; ``(states, codes)`` are all distinct edges of one level, sorted."""
        first = np.flatnonzero(np.r_[True, states[1:] != states[:-1]])
        number = np.diff(np.r_[first, len(states)])
        # a single child goes to the next free slot
        one = first[number == 1]
        if len(one):
            slots = self._free(len(one))
            self.base[states[one]] = slots - codes[one]
            self._take(slots, states[one])
        for at, n in zip(first[number > 1], number[number > 1]):
            code = codes[at:at + n]
            shape = code - code[0]
            tries = self._free(32)
            if tries[-1] + shape[-1] >= len(self.used):
                self._grow(int(tries[-1] + shape[-1]) + 1)
            fits = ~self.used[tries[:, None] + shape].any(axis=1)
            if fits.any():
                slot = int(tries[fits.argmax()])
            else:  # behind all that is used
                slot = int(np.flatnonzero(self.used)[-1]) + 1
                if slot + shape[-1] >= len(self.used):
                    self._grow(int(slot + shape[-1]) + 1)
            self.base[states[at]] = slot - code[0]
            self._take(slot + shape, states[at])

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Child of each state by its code; -1 where there is none."""
        slots = self.base[states] + codes
        slots = np.where((slots >= 0) & (slots < len(self.check)), slots, 0)
        return np.where(self.check[slots] == states, slots, -1)

    @classmethod
    def of(cls, codes: np.ndarray, sizes: np.ndarray) -> tuple:
        """The trie of sequences (rows of ``codes``, of ``sizes`` codes each) and, per level, each row's slot (-1 past its end)."""
        trie, levels = cls(), []
        state, width = np.zeros(len(codes), np.int64), int(codes.max(initial=0)) + 1
        for level in range(codes.shape[1]):
            on = sizes > level
            edges = np.unique(state[on] * width + codes[on, level])
            trie.add_level(edges // width, edges % width)
            state = np.where(on, trie.step(np.where(on, state, 0), codes[:, level]), -1)
            levels.append(state)
        return trie, levels


def node_totals(trie: DoubleArray, levels: list, weight, least, size, tail) -> dict:
    """Per slot: members, least member, children, childless nodes and saved tokens of its subtree.

    ``weight`` and ``least`` are per row, ``size[row][level]`` are a turn's bytes, ``tail`` has per row (children, leaves, saved) below its end.
    """
    n = len(trie.check)
    out = {k: np.zeros(n, np.int64) for k in ("n", "children", "leaves", "saved", "level", "size", "row")}
    out["least"] = np.full(n, _BIG)
    ends = np.stack(levels, axis=1) if levels else np.zeros((0, 0), np.int64)
    last = ends[np.arange(len(ends)), (ends >= 0).sum(axis=1) - 1]
    np.add.at(out["children"], last, tail[:, 0])
    np.add.at(out["leaves"], last, tail[:, 1])
    np.add.at(out["saved"], last, tail[:, 2])
    slots = []
    for level, state in enumerate(levels):
        on = state >= 0
        np.add.at(out["n"], state[on], weight[on])
        np.minimum.at(out["least"], state[on], least[on])
        out["size"][state[on]] = size[on, level]
        out["row"][state[on]] = np.flatnonzero(on)
        slots.append(np.unique(state[on]))
        out["level"][slots[-1]] = level
        np.add.at(out["children"], trie.check[slots[-1]], 1)
    for at in reversed(slots):
        out["leaves"][at] += out["children"][at] == 0
        out["saved"][at] += (out["n"][at] - 1) * out["size"][at]
        np.add.at(out["leaves"], trie.check[at], out["leaves"][at])
        np.add.at(out["saved"], trie.check[at], out["saved"][at])
    out["slots"], out["last"] = np.concatenate(slots) if slots else np.zeros(0, np.int64), last
    return out


_PIECE = ("root string, blob binary, sizes array<long>, n long, least long, ended long, next_root string, end_key string, "
          "tail_children long, tail_leaves long, tail_saved long, depth int, shard string")
_NODE = ("shared boolean, depth int, key string, parent_key string, child string, prefix binary, root string, next_root string, end_key string, "
         "conv long, parent_conv long, n long, n_ended long, n_children long, n_leaves long, saved long, size long")
_NODE_ARROW = pa.schema([
    ("shared", pa.bool_()), ("depth", pa.int32()), ("key", pa.string()), ("parent_key", pa.string()), ("child", pa.string()),
    ("prefix", pa.binary()), ("root", pa.string()), ("next_root", pa.string()), ("end_key", pa.string()), ("conv", pa.int64()),
    ("parent_conv", pa.int64()), ("n", pa.int64()), ("n_ended", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved", pa.int64()), ("size", pa.int64())])


def _path(root: str, blob: bytes, depth: int) -> list:
    """Keys of the nodes of depth 0 to ``depth`` on the way of a piece."""
    h = hashlib.md5(root.encode())
    keys = [h.hexdigest()]
    for i in range(depth):
        h.update(blob[NAME * i:NAME * (i + 1)])
        keys.append(h.copy().hexdigest())
    return keys


class _Shared:
    """Totals of nodes above the shards, by (node, child)."""

    def __init__(self):
        self.held = {}

    def add(self, root: str, blob: bytes, sizes, upto: int, child, totals: tuple, end: dict | None) -> None:
        """``totals`` (n, least, leaves, saved) go to the nodes of depth 0 to ``upto``; ``child`` hangs on the last of them."""
        keys = _path(root, blob, upto)
        for j, key in enumerate(keys):
            down = keys[j + 1] if j < upto else child
            r = self.held.get((key, down))
            if r is None:
                r = self.held[key, down] = {
                    "shared": True, "depth": j, "key": key, "parent_key": keys[j - 1] if j else None, "child": down, "root": root,
                    "prefix": blob[:NAME * j], "size": sizes[j - 1] if j else 0, "conv": _BIG, "n": 0, "n_ended": 0, "n_children": 0,
                    "n_leaves": 0, "saved": 0}
            r["n"] += totals[0]
            r["conv"] = min(r["conv"], totals[1])
            r["n_leaves"] += totals[2]
            r["saved"] += totals[3]
            if end and j == upto:
                r.update(end)

    def flush(self) -> list:
        rows, self.held = list(self.held.values()), {}
        return rows


def _build(batches):
    """Pieces sorted by root and names, whole shards in each partition: complete nodes, and totals for shared ones."""
    shared, held, turns = _Shared(), [], 0

    def chunk(rows):
        yield from _chunk([r for r in rows if r["depth"] is not None], shared)
        for r in rows:
            if r["depth"] is None:  # ends above every shard
                end = {"n_ended": r["ended"], "end_key": r["end_key"] if r["ended"] else None, "next_root": r["next_root"],
                       "n_children": r["tail_children"]}
                shared.add(r["root"], r["blob"], r["sizes"], len(r["sizes"]), None,
                           (r["n"], r["least"], r["tail_leaves"], r["tail_saved"]), end)
        if len(shared.held) > HELD:
            yield pa.RecordBatch.from_pylist(shared.flush(), _NODE_ARROW)

    for b in batches:
        for r in b.to_pylist():
            if turns > CHUNK and r["shard"] != held[-1]["shard"]:
                yield from chunk(held)
                held, turns = [], 0
            held.append(r)
            turns += len(r["sizes"]) + 1
    if held:
        yield from chunk(held)
    if shared.held:
        yield pa.RecordBatch.from_pylist(shared.flush(), _NODE_ARROW)


def _chunk(rows: list, shared: _Shared):
    """One double array over the shards of a chunk."""
    if not rows:
        return
    # the first code of a row is its shard's prefix, then come the turns behind that
    names = [[r["shard"].encode()] + [r["blob"][i:i + NAME] for i in range(NAME * r["depth"], len(r["blob"]), NAME)] for r in rows]
    sizes = np.array([len(x) for x in names])
    dense = {name: i for i, name in enumerate(sorted({n for x in names for n in x}))}
    codes = np.zeros((len(rows), sizes.max()), np.int64)
    nbytes = np.zeros_like(codes)
    for i, (x, r) in enumerate(zip(names, rows)):
        codes[i, :len(x)] = [dense[n] for n in x]
        nbytes[i, :len(x)] = r["sizes"][r["depth"] - 1:]
    trie, levels = DoubleArray.of(codes, sizes)
    tail = np.array([(r["tail_children"], r["tail_leaves"], r["tail_saved"]) for r in rows], np.int64)
    t = node_totals(trie, levels, np.array([r["n"] for r in rows]), np.array([r["least"] for r in rows]), nbytes, tail)
    at_end = {int(s): r for s, r in zip(t["last"], rows)}
    out = []
    for s in t["slots"].tolist():
        r = rows[int(t["row"][s])]
        up, end = int(trie.check[s]), at_end.get(s)
        node = {"shared": False, "depth": r["depth"] + int(t["level"][s]), "conv": int(t["least"][s]), "n": int(t["n"][s]),
                "n_children": int(t["children"][s]), "n_leaves": int(t["leaves"][s]), "saved": int(t["saved"][s])}
        if up:
            node["parent_conv"] = int(t["least"][up])
        else:
            path = _path(r["root"], r["blob"], r["depth"] - 1)
            node.update(parent_key=path[-1], root=r["root"])
            shared.add(r["root"], r["blob"], r["sizes"], r["depth"] - 1, r["shard"],
                       (node["n"], node["conv"], node["n_leaves"], node["saved"]), None)
        if end:
            node.update(n_ended=end["ended"], end_key=end["end_key"] if end["ended"] else None, next_root=end["next_root"])
        out.append(node)
    yield pa.RecordBatch.from_pylist(out, _NODE_ARROW)


def _shards(pieces: DataFrame, band: int, most: int) -> DataFrame:
    """Pieces with the shard they belong to and the depth of its prefix; null where a piece ends above every shard."""
    ladder = [1 << i for i in range((band - 1).bit_length() + 1) if 1 << i <= band]
    key = lambda n: F.md5(F.concat(F.col("root").cast("binary"), F.substring("blob", 1, NAME * n)))
    keys = F.filter(F.array(*[F.when(F.octet_length("blob") >= NAME * n, key(n)) for n in ladder]), lambda x: x.isNotNull())
    d = pieces.withColumn("steps", keys)
    steps = d.select("piece_key", F.explode("steps").alias("step"))
    # if a prefix is shared by too many pieces, so are all shorter ones: their number is the place of the first that isn't
    big = steps.groupBy("step").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("step")
    hot = steps.join(big, "step").groupBy("piece_key").agg(F.count(F.lit(1)).cast("int").alias("n_big"))
    d = d.join(hot, "piece_key", "left").withColumn("at", F.coalesce("n_big", F.lit(0)))
    fits = F.size("steps") > F.col("at")
    return d.withColumns({
        "depth": F.when(fits, F.element_at(F.array(*[F.lit(n) for n in ladder]), F.col("at") + 1)),
        "shard": F.when(fits, F.element_at("steps", F.col("at") + 1)).otherwise(F.col("piece_key"))})


def _merge_shared(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """Shared nodes with the totals of all shards and of all shared nodes below them."""
    by_child = nodes.where("shared").groupBy("key", "child").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("depth", "parent_key", "prefix", "root", "next_root", "end_key", "size")],
        F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in ("n", "n_leaves", "saved")],
        *[F.max(c).alias(c) for c in ("n_ended", "n_children")])
    own = by_child.groupBy("key").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("depth", "parent_key", "prefix", "root", "next_root", "end_key", "size")],
        F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in ("n", "n_leaves", "saved", "n_ended")],
        (F.sum("n_children") + F.count("child")).alias("n_children"))
    own = own.withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "saves": (F.col("n") - 1) * F.col("size")})
    own = stage(spark, own, "shared")

    def up(batches):
        for b in batches:
            out = [(key, r["leaf"], r["saves"]) for r in b.to_pylist() for key in _path(r["root"], r["prefix"], r["depth"])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64()),
                 pa.array([x[2] for x in out], pa.int64())], names=["key", "leaves", "saves_below"])

    below = own.select("root", "prefix", "depth", "leaf", "saves").mapInArrow(up, "key string, leaves long, saves_below long")
    below = below.groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saves_below").alias("saves_below"))
    return stage(spark, own.join(below, "key").select(
        "key", "depth", "parent_key", "root", "next_root", "end_key", "conv", "n", "n_ended", "n_children",
        (F.col("n_leaves") + F.col("leaves")).alias("n_leaves"), (F.col("saved") + F.col("saves_below")).alias("saved")), "shared")


def _ends(members: DataFrame) -> DataFrame:
    """``(end_key, ends_sha256)`` from ``(end_key, conv)``: the hash of the ids, ascending, joined by commas.

    Ids are joined in blocks of at most 65,536 (equal id / 65,536), which spread over tasks; the
    hash runs over the blocks of a node in order as they stream by.
    """
    blocks = members.groupBy("end_key", F.shiftright("conv", 16).alias("high")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string")), ",").alias("ids"))

    def run(batches):
        key, h = None, None
        for b in batches:
            out = []
            for k, ids in zip(b.column("end_key").to_pylist(), b.column("ids").to_pylist()):
                if k != key:
                    if h:
                        out.append((key, h.hexdigest()))
                    key, h = k, hashlib.sha256(ids.encode())
                else:
                    h.update(("," + ids).encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*out)], names=["end_key", "ends_sha256"])
        if h:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([h.hexdigest()])], names=["end_key", "ends_sha256"])

    return blocks.repartition("end_key").sortWithinPartitions("end_key", "high").select("end_key", "ids").mapInArrow(
        run, "end_key string, ends_sha256 string")


def _pieces(spark: SparkSession, turns: DataFrame, convs: DataFrame, band: int) -> DataFrame:
    """``(conv, band, root, blob, sizes, next_root, end_key)``, staged: the bands of every conversation."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    name = F.md5(F.concat_ws(":", F.length(text("role")).cast("string"), F.concat(text("role"), text("text"))).cast("binary"))
    d = turns.select("conv", "place", name.alias("name"), F.octet_length(text("text")).cast("long").alias("size"))
    d = d.unionByName(convs.select("conv", F.lit(0).cast("long").alias("place")), allowMissingColumns=True)
    d = d.groupBy("conv", F.greatest(F.lit(0), F.floor((F.col("place") - 1) / band)).cast("int").alias("band")).agg(
        F.array_sort(F.filter(F.collect_list(F.struct("place", "name", "size")), lambda x: x["place"] > 0)).alias("turns"))
    d = d.select("conv", "band", F.unhex(F.array_join(F.transform("turns", lambda x: x["name"]), "")).alias("blob"),
                 F.transform("turns", lambda x: x["size"]).alias("sizes"))
    # the name of a root: two sums of hashes of (band, names) over the bands before it
    wide = "decimal(38,0)"
    marks = [F.xxhash64("band", "blob").cast(wide), F.xxhash64(F.lit("b"), "blob", "band").cast(wide)]
    order = Window.partitionBy("conv").orderBy("band")
    sums = [F.sum(m).over(order.rowsBetween(Window.unboundedPreceding, 0)) for m in marks]
    d = d.withColumns({"s0": sums[0], "s1": sums[1], "more": F.lead("band").over(order).isNotNull()})
    named = lambda b, x, y: F.concat_ws(":", b.cast("string"), x.cast("string"), y.cast("string"))
    root = named(F.col("band"), F.col("s0") - marks[0], F.col("s1") - marks[1])
    d = d.withColumn("root", root).withColumn("end_key", F.md5(F.concat(F.col("root").cast("binary"), F.col("blob"))))
    return stage(spark, d.select(
        "conv", "band", "root", "blob", "sizes", "end_key", "more",
        F.when(F.size("sizes") == band, named(F.col("band") + 1, F.col("s0"), F.col("s1"))).alias("next_root")), "pieces")


def prefix_trie(spark: SparkSession, turns: DataFrame, convs: DataFrame, band: int = BAND, most: int = SHARD) -> DataFrame:
    """One row per node of the trie of conversations.

    ``turns(conv long, place long from 1 without gaps, role, text)`` are the turns, ``convs(conv)`` all conversations once, turnless ones
    too. A node is a distinct sequence of first turns, its members are the conversations that start with it. Columns
    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (the parent's conv_id, null at the root), ``n_convs``, ``n_children``,
    ``n_leaves`` (childless nodes of the subtree, top included), ``saved_tokens`` (over the subtree: members but one, times UTF-8 bytes of the last text) and
    ``ends_sha256`` (of the ids that end there). Null role or text counts as empty. No conversations give no rows.
    """
    bands = _pieces(spark, turns, convs, band)
    top = bands.agg(F.max("band")).first()[0] or 0
    carry, parts, shared_parts = None, [], []
    for b in range(top, -1, -1):
        d = bands.where(F.col("band") == b).groupBy("root", "blob").agg(
            F.first("sizes").alias("sizes"), F.count(F.lit(1)).alias("n"), F.min("conv").alias("least"),
            F.sum(F.when(F.col("more"), 0).otherwise(1)).alias("ended"), F.max(F.when(F.col("more"), F.col("next_root"))).alias("next_root"),
            F.first("end_key").alias("piece_key"))
        d = d.withColumn("end_key", F.col("piece_key"))
        zero = {f"tail_{c}": F.lit(0).cast("long") for c in ("children", "leaves", "saved")}
        if carry is not None:
            d = d.join(carry, "next_root", "left").withColumns({c: F.coalesce(c, z) for c, z in zero.items()})
        else:
            d = d.withColumns(zero)
        d = stage(spark, d, "pieces")
        d = _shards(d, band, most)
        names = [x.split()[0] for x in _PIECE.split(", ")]
        built = stage(spark, d.select(*names).repartition("shard").sortWithinPartitions("root", "blob")
                      .mapInArrow(_build, _NODE), "nodes")
        shared = _merge_shared(spark, built)
        carry = shared.where("depth = 0").select(
            F.col("root").alias("next_root"), F.col("n_children").alias("tail_children"), F.col("n_leaves").alias("tail_leaves"),
            F.col("saved").alias("tail_saved"))
        deep = (F.col("depth") + b * band).cast("long").alias("depth")
        cols = ["next_root", "end_key", "conv", "parent_conv", "n", "n_children", "n_leaves", "saved"]
        # the parent of a band's first node is named by its root
        parent = F.when(F.col("parent_key").isNotNull() & (F.col("depth") == 1) & F.lit(b > 0), F.concat(F.lit("root:"), "root")).otherwise(
            F.col("parent_key"))
        parts.append(built.where("not shared").select(deep, *cols, F.lit(None).cast("string").alias("key"), parent.alias("parent_key")))
        shared_parts.append(shared.where("depth > 0" if b else "true").withColumn("parent_conv", F.lit(None).cast("long")).select(
            deep, *cols, "key", parent.alias("parent_key")))
    nodes = None
    for p in [*parts, *shared_parts]:
        nodes = p if nodes is None else nodes.unionByName(p)
    # parents outside the shard: shared nodes by key, and nodes at which a band ends by the root they are to the next
    own = nodes.where("key is not null").select(F.col("key").alias("parent_key"), F.col("conv").alias("above"))
    at_root = nodes.where("next_root is not null").select(F.concat(F.lit("root:"), "next_root").alias("parent_key"), F.col("conv").alias("above"))
    inner = nodes.where("parent_key is null")
    outer = nodes.where("parent_key is not null").join(own.unionByName(at_root), "parent_key").withColumn("parent_conv", F.col("above"))
    nodes = inner.unionByName(outer.select(*inner.columns))
    ends = _ends(bands.where("not more").select("end_key", "conv"))
    with_ends = nodes.where("end_key is not null").join(ends, "end_key")
    nodes = nodes.where("end_key is null").withColumn("ends_sha256", F.lit(_NO_ENDS)).unionByName(with_ends.select(*nodes.columns, "ends_sha256"))
    return nodes.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                        "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")


def ordered_turns(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``(conv, place, role, text)`` of ``rows(conv_id, turn, role, text)``: turns by turn (null first), then role and text.

    Rows without a ``conv_id`` belong to no conversation and are left out.
    """
    d = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    d = numbered(spark, d, "conv", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], "turns")
    return d.select("conv", F.col("pos").alias("place"), "role", "text")


def rebuilt(turns: DataFrame) -> tuple:
    """The task's rebuilt conversations and their ids: conversation c begins with the first h turns of conversation c - c % 5 (as many as
    it has), then come its own turns after its first h; h is the crc32 of c in decimal, modulo 9."""
    convs = turns.groupBy("conv").agg(F.max("place").alias("size")).withColumns(
        {"h": F.crc32(F.col("conv").cast("string").cast("binary")) % 9, "donor": F.col("conv") - F.col("conv") % 5})
    sizes = convs.select(F.col("conv").alias("donor"), F.col("size").alias("donor_size"))
    convs = convs.join(sizes, "donor", "left").withColumn("lent", F.least("h", F.coalesce("donor_size", F.lit(0))))
    lent = convs.where("lent > 0").select("conv", "donor", "lent").join(
        turns.where("place <= 8").withColumnRenamed("conv", "donor"), "donor").where("place <= lent")
    own = turns.join(convs.where("size > h").select("conv", "h", "lent"), "conv").where("place > h")
    return (lent.select("conv", "place", "role", "text").unionByName(
        own.select("conv", (F.col("place") - F.col("h") + F.col("lent")).alias("place"), "role", "text")), convs.select("conv"))


def rebuilt_trie(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Trie of the rebuilt conversations of ``rows``; see ``prefix_trie``, ``rebuilt`` and ``ordered_turns`` for nulls and ties."""
    turns, convs = rebuilt(ordered_turns(spark, rows))
    return prefix_trie(spark, turns, convs)

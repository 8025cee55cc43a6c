"""Conversation structure repair: weighted CYK interval parsing.

A conversation should read ``(s?(ua)+)?`` in role initials: an optional system turn, then pairs of user and
assistant. The grammar is in Chomsky normal form over the places of that pattern: a symbol ``(p, q)`` derives the edits that
take the pattern from place ``p`` to ``q``; terminals are the edits of one row, closed under insertions on both sides,
and every binary rule is ``(p, q) -> (p, r) (r, q)``. A cell holds, per symbol, the least
``(cost, audit)``: audits of equal cost are compared as text. Two audits of one cell and cost never extend each other (the longer
would hold more insertions and cost more), so the least whole is made of least parts.

Rows are numbered per conversation and cut into blocks of ``BLOCK`` rows. Inside a block all spans are filled bottom-up
by length over all split points, for all blocks of a batch at once, audits as numbers in base 5. Blocks are then spans of their own and are
combined by the same rules, ``FAN`` at a time, until one is left. No task gathers a whole conversation: what
grows with one is its audit (a result column) and the running hash of its repaired text, which streams by.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.common import NULL_ID, id_of, numbered, stage

#: Costs of the edits; fixed values of the task. An undeleted truncated row adds ``CUT``.
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
#: Rows of a block. An audit of a block has at most 2 * BLOCK + 2 letters, and 27 letters fit 64 bits.
BLOCK = 12
FAN = 64
_WIDTH = 27
_LETTER = np.frombuffer(b"\0DIKR", np.uint8)  # digits in ASCII order
_D, _I, _K, _R = 1, 2, 3, 4
_POW = 5 ** np.arange(_WIDTH, dtype=np.int64)
_FAR = 1 << 40

# places of the pattern: 0 nothing yet, 1 after s, 2 after u, 3 after a; it may end at 0 and 3
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_ENDS = (0, 3)


class Cells:
    """Least (cost, audit) per symbol, for an array of spans: arrays of shape (..., 4, 4)."""

    def __init__(self, shape: tuple):
        self.cost = np.full((*shape, 4, 4), _FAR, np.int64)
        self.code = np.zeros((*shape, 4, 4), np.int64)
        self.size = np.zeros((*shape, 4, 4), np.int64)

    def offer(self, cost, code, size, where=...):
        """Keep the lesser of what is held and what is offered."""
        c, a, n = self.cost[where], self.code[where], self.size[where]
        better = (cost < _FAR) & ((cost < c) | ((cost == c) & (code < a)))
        self.cost[where] = np.where(better, cost, c)
        self.code[where] = np.where(better, code, a)
        self.size[where] = np.where(better, size, n)

    def at(self, where) -> "Cells":
        out = Cells.__new__(Cells)
        out.cost, out.code, out.size = self.cost[where], self.code[where], self.size[where]
        return out

    def join(self, left: "Cells", right: "Cells") -> None:
        """All binary rules over two neighbouring spans."""
        for r in range(4):
            lc, la, ln = (x[..., :, r, None] for x in (left.cost, left.code, left.size))
            rc, ra, rn = (x[..., None, r, :] for x in (right.cost, right.code, right.size))
            ok = (lc < _FAR) & (rc < _FAR)
            code = np.where(ok, la + ra // _POW[ln], 0)
            self.offer(np.where(ok, lc + rc, _FAR), code, np.where(ok, ln + rn, 0))


def _closure() -> Cells:
    """Cheapest insertions from place to place: none, one, or several."""
    out = Cells(())
    for p in range(4):
        out.cost[p, p] = 0
        for role in "ua":
            if (p, role) in _STEP:
                out.cost[p, _STEP[p, role]], out.code[p, _STEP[p, role]], out.size[p, _STEP[p, role]] = (
                    INSERT, _I * _POW[_WIDTH - 1], 1)
    while True:
        more = Cells(())
        more.offer(out.cost, out.code, out.size)
        more.join(out, out)
        if (more.cost == out.cost).all() and (more.code == out.code).all():
            return out
        out = more


_INSERTS = _closure()


def _rows(initials: np.ndarray, must: np.ndarray, cut: np.ndarray) -> Cells:
    """Cells of single rows: ``initials`` as one-letter strings, ``must`` be deleted, ``cut`` short."""
    edits = Cells(initials.shape)
    one = _POW[_WIDTH - 1]
    for p in range(4):
        edits.offer(np.full(initials.shape, DELETE), _D * one, 1, (..., p, p))
        for role in "sua":
            if (p, role) not in _STEP:
                continue
            to = (..., p, _STEP[p, role])
            edits.offer(np.where(~must & (initials == role), CUT * cut, _FAR), _K * one, 1, to)
            if role != "s":
                edits.offer(np.where(must, _FAR, REROLE + CUT * cut), _R * one, 1, to)
    half, out = Cells(initials.shape), Cells(initials.shape)
    half.join(_INSERTS, edits)
    out.join(half, _INSERTS)
    return out


def parse(initials: np.ndarray, must: np.ndarray, cut: np.ndarray) -> tuple:
    """Whole-span cells of conversations of equal length, arrays of shape (conversations, rows up to BLOCK).

    Returns costs (conversations, 4, 4) and audits (the same, bytes; empty where there is no derivation).
    """
    n = initials.shape[1]
    spans = {1: _rows(initials, must, cut)}
    for length in range(2, n + 1):
        starts = n - length + 1
        cell = Cells((len(initials), starts))
        for k in range(1, length):
            cell.join(spans[k].at((slice(None), slice(0, starts))), spans[length - k].at((slice(None), slice(k, k + starts))))
        spans[length] = cell
    whole = spans[n].at((slice(None), 0))
    digits = _LETTER[whole.code[..., None] // _POW[::-1] % 5]
    return whole.cost, np.ascontiguousarray(digits).view(f"S{_WIDTH}")[..., 0]


def combine(left: tuple, right: tuple) -> tuple:
    """Binary rules over two spans as (costs, audits), each a list of 16."""
    cost, audit = [_FAR] * 16, [b""] * 16
    for p in range(4):
        for r in range(4):
            lc = left[0][4 * p + r]
            if lc >= _FAR:
                continue
            for q in range(4):
                c = lc + right[0][4 * r + q]
                if c > cost[4 * p + q] or c >= _FAR:
                    continue
                a = left[1][4 * p + r] + right[1][4 * r + q]
                if c < cost[4 * p + q] or a < audit[4 * p + q]:
                    cost[4 * p + q], audit[4 * p + q] = c, a
    return cost, audit


def combine_all(spans: list) -> tuple:
    """Neighbours are combined pairwise, bottom-up by span length."""
    while len(spans) > 1:
        spans = [combine(*spans[i:i + 2]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
    return spans[0]


_CELLS = "costs array<long>, audits array<binary>, first string, last string, illegal long"
_GOOD = ("su", "ua", "au")


def _analyse(batches):
    """Blocks to their cells and role counts."""
    for b in batches:
        conv, block = b.column("conv").to_pylist(), b.column("block").to_pylist()
        rows = b.column("rows").to_pylist()
        costs, audits = [None] * len(rows), [None] * len(rows)
        initials = [[(x["role"] or "")[:1] for x in r] for r in rows]
        by_size = {}
        for i, r in enumerate(rows):
            by_size.setdefault(len(r), []).append(i)
        for at in by_size.values():
            must = np.array([[x["fault"] in (1, 2) for x in rows[i]] for i in at])
            cut = np.array([[x["fault"] == 3 for x in rows[i]] for i in at])
            cost, audit = parse(np.array([initials[i] for i in at]), must, cut)
            for i, c, a in zip(at, cost.reshape(-1, 16).tolist(), audit.reshape(-1, 16).tolist()):
                costs[i], audits[i] = c, a
        illegal = [sum(x + y not in _GOOD for x, y in zip(t, t[1:])) for t in initials]
        yield pa.RecordBatch.from_arrays(
            [pa.array(conv, pa.int64()), pa.array(block, pa.int64()), pa.array(costs, pa.list_(pa.int64())),
             pa.array(audits, pa.list_(pa.binary())), pa.array([t[0] for t in initials]), pa.array([t[-1] for t in initials]),
             pa.array(illegal, pa.int64())],
            names=["conv", "block", "costs", "audits", "first", "last", "illegal"])


def _merge(batches):
    """Sorted spans: neighbours of one conversation and one group of ``FAN`` become one span."""
    held, key = [], None

    def flush():
        if not held:
            return []
        costs, audits = combine_all([(h["costs"], h["audits"]) for h in held])
        seams = sum(x["last"] + y["first"] not in _GOOD for x, y in zip(held, held[1:]))
        return [{"conv": key[0], "block": key[1], "costs": costs, "audits": audits, "first": held[0]["first"],
                 "last": held[-1]["last"], "illegal": sum(h["illegal"] for h in held) + seams}]

    for b in batches:
        out = []
        for r in b.to_pylist():
            now = (r["conv"], r["block"] // FAN)
            if now != key:
                out += flush()
                held, key = [], now
            held.append(r)
        if out:
            yield pa.RecordBatch.from_pylist(out, b.schema)
    if held:
        yield pa.RecordBatch.from_pylist(flush(), b.schema)


def _finish(batches):
    """Spans of whole conversations to their audits, cut at the blocks."""
    step = re.compile(rb"(?:I*[DKR]){%d}(?=I*[DKR])" % BLOCK)
    for b in batches:
        out = []
        for r in b.to_pylist():
            cost, audit = min((r["costs"][q], r["audits"][q]) for q in _ENDS)
            made = len(audit) - audit.count(b"D")
            at, done, n = 0, 0, 0
            while True:
                m = step.match(audit, at)
                piece = audit[at:m.end()] if m else audit[at:]
                out.append({"conv": r["conv"], "block": n, "piece": piece, "done": done, "system": made % 2 == 1,
                            "cost": cost, "illegal": r["illegal"]})
                done += len(piece) - piece.count(b"D")
                if m is None:
                    break
                at, n = m.end(), n + 1
        if out:
            yield pa.RecordBatch.from_pylist(out, _PIECES)


_PIECES = pa.schema([("conv", pa.int64()), ("block", pa.int64()), ("piece", pa.binary()), ("done", pa.int64()),
                     ("system", pa.bool_()), ("cost", pa.int64()), ("illegal", pa.int64())])


def apply_edits(piece: bytes, done: int, system: bool, rows: list) -> list:
    """Repaired ``(edit, role, text)`` of a block's rows; ``done`` turns come before, of which the first may be ``system``."""
    out, at = [], 0
    for edit in piece.decode():
        row = None if edit == "I" else rows[at]
        at += edit != "I"
        if edit == "D":
            continue
        role = "user" if (done + len(out) - system) % 2 == 0 else "assistant"
        out.append((edit, row["role"] if edit == "K" else role, row["text"] if row else ""))
    return out


def faults(text: Column, repeated: Column) -> Column:
    """0 sound, 1 blank, 2 repeated, 3 cut short: the first that holds."""
    return (F.when(~F.regexp_like(text, F.lit(r"[^\x20\x09-\x0D]")), 1).when(repeated, 2)
            .when(~F.regexp_like(text, F.lit(r"[.!?][\x20\x09-\x0D]*\z")), 3).otherwise(0))


def _parsed(spark: SparkSession, rows: DataFrame) -> tuple:
    """``(blocks, pieces)``, staged: the rows of each block with their faults, and the edits of each block."""
    d = rows.select(id_of("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
                    F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    d = numbered(spark, d, "conv", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], "turns")
    named = d.select("conv", "pos", F.xxhash64("role", "text").alias("name"))
    first = named.groupBy("conv", "name").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = named.join(first, ["conv", "name"]).where("pos > first").select("conv", "pos", F.lit(True).alias("again"))
    # one shuffle brings rows and marks to their block
    block = F.floor((F.col("pos") - 1) / BLOCK).cast("long")
    both = d.select("conv", "pos", "role", "text", F.lit(None).cast("boolean").alias("again")).unionByName(
        later, allowMissingColumns=True).groupBy("conv", block.alias("block")).agg(F.collect_list(
            F.struct("pos", "role", "text", "again")).alias("all"))
    marks = F.transform(F.filter("all", lambda x: x["again"].isNotNull()), lambda x: x["pos"])
    own = F.array_sort(F.filter("all", lambda x: x["again"].isNull()))
    both = both.select("conv", "block", own.alias("own"), marks.alias("marks")).select(
        "conv", "block", F.transform("own", lambda x: F.struct(
            x["role"].alias("role"), x["text"].alias("text"),
            faults(x["text"], F.array_contains("marks", x["pos"])).alias("fault"))).alias("rows"))
    blocks = stage(spark, both, "blocks")
    spans = stage(spark, blocks.mapInArrow(_analyse, f"conv long, block long, {_CELLS}"), "spans")
    while spans.where("block > 0").head(1):
        group = F.floor(F.col("block") / FAN)
        spans = stage(spark, spans.repartition("conv", group).sortWithinPartitions("conv", "block")
                      .mapInArrow(_merge, spans.schema), "spans")
    pieces = stage(spark, spans.mapInArrow(
        _finish, "conv long, block long, piece binary, done long, system boolean, cost long, illegal long"), "pieces")
    return blocks, pieces


def _edited(blocks: DataFrame, pieces: DataFrame) -> DataFrame:
    """Blocks with the edits to apply to them."""
    return blocks.join(pieces, ["conv", "block"])


def repaired_turns(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The repaired turns ``(conv_id, block long, place int, edit, role, text)``; order by block and place.

    Deleted rows are absent, inserted ones have an empty text. See ``repair`` for nulls and ties.
    """
    blocks, pieces = _parsed(spark, rows)

    def run(batches):
        for b in batches:
            out = [{"conv_id": None if r["conv"] == NULL_ID else r["conv"], "block": r["block"], "place": i, "edit": e, "role": role,
                    "text": text} for r in b.to_pylist()
                   for i, (e, role, text) in enumerate(apply_edits(r["piece"], r["done"], r["system"], r["rows"]))]
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("conv_id", pa.int64()), ("block", pa.int64()), ("place", pa.int32()), ("edit", pa.string()),
                ("role", pa.string()), ("text", pa.string())]))

    return _edited(blocks, pieces).mapInArrow(
        run, "conv_id long, block long, place int, edit string, role string, text string")


def _digests(batches):
    """Blocks in order, with their edits: one row per conversation with its audit and the hash of its repaired text."""
    key, audit, digest, started, head = None, [], None, False, None

    def row():
        return [{"conv": key, "cost": head["cost"], "illegal": head["illegal"], "audit": b"".join(audit).decode(),
                 "repaired_sha256": digest.hexdigest()}] if head else []

    kind = pa.schema([("conv", pa.int64()), ("cost", pa.int64()), ("illegal", pa.int64()), ("audit", pa.string()),
                      ("repaired_sha256", pa.string())])
    for b in batches:
        out = []
        for r in b.to_pylist():
            if head is None or r["conv"] != key:
                out += row()
                key, audit, digest, started, head = r["conv"], [], hashlib.sha256(), False, r
            audit.append(r["piece"])
            for _, role, text in apply_edits(r["piece"], r["done"], r["system"], r["rows"]):
                digest.update((("\n" if started else "") + f"{role}:{text}").encode())
                started = True
        if out:
            yield pa.RecordBatch.from_pylist(out, kind)
    if head:
        yield pa.RecordBatch.from_pylist(row(), kind)


def repair(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows(conv_id, turn, role, text)``: its faults and its cheapest repair.

    Columns ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``. Rows are ordered by turn, null turns
    first, equal turns by role and text; a repeated row is a duplicate of itself. A null role or text counts as one space, rows
    without a ``conv_id`` form a conversation of their own, a role without an initial s, u or a is never kept. An empty text is
    blank. Other columns of ``rows`` don't matter. No rows give no rows.
    """
    blocks, pieces = _parsed(spark, rows)
    counts = blocks.select("conv", F.explode("rows").alias("r")).groupBy("conv").agg(*[
        F.count(F.when(F.col("r.fault") == i, 1)).alias(name) for i, name in ((1, "blank"), (2, "duplicate"), (3, "truncated"))])
    turns = rows.select(id_of("conv_id").alias("conv"), F.col("turn").cast("decimal(20,0)").alias("turn")).groupBy("conv", "turn").agg(
        F.lit(1).alias("one")).groupBy("conv").agg(
        F.expr("coalesce(try_cast(max(turn) - min(turn) + 1 - count(turn) as bigint), 0)").alias("gaps"))
    ordered = _edited(blocks, pieces).repartition("conv").sortWithinPartitions("conv", "block")
    done = ordered.mapInArrow(_digests, "conv long, cost long, illegal long, audit string, repaired_sha256 string")
    return done.join(counts, "conv").join(turns, "conv").select(
        F.when(F.col("conv") != NULL_ID, F.col("conv")).alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal",
        "cost", "audit", "repaired_sha256")


def damage(rows: DataFrame) -> DataFrame:
    """The task's test damage: the crc32 of ``conv_id:turn`` (nulls: one space) modulo 20 drops a row (0), empties its text (1),
    takes its ``.!?`` out (2), repeats it (3) or sets its role to user (4)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"),
                    (F.crc32(F.concat_ws(":", text("conv_id"), text("turn")).cast("binary")) % 20).alias("hit"))
    return d.where("hit <> 0").select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(
            F.col("text")).alias("text"),
        F.explode(F.when(F.col("hit") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def repair_damaged(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Damage ``rows`` and repair them: one row per ``conv_id`` of the undamaged rows, zeros and empty strings where no row is left."""
    every = rows.select("conv_id").distinct()
    fixed = repair(spark, damage(rows)).withColumnRenamed("conv_id", "__id")
    zero = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return every.join(fixed, F.col("conv_id").eqNullSafe(F.col("__id")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(zero.get(c, 0))).alias(c) for c in fixed.columns[1:]])

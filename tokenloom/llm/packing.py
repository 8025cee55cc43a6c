"""Best-fit packing: a configuration LP over the length histogram, rounded and dealt to the pieces.

1. Every text becomes token ids plus one end id; only documents above the capacity are cut, their first
   piece taking the remainder.
2. The histogram of piece lengths has at most ``capacity`` entries whatever the corpus size. On it the driver
   solves the configuration LP (which length combinations fill a sequence, and how often) by
   multiplicative weights: prices rise on lengths of which much is left, a knapsack dynamic program finds for each length the
   dearest combination that holds it. A combination takes a share of what is left, rounded to whole sequences as it is taken, if it fills a
   sequence up to the round's slack. What no combination holds is packed by largest-that-fits, again on the histogram.
3. Pieces of one length are interchangeable, so a piece needs only its rank among its length: a local
   row number in one of many hash parts plus prefix sums of the parts' counts. The rank names a slot.

Nothing but the histogram reaches the driver, and no window sees more than a part's pieces of one length.
"""

from __future__ import annotations

import base64
import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import stage, texts_of

#: Production parameters.
CAPACITY = 2048
END_ID = 0
PART_ROWS = 200_000
#: What a sequence of a round may leave empty, round after round, and the part of what is left that a combination takes at once.
SLACKS = (0.0, 0.001, 0.002, 0.005, 0.01, 0.02, 0.05)
SHARE = 4
#: Taken off the price of a piece, in tokens: of equally full combinations the one with fewer pieces, so that short ones last.
APIECE = 0.5

_ENCODERS: dict = {}


class Encoder:
    """Ids of the byte-level BPE in ``vocab`` (a tokenizers file) by the same vocabulary as ranks.

    Special strings in a text get their own id, as the tokenizers library does by default. Texts with characters
    beyond common Latin ranges go through that library itself, whose Unicode tables may differ.
    """

    def __init__(self, vocab: str, ranks: str):
        self.vocab = vocab
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(vocab, encoding="utf-8") as f:
            special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        self.special = tuple(special)
        self.fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                      special_tokens=special)
        self._exact = None

    def __call__(self, text: str) -> list:
        if not text:
            return []
        if not text.isascii() and max(text) > "ɏ":
            if self._exact is None:
                from tokenizers import Tokenizer

                self._exact = Tokenizer.from_file(self.vocab)
            return self._exact.encode(text, add_special_tokens=False).ids
        if any(s in text for s in self.special):
            return self.fast.encode(text, allowed_special="all")
        return self.fast.encode_ordinary(text)


def encoder(vocab: str, ranks: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    if (vocab, ranks) not in _ENCODERS:
        _ENCODERS[vocab, ranks] = Encoder(vocab, ranks)
    return _ENCODERS[vocab, ranks]


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocab: str | None = None, ranks: str | None = None) -> DataFrame:
    """``(doc_id, piece int, start, length, ids_crc32)`` of every document."""
    vocab = vocab or public_tokenizers.path("byte_bpe_50k.json")
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batches):
        enc = encoder(vocab, ranks)
        for b in batches:
            out: tuple = ([], [], [], [], [])
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.array([*enc(text or ""), END_ID], dtype="<u4")
                first = min(len(ids), len(ids) % capacity or capacity)
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for k, (a, z) in enumerate(zip(cuts, cuts[1:])):
                    for col, v in zip(out, (i, k, a, z - a, zlib.crc32(ids[a:z].tobytes()))):
                        col.append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _columns(lengths: np.ndarray, price: np.ndarray, left: np.ndarray, capacity: int) -> list:
    """For every length, the dearest combination that holds it: ``[{index: copies}]``.

    One knapsack by dynamic programming over all capacities, with as many copies of a length as are left (split into powers of two),
    prices what fits beside each length.
    """
    most = np.minimum(left, capacity // lengths)
    of, copies = [], []
    for k, n in enumerate(most):
        c = 1
        while n > 0:
            of.append(k)
            copies.append(min(c, int(n)))
            n -= c
            c *= 2
    size = [int(lengths[k]) * c for k, c in zip(of, copies)]
    value, take = np.zeros(capacity + 1), np.zeros((len(of), capacity + 1), bool)
    for i, (k, c) in enumerate(zip(of, copies)):
        more = value[:capacity + 1 - size[i]] + price[k] * c
        np.greater(more, value[size[i]:], out=take[i, size[i]:])
        np.maximum(more, value[size[i]:], out=value[size[i]:])
    room = capacity - lengths
    combos = [{k: 1} for k in range(len(lengths))]
    for i in range(len(of) - 1, -1, -1):
        hit = np.flatnonzero(take[i, room])
        room[hit] -= size[i]
        for j in hit.tolist():
            combos[j][of[i]] = combos[j].get(of[i], 0) + copies[i]
    return combos


def _largest_fits(lengths: np.ndarray, left: np.ndarray, capacity: int) -> dict:
    """The largest length left, then again and again the largest that still fits."""
    combo, room = {}, capacity
    for k in range(len(lengths) - 1, -1, -1):
        if left[k] and lengths[k] <= room:
            combo[k] = int(min(left[k], room // lengths[k]))
            room -= combo[k] * int(lengths[k])
    return combo


def solve(histogram: dict, capacity: int = CAPACITY, slacks: tuple = SLACKS) -> tuple[list, int]:
    """``([({length: copies}, sequences)], pieces placed by the program)``; the plan holds every piece of ``{length: pieces}`` once.

    The rest is placed by largest-that-fits combinations.
    """
    plan = [({capacity: 1}, histogram[capacity])] if histogram.get(capacity) else []
    every = np.array(sorted(x for x, n in histogram.items() if n and x < capacity), dtype=np.int64)
    need = np.array([histogram[int(x)] for x in every], dtype=np.int64)
    left = need.copy()
    for slack in slacks:
        while left.any():
            on = np.flatnonzero(left)
            lengths = every[on]
            # multiplicative weights: a token's price rises where more of a length is left, by as much as the round's slack lets
            # a dearer combination be less full
            price = lengths * np.exp(max(slack, 1e-4) * left[on] / need[on]) - APIECE
            chosen = 0
            for combo in reversed(_columns(lengths, price, left[on], capacity)):
                held = {int(on[k]): a for k, a in combo.items()}
                if sum(int(every[k]) * a for k, a in held.items()) < capacity * (1 - slack):
                    continue
                # whole sequences, a share of what is left at a time
                times = min(int(left[k]) // a for k, a in held.items())
                times = -(-times // SHARE)
                if times:
                    chosen += times
                    for k, a in held.items():
                        left[k] -= a * times
                    plan.append(({int(every[k]): a for k, a in held.items()}, times))
            if not chosen:
                break
    placed = int(need.sum() - left.sum()) + int(histogram.get(capacity) or 0)
    lengths = every
    while left.any():
        combo = _largest_fits(lengths, left, capacity)
        times = int(min(left[k] // a for k, a in combo.items()))
        for k, a in combo.items():
            left[k] -= a * times
        plan.append(({int(lengths[k]): a for k, a in combo.items()}, times))
    return plan, placed


class Slots:
    """Where the r-th piece of a length goes; a few numbers per entry of the plan."""

    def __init__(self, plan: list):
        rows: dict = {}
        base = 0
        for combo, times in plan:
            place = 0
            for x, a in sorted(combo.items(), reverse=True):
                rows.setdefault(x, []).append((times * a, base, a, place))
                place += x * a
            base += times
        self.sequences = base
        self.by_length = {x: (np.cumsum([0] + [r[0] for r in v]), *(np.array(c) for c in list(zip(*v))[1:]))
                          for x, v in rows.items()}

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        order = np.argsort(length, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else ():
            x = int(length[at[0]])
            ends, base, copies, place = self.by_length[x]
            r = rank[at]
            e = np.searchsorted(ends, r, side="right") - 1
            k = r - ends[e]
            seq[at] = base[e] + k // copies[e]
            off[at] = place[e] + k % copies[e] * x
        return seq, off


def pack(spark: SparkSession, docs: DataFrame, capacity: int = CAPACITY, vocab: str | None = None,
         ranks: str | None = None) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset`` beside the columns of :func:`pieces`.

    A null or empty text is one piece of one id. Rows that repeat a document are packed each for itself. No documents
    give no rows.
    """
    p = stage(spark, pieces(docs, capacity, vocab, ranks), "pieces")
    histogram = {r["length"]: r["n"] for r in p.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = Slots(solve(histogram, capacity)[0])
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(histogram.values()) // PART_ROWS)
    p = p.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n_parts)).cast("int"))
    counts = p.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    local = Window.partitionBy("part", "length").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (p.withColumn("local", F.row_number().over(local) - 1).join(counts, ["part", "length"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("local")).alias("rank")))
    held = spark.sparkContext.broadcast(slots)

    def place(batches):
        for b in batches:
            seq, off = held.value.find(b.column("length").to_numpy(), b.column("rank").to_numpy())
            cols = [b.column(i) for i in range(5)] + [pa.array(seq), pa.array(off)]
            yield pa.RecordBatch.from_arrays(cols, names=[*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")

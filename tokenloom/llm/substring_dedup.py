"""Substring dedup: repeated word windows by prefix-partitioned suffix trees.

A window of ``WINDOW`` words is a suffix cut at that depth; it repeats if its node at that depth in the suffix tree of all texts
has a second leaf. The tree is never built whole. Suffixes are split by prefixes of growing length into groups of bounded size:

1. A short prefix: of a suffix's first ``WINDOW`` words, the ``GRAM``-word run with the smallest hash. Neighbouring suffixes
   mostly share the run, so they travel as one span of text and the run's hash is the first group key. A run that occurs once in the corpus proves
   that none of its suffixes repeats.
2. The whole span: spans of one group with equal words are one branch. A group with one branch needs no text: all its suffixes
   repeat.
3. Groups of up to ``SUBTREE`` branches are built in memory: suffixes are named level by level (1, 2, 4, .. words) until depth ``WINDOW``, where
   a node with two leaves is a repeat. In groups with more branches, the prefix grows to the full window, whose hash alone is counted.

Runs of repeated suffixes are the maximal repeats; all words they cover go. Spans with equal words are counted by partial aggregates before any
text moves, so a passage in a third of all documents costs one row per map task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.llm.common import gram_hashes, id_of, mix64, powers, stage, texts_of, unstage, word_hashes

#: Production parameters.
WINDOW = 35
GRAM = 8
SUBTREE = 256
ROWS_AT_ONCE = 8192


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (width - have)], x[width - have:]) if have < width else x


def spans(words: np.ndarray, window: int, gram: int) -> tuple:
    """Of a text's word hashes: ``(run hash, first window, windows, span hash)`` per span."""
    n = len(words) - window + 1
    if n <= 0:
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    g = gram_hashes(words, gram)
    # the smallest hash, the leftmost of equal ones: upper bits of the hash, then the place
    bits = np.uint64(max(1, int(len(g)).bit_length()))
    packed = (g >> bits << bits) | np.arange(len(g), dtype=np.uint64)
    at = (_sliding_min(packed, window - gram + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    count = np.diff(np.append(first, n))
    up, back = powers(len(words))
    total = np.r_[np.uint64(0), np.cumsum(words * up[:len(words)])]
    length = count + window - 1
    span = mix64((total[first + length] - total[first]) * back[first] + length.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
                 + (at[first] - first).astype(np.uint64))
    return g[at[first]], first, count, span


def _rows(docs: DataFrame) -> DataFrame:
    """``(rid, id, text)``: rows that agree in id and text share ``rid`` and are treated alike."""
    d = docs.select(id_of().alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return d.select(F.xxhash64("id", "text").alias("rid"), "id", "text")


def all_spans(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """``(run, span, rid, first int, count int)`` of every text."""

    def run(batches):
        for b in batches:
            out: tuple = ([], [], [], [], [])
            for rid, text in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                g, first, count, span = spans(word_hashes(text), window, gram)
                if len(g):
                    for col, v in zip(out, (g.view(np.int64), span.view(np.int64), np.full(len(g), rid), first, count)):
                        col.append(v)
            if out[0]:
                cols = [np.concatenate(c) for c in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2]), pa.array(cols[3].astype(np.int32)),
                     pa.array(cols[4].astype(np.int32))], names=["run", "span", "rid", "first", "count"])

    return rows.select("rid", "text").mapInArrow(run, "run long, span long, rid long, first int, count int")


def _span_words(rows: DataFrame, reps: DataFrame, window: int) -> DataFrame:
    """``(run, span, rid, first, count, large, alone, words binary)``: word hashes of the wanted spans, read from the texts."""
    wanted = reps.groupBy("rid").agg(F.collect_list(F.struct("run", "span", "first", "count", "large", "alone")).alias("wanted"))

    def run(batches):
        for b in batches:
            out = []
            for rid, text, wanted in zip(b.column(0).to_pylist(), texts_of(b.column(1)), b.column(2).to_pylist()):
                words = word_hashes(text)
                for w in wanted:
                    w["rid"], w["words"] = rid, words[w["first"]:w["first"] + w["count"] + window - 1].tobytes()
                    out.append(w)
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("run", pa.int64()), ("span", pa.int64()), ("rid", pa.int64()), ("first", pa.int32()), ("count", pa.int32()),
                ("large", pa.bool_()), ("alone", pa.bool_()), ("words", pa.binary())]))

    # rows that agree in rid have the same text: one of them is enough
    texts = rows.join(wanted, "rid").select("rid", "text", "wanted")
    return texts.mapInArrow(run, "run long, span long, rid long, first int, count int, large boolean, alone boolean, words binary"
                            ).dropDuplicates(["run", "span", "rid", "first"])


def _runs(rid: np.ndarray, at: np.ndarray) -> tuple:
    """Runs of consecutive windows of one text; the input is sorted within each span."""
    start = np.flatnonzero(np.r_[True, (rid[1:] != rid[:-1]) | (at[1:] != at[:-1] + 1)])
    return rid[start], at[start], np.diff(np.append(start, len(at)))


def deep_nodes(words: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Name of the node at depth ``window`` of each suffix: refined by doubling, exact on the word hashes."""
    name = np.unique(words, return_inverse=True)[1].astype(np.uint64)
    have = 1
    while have < window:
        step = min(have, window - have)
        pair = name[:-step] * np.uint64(len(name) + 1) + name[step:] if len(name) > step else name[:0]
        name = np.unique(pair, return_inverse=True)[1].astype(np.uint64)
        have += step
    return name[starts]


def _subtrees(spans_: DataFrame, window: int) -> DataFrame:
    """``(rid, first, count)``: repeated suffixes that are alone in their branch, of groups built in memory."""

    def judge(t: pd.DataFrame) -> pa.RecordBatch:
        words = np.frombuffer(b"".join(t["words"]), np.uint64)
        count = t["count"].to_numpy(np.int64)
        base = np.cumsum(np.r_[0, count + window - 1])[:-1]
        row = np.repeat(np.arange(len(t)), count)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(np.r_[0, count])[:-1], count)
        node = deep_nodes(words, base[row] + inner, window)
        repeated = (np.bincount(node.astype(np.int64))[node.astype(np.int64)] > 1) & t["alone"].to_numpy(bool)[row]
        rid, at = t["rid"].to_numpy(np.int64)[row][repeated], (t["first"].to_numpy(np.int64)[row] + inner)[repeated]
        rid, at, n = _runs(rid, at) if len(rid) else (rid, at, at)
        return pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))],
                                          names=["rid", "first", "count"])

    def run(batches):
        held, n = [], 0
        for b in batches:
            held.append(b.to_pandas())
            n += b.num_rows
            if n >= ROWS_AT_ONCE:
                t = pd.concat(held, ignore_index=True)
                last = t["run"].iloc[-1]  # its group may go on
                done = t[t["run"] != last]
                if len(done):
                    yield judge(done)
                rest = t[t["run"] == last]
                held, n = [rest], len(rest)
        if n:
            yield judge(pd.concat(held, ignore_index=True))

    return (spans_.select("run", "rid", "first", "count", "alone", "words").repartition("run").sortWithinPartitions("run")
            .mapInArrow(run, "rid long, first int, count int"))


def _windows(spans_: DataFrame, window: int) -> DataFrame:
    """``(w1, w2, rid, at int, alone)``: one row per suffix, for groups beyond a subtree's size."""

    def run(batches):
        for b in batches:
            out: tuple = ([], [], [], [], [])
            for rid, first, count, alone, words in zip(*(b.column(c).to_pylist() for c in ("rid", "first", "count", "alone", "words"))):
                w = np.frombuffer(words, np.uint64)
                for col, v in zip(out, (gram_hashes(w, window).view(np.int64), gram_hashes(mix64(w), window).view(np.int64),
                                        np.full(count, rid), np.arange(first, first + count, dtype=np.int32), np.full(count, alone))):
                    col.append(v)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["w1", "w2", "rid", "at", "alone"])

    return spans_.mapInArrow(run, "w1 long, w2 long, rid long, at int, alone boolean")


def repeats(spark: SparkSession, rows: DataFrame, window: int = WINDOW, gram: int = GRAM, subtree: int = SUBTREE) -> DataFrame:
    """``(rid, first, count)``: runs of windows that start somewhere else too."""
    found = stage(spark, all_spans(rows, window, gram), "spans")
    groups = (found.groupBy("run").agg(F.count("*").alias("n"), F.min("span").alias("lo"), F.max("span").alias("hi"))
              .where("n > 1").select("run", (F.col("lo") == F.col("hi")).alias("single")))
    groups = stage(spark, groups, "groups")  # a table of its own: the join below can split a frequent run
    shared = stage(spark, found.join(groups, "run"), "spans")
    unstage(found)
    one = shared.where("single").select("rid", "first", "count")
    mixed = shared.where("not single")
    branches = mixed.groupBy("run", "span").agg(F.count("*").alias("n"), F.min(F.struct("rid", "first", "count")).alias("rep"))
    branches = stage(spark, branches, "branches")
    size = branches.groupBy("run").agg(F.count("*").alias("branches"))
    several = mixed.join(branches.where("n > 1").select("run", "span"), ["run", "span"], "left_semi").select("rid", "first", "count")
    # text of one representative per branch; a branch of one span is the only one whose suffixes are open
    reps = branches.join(size, "run").select(
        "run", "span", "rep.*", (F.col("branches") > subtree).alias("large"), (F.col("n") == 1).alias("alone"))
    texts = stage(spark, _span_words(rows, reps, window), "branches")
    small = _subtrees(texts.where("not large"), window)
    w = stage(spark, _windows(texts.where("large"), window), "windows")
    twice = w.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2")
    large = w.where("alone").join(twice, ["w1", "w2"], "left_semi").select("rid", F.col("at").alias("first"), F.lit(1).alias("count"))
    return one.unionAll(several).unionAll(small).unionAll(large)


_CUT = T.StructType().add("n_words", "long").add("n_removed", "long").add("kept_text", "string")


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW, gram: int = GRAM, subtree: int = SUBTREE) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text)``, one row per document.

    A word goes if a window over it also starts anywhere else, in its own text too, in the input. A null text has no
    words. Rows that agree in id and text repeat each other and both lose their windows; rows that share an id only are documents of their own.
    """
    if not 0 < gram <= window:
        raise ValueError("gram must be within the window")
    rows = _rows(docs)
    cuts = repeats(spark, rows, window, gram, subtree).groupBy("rid").agg(F.collect_list(F.struct("first", "count")).alias("cuts"))

    @F.arrow_udf(_CUT)
    def cut(text: pa.Array, cuts: pa.Array) -> pa.Array:
        total, gone, kept = [], [], []
        for t, c in zip(texts_of(text), cuts.to_pylist()):
            words = t.split()
            if c:
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, [x["first"] for x in c], 1)
                np.add.at(change, [x["first"] + x["count"] + window - 1 for x in c], -1)
                keep = (np.cumsum(change)[:-1] == 0).tolist()
                left = [x for x, k in zip(words, keep) if k]
            else:
                left = words
            total.append(len(words))
            gone.append(len(words) - len(left))
            kept.append(b" ".join(left))
        return pa.StructArray.from_arrays(
            [pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["n_words", "n_removed", "kept_text"])

    d = rows.join(cuts, "rid", "left").select("id", cut("text", "cuts").alias("c"))
    return d.select(F.when(F.col("id") != F.lit((1 << 63) - 1), F.col("id")).alias("doc_id"), "c.n_words", "c.n_removed", "c.kept_text")

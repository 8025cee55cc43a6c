"""Language ID: script ranges narrow the candidates, Viterbi with a switching penalty labels word spans.

Training counts hashed character n-grams of the letters of words, over a bounded sample of labelled documents (about
``TRAIN_DOCS`` per language, chosen by id hash) and the scripts of each language's letters. A word scores, for each
language that uses its script, the naive-Bayes log likelihood of its n-grams over the number of n-gram sizes. Viterbi over the words of a
document, where a change of language costs ``SWITCH``, gives spans; the language with most letters is the document's.

The model has ``BUCKETS`` numbers per language, whatever the corpus. Prediction reads the text only, in place, whole, with
no shuffle.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.llm.common import portions, texts_of

#: Production parameters.
TRAIN_DOCS = 2000
FOLDS = 5
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
GRAMS = (1, 2, 3, 4)
ALPHA = 0.3
SWITCH = 12.0
MIN_SCRIPT_SHARE = 0.02
MAX_LANGS = 500
#: Bytes of text whose n-grams are scored at once, and bytes times languages that share a Viterbi run.
CHARS_AT_ONCE = 400_000
NUMBERS_AT_ONCE = 16_000_000

UND = "und"

#: First code points of the Unicode blocks that tell scripts apart.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "asian"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"),
    (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0x20000, "han"),
)
_STARTS = [s for s, _ in SCRIPTS]


@functools.cache
def _letters() -> np.ndarray:
    """Script number + 1 of every code point that is a letter, else 0."""
    starts = np.array([x for x, _ in SCRIPTS])
    names = sorted({name for _, name in SCRIPTS})
    number = np.array([names.index(name) + 1 for _, name in SCRIPTS], np.uint8)
    out = number[np.searchsorted(starts, np.arange(0x110000), side="right") - 1]
    out[[not chr(c).isalpha() for c in range(0x110000)]] = 0
    return out


N_SCRIPTS = len({name for _, name in SCRIPTS})
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """Words of some texts and their letters' n-grams, all as arrays.

    ``lengths``: words per text; ``letters``: letters per word; ``script``: script number of its first letter, -1 without
    one; ``spelled``: places in the letter sequence where words with letters start, each with a mark before it.
    """

    def __init__(self, texts: list):
        low = [(t or b"").decode("utf-8", "replace").lower() for t in texts]
        codes = np.frombuffer("\n".join(low).encode("utf-32-le", "replace"), np.uint32)
        inside = ~((codes == 32) | ((codes >= 9) & (codes <= 13)))
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        at = np.cumsum([0] + [len(t) + 1 for t in low])
        starts = np.flatnonzero(begins)
        self.lengths = np.diff(np.searchsorted(starts, at))
        kind = _letters()[codes]
        place = np.flatnonzero(kind)
        word = (np.cumsum(begins) - 1)[place]
        n = len(starts)
        self.letters = np.bincount(word, minlength=n) if len(word) else np.zeros(n, np.int64)
        first = np.r_[True, word[1:] != word[:-1]] if len(word) else np.zeros(0, bool)
        self.script = np.full(n, -1)
        self.script[word[first]] = kind[place[first]] - 1
        self.scripts = np.bincount(kind[place] - 1, minlength=N_SCRIPTS) if len(place) else np.zeros(N_SCRIPTS, np.int64)
        rank = np.cumsum(first)
        self.sequence = np.zeros(len(place) + int(first.sum()) + len(GRAMS), np.uint64)
        self.sequence[np.arange(len(place)) + rank] = codes[place]
        self.spelled = np.flatnonzero(first) + np.arange(int(first.sum()))

    def grams(self):
        """``(valid, bucket)`` for each n-gram size, by the place where the n-gram starts; marks only at its ends."""
        seq = self.sequence
        size = len(seq) - len(GRAMS)
        h, inner = np.zeros(size, np.uint64), np.ones(size, bool)
        for n in GRAMS:
            here = seq[n - 1:n - 1 + size]
            if n > 2:
                inner &= seq[n - 2:n - 2 + size] != 0
            h = (h + here + np.uint64(1)) * _MIX
            yield (here != 0 if n == 1 else inner), ((h ^ (h >> np.uint64(31))) * _MIX >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def is_held_out(doc_id) -> F.Column:
    """crc32 of the id as text, mod 5, is 0; a null id isn't held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


@dataclass
class LanguageModel:
    """``langs`` in code-point order; ``logp[bucket, lang]``; ``usable[script, lang]``."""

    langs: list
    logp: np.ndarray
    usable: np.ndarray
    switch: float = SWITCH

    def scores(self, w: Words) -> np.ndarray:
        """One row per word: log likelihood per language less the best one's; zero without letters."""
        out = np.zeros((len(w.letters), len(self.langs)), np.float32)
        if not len(w.spelled) or not self.langs:
            return out
        table = np.concatenate([self.logp, np.zeros((1, len(self.langs)), np.float32)])
        total = np.zeros((len(w.sequence) - len(GRAMS), len(self.langs)), np.float32)
        for valid, bucket in w.grams():
            bucket[~valid] = BUCKETS
            total += table.take(bucket, axis=0)
        score = np.add.reduceat(total, w.spelled, axis=0) / np.float32(len(GRAMS))
        words = np.flatnonzero(w.letters)
        fits = self.usable[w.script[words]]
        narrowed = fits.any(axis=1)
        score -= np.where(fits | ~narrowed[:, None], score, -np.inf).max(axis=1, keepdims=True)
        score[narrowed[:, None] & ~fits] = -4 * self.switch - 100
        out[words] = score
        return out


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """Best label of every word; texts of different lengths advance together, longest first."""
    n, k = scores.shape
    labels = np.zeros(n, np.int16)
    if not n or not k:
        return labels
    order = np.argsort(-lengths, kind="stable")
    steps = int(lengths[order[0]])
    active = np.searchsorted(-lengths[order], -np.arange(1, steps + 1), side="right")  # texts with a word at step t
    base = np.concatenate([[0], np.cumsum(active)])
    # by step, then text: a step is a slice
    rank = np.empty(len(lengths), np.int64)
    rank[order] = np.arange(len(lengths))
    step = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    place = base[step] + np.repeat(rank, lengths)
    v = np.empty_like(scores)
    v[place] = scores
    for t in range(1, steps):
        a = active[t]
        before = v[base[t - 1]:base[t - 1] + a]
        v[base[t]:base[t] + a] += np.maximum(before, before.max(axis=1, keepdims=True) - switch)
    best, source = v.max(axis=1), v.argmax(axis=1).astype(np.int16)
    found = np.empty(n, np.int16)
    now = np.zeros(active[0], np.int16)
    rows = np.arange(active[0])
    for t in range(steps - 1, -1, -1):
        a, at = active[t], slice(base[t], base[t] + active[t])
        more = active[t + 1] if t + 1 < steps else 0
        now[more:a] = source[at][more:]
        if more:  # texts that go on keep their label unless the best one here pays for the switch
            stay = now[:more]
            jump = best[at][:more] - switch > v[at][rows[:more], stay]
            now[:more] = np.where(jump, source[at][:more], stay)
        found[at] = now[:a]
    labels[:] = found[place]
    return labels


def train(spark: SparkSession, docs: DataFrame, train_docs: int = TRAIN_DOCS) -> LanguageModel:
    """Model of the labelled documents outside the held-out fold."""
    usable = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out(F.col("doc_id")))
    sizes = sorted((r["lang"], r["n"]) for r in usable.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGS + 1).collect())
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    langs = [lang for lang, _ in sizes]
    if not langs:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros((N_SCRIPTS, 0), bool))
    share = F.create_map(*[F.lit(x) for lang, n in sizes for x in (lang, min(1.0, train_docs / n))])
    sample = usable.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * (1 << 20))
    index = {lang: i for i, lang in enumerate(langs)}

    def count(batches):
        totals: dict = {}
        for b in batches:
            of = np.array([index[x] for x in b.column(0).to_pylist()], np.int64)
            texts = texts_of(b.column(1))
            for k in np.unique(of):
                dense = totals.setdefault(int(k), np.zeros(BUCKETS + N_SCRIPTS, np.int64))
                for part in portions([texts[i] for i in np.flatnonzero(of == k)], CHARS_AT_ONCE):
                    w = Words(part)
                    dense[BUCKETS:] += w.scripts
                    for valid, bucket in w.grams():
                        dense[:BUCKETS] += np.bincount(bucket[valid], minlength=BUCKETS)
        for k, dense in totals.items():
            at = np.flatnonzero(dense)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(dense[at])], names=["k", "at", "n"])

    rows = sample.select("lang", "text").mapInArrow(count, "k int, at int, n long").groupBy("k", "at").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((BUCKETS + N_SCRIPTS, len(langs)))
    counts[rows["at"].to_numpy(np.int64), rows["k"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    counts, scripts = counts[:BUCKETS], counts[BUCKETS:]
    logp = np.log(counts + ALPHA) - np.log(counts.sum(axis=0, keepdims=True) + ALPHA * BUCKETS)
    return LanguageModel(langs, logp.astype(np.float32), scripts > MIN_SCRIPT_SHARE * np.maximum(scripts.sum(axis=0, keepdims=True), 1))


_OUT = T.StructType().add("lang_pred", "string").add("score", "double").add(
    "spans", T.ArrayType(T.StructType().add("first", "integer").add("words", "integer").add("lang", "string")))


def labeller(spark: SparkSession, model: LanguageModel, spans: bool = True):
    """A function from a text column to a struct of ``lang_pred``, ``score`` and ``spans`` (empty unless asked for)."""
    held = spark.sparkContext.broadcast(model)

    @F.arrow_udf(_OUT)
    def run(col: pa.Array) -> pa.Array:
        m, parts = held.value, []
        for part in portions(texts_of(col), NUMBERS_AT_ONCE // max(1, len(m.langs))):
            parts.append(_judge(m, part, spans))
        names, scores, found = ([x for p in parts for x in p[i]] for i in range(3))
        kind = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(found, kind)],
                                          names=["lang_pred", "score", "spans"])

    return lambda col: run(F.col(col).cast("string"))


def predict(spark: SparkSession, docs: DataFrame, model: LanguageModel, spans: bool = True) -> DataFrame:
    """``docs`` plus ``lang_pred``, ``score`` and ``spans`` (first word, number of words, language).

    ``score`` is the share of the text's letters in ``lang_pred``; ties go to the language that is
    first in code-point order. Null texts, texts without a letter, and any text under a model without languages are
    ``und`` with score 0. Columns of the added names are replaced.
    """
    return (docs.withColumn("__l", labeller(spark, model, spans)("text"))
            .withColumns({c: F.col(f"__l.{c}") for c in ("lang_pred", "score", "spans")}).drop("__l"))


def _judge(m: LanguageModel, texts: list, spans: bool) -> tuple:
    scores, letters, lengths = [], [], []
    for part in portions(texts, max(1000, 4 * CHARS_AT_ONCE // max(4, len(m.langs)))):
        w = Words(part)
        scores.append(m.scores(w)), letters.append(w.letters), lengths.append(w.lengths)
    letters, lengths = np.concatenate(letters), np.concatenate(lengths)
    labels = viterbi(np.concatenate(scores), lengths, m.switch)
    n, k = len(texts), max(1, len(m.langs))
    doc = np.repeat(np.arange(n), lengths)
    by = np.bincount(doc * k + labels, weights=letters, minlength=n * k).reshape(n, k)
    total, top = by.sum(axis=1), by.argmax(axis=1)
    known = (total > 0) & bool(m.langs)
    names = [m.langs[t] if ok else UND for t, ok in zip(top.tolist(), known.tolist())]
    score = np.where(known, by.max(axis=1) / np.maximum(total, 1), 0.0)
    found: list = [[] for _ in texts]
    if spans:
        first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (labels[1:] != labels[:-1])]) if len(doc) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(doc)))
        begin = first - (np.cumsum(lengths) - lengths)[doc[first]]
        for d, a, z, lab in zip(doc[first].tolist(), begin.tolist(), size.tolist(), labels[first].tolist()):
            if known[d]:
                found[d].append({"first": a, "words": z, "lang": m.langs[lab]})
    return names, score, found


def identify(spark: SparkSession, docs: DataFrame, spans: bool = True) -> DataFrame:
    """Train on the documents' own labels, predict all of them; adds ``held_out`` too."""
    return predict(spark, docs.withColumn("held_out", is_held_out(F.col("doc_id"))), train(spark, docs), spans)


def keep_identified(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose language can't be told; its columns, no others."""
    model = train(spark, docs)
    if not model.langs:  # nothing was learnt, so nothing is rejected but texts without a letter
        model = LanguageModel(["any"], np.zeros((BUCKETS, 1), np.float32), np.zeros((N_SCRIPTS, 1), bool))
    return (docs.withColumn("__l", labeller(spark, model, False)("text")["lang_pred"]).where(F.col("__l") != UND).drop("__l"))

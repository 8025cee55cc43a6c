"""LM scoring by cross-entropy difference.

Two matched bigram models, one of a target corpus and one of the background, share one vocabulary: the distinct lower-cased
words of both, ``WORDS`` at least. A token's probability is its bigram count smoothed toward its unigram probability with weight
``PRIOR``. A document's score is its mean per-token loss under the target model less that under the background: negative is
closer to the target. Every word and every bigram has its own count, so what is counted grows with the corpora:

1. Word counts are summed by Spark and stored. The ``COMMON`` most frequent words and all with ``BUCKET`` occurrences or more go to every
   worker with their counts.
2. Bigrams of two of the ``DENSE`` most frequent words have a counter each in one array and are scored where the text is, so no
   bigram that is left is frequent enough to make a hot key.
3. All other bigrams are summed per portion of text and sent, with the documents that hold them, to one of many buckets: by
   both words if the second is common, else by the second alone. A bucket sees every bigram it holds in
   either corpus, and every occurrence of a word that isn't common, so it has exact counts. It returns one row per portion, the sums of
   losses of the portion's documents packed in arrays; a portion's rows are added up in one small group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.common import dense_counts, mix64, portions, stage, texts_of, unstage, word_hashes

#: Production parameters.
WORDS = 1 << 17
PRIOR = 200.0
ALPHA = 0.5
COMMON = (1 << 16) - 3  # with two marks and the start, a code has 16 bits; more words make it longer
DENSE = 1 << 10
#: Tokens sent at once by a task, and tokens that a bucket is meant for.
PORTION = 1 << 19
BUCKET = 1 << 20

_START = np.uint64(0x51A27)
#: In place of the word before: the word ends its document.
_END = np.uint64(0xE2D)
_PART = "row long, keys binary, here binary, doc binary, target binary, background binary"
_LOSS = "key long, n long, target double, background double"
_SENT = ("bucket long, kind int, row long, words binary, rare_words binary, pairs binary, left binary, rare_left binary, count binary, "
         "posts binary, doc binary, n binary, keys binary, here binary")


#: Put between texts that are hashed at once: a byte that UTF-8 doesn't have, as a word.
_BREAK = b" \xff "
_BREAK_WORD = word_hashes(_BREAK)[0]


def tokens(texts: list) -> tuple:
    """``(size, first, word)``: words per text, where the texts that have words begin, hashes of all words in order."""
    h = word_hashes(_BREAK.join([t or b"" for t in texts]).lower())
    at = np.flatnonzero(h == _BREAK_WORD)
    if len(at) == len(texts) - 1:
        size, word = np.diff(np.r_[-1, at, len(h)]) - 1, np.delete(h, at)
    else:  # a text that isn't UTF-8 holds the break
        parts = [word_hashes((t or b"").lower()) for t in texts]
        size, word = np.array([len(x) for x in parts], np.int64), np.concatenate(parts)
    return size, (np.cumsum(size) - size)[size > 0], word


def before(x: np.ndarray, first: np.ndarray, start) -> np.ndarray:
    """The value of the token before each token; ``start`` where a text begins."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[first] = start
    return out


def _both(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    return left * np.uint64(0x9E3779B97F4A7C15) ^ word


def _starts(*cols: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    return np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in cols], axis=0)][:len(cols[0])])


def _pack(a: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as the largest needs."""
    kind = np.min_scalar_type(int(a.max(initial=0)))
    return bytes([kind.itemsize]) + a.astype(kind).tobytes()


def _unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(b, f"u{b[0]}", offset=1)


def word_counts(docs: DataFrame, kind: int) -> DataFrame:
    """``(kind, word, n, left)``: occurrences of each word, and as the word before another, per portion."""

    def sums(texts):
        size, first, word = tokens(texts)
        # every token comes before another but a text's last, and the start comes before every text's first
        last = word[np.cumsum(size)[size > 0] - 1]
        word.sort()
        at = _starts(word)
        name, n = word[at], np.diff(np.append(at, len(word)))
        left = n - np.bincount(np.searchsorted(name, last), minlength=len(n))
        name, n, left = np.append(name, _START), np.append(n, 0), np.append(left, len(first))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int32)), pa.array(name.view(np.int64)), pa.array(n),
                                           pa.array(left)], names=["kind", "word", "n", "left"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            for text in texts_of(b.column(0)):
                held.append(text)
                size += len(text or b"") // 6
                if size >= 4 * PORTION:
                    yield sums(held)
                    held, size = [], 0
        if held:
            yield sums(held)

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "kind int, word long, n long, left long")


class Common:
    """The most frequent words in order of their hashes, their exact counts in either corpus, and the dense bigram counts.

    ``n`` and ``left`` have a row for each model; ``rank`` is a word's row and column in ``dense``, -1 for none.
    """

    def __init__(self, rows: pd.DataFrame, tokens: tuple, vocabulary: int, dense: int):
        rows = rows.assign(word=rows["word"].to_numpy(np.int64).view(np.uint64)).sort_values("word", ignore_index=True)
        self.word = rows["word"].to_numpy(np.uint64)
        self.n = rows[["n0", "n1"]].to_numpy(np.int64).T
        self.left = rows[["left0", "left1"]].to_numpy(np.int64).T
        self.tokens, self.vocabulary = tokens, vocabulary
        self.rank = np.full(len(rows), -1)
        top = np.lexsort((self.word, -rows["seen"].to_numpy(np.int64)))[:dense]
        self.rank[top] = np.arange(len(top))
        self.width = len(top)
        self.dense = None
        # a word is looked for among those with the same leading bits: four slots or more a word
        bits = len(self.word).bit_length() + 2
        self.shift = np.uint64(64 - bits)
        self.slot = np.searchsorted(self.word >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, word: np.ndarray) -> np.ndarray:
        """Place among the common words, -1 for others."""
        out = np.full(len(word), -1)
        slot = (word >> self.shift).astype(np.int64)
        at, end = self.slot[slot], self.slot[slot + 1]
        rest = np.flatnonzero(at < end)
        while len(rest):
            here = at[rest]
            same = self.word[here] == word[rest]
            out[rest[same]] = here[same]
            rest = rest[~same]
            at[rest] += 1
            rest = rest[at[rest] < end[rest]]
        return out

    def decode(self, codes: bytes, rare: bytes) -> np.ndarray:
        """Words from their places among the common words plus 2; 1 is the end, 0 a word of ``rare``."""
        c = _unpack(codes).astype(np.int64)
        out = np.full(len(c), _END)
        out[c > 1] = self.word[c[c > 1] - 2]
        out[c == 0] = np.frombuffer(rare, np.uint64)
        return out

    def places(self, first: np.ndarray, word: np.ndarray) -> tuple:
        """Places of the words before and of the words among the common ones, and of the bigrams in the dense counts, -1 for others."""
        at, start = self.find(word), self.find(np.array([_START]))[0]
        # the last of the ranks, -1, is for other words
        rank = np.append(self.rank, -1)
        b = rank[at]
        a = before(b, first, rank[start])
        return before(at, first, start), at, np.where((a >= 0) & (b >= 0), a * self.width + b, -1)

    def gain(self, model: int, pair: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Logarithm of the smoothed bigram count; the loss is that of the word before less this."""
        one = (word + ALPHA) / (self.tokens[model] + ALPHA * self.vocabulary)
        return np.log(pair + PRIOR * one)


def _dense(docs: DataFrame, held) -> np.ndarray:
    def count(texts, total):
        for part in portions(texts, 6 * PORTION):
            _, first, word = tokens(part)
            cell = held.value.places(first, word)[2]
            np.add.at(total, cell[cell >= 0], 1)

    width = held.value.width
    return dense_counts(docs.select(F.col("text").cast("string")), max(1, width * width), count)


def _send(docs: DataFrame, kind: int, held, buckets: int) -> DataFrame:
    """Bigrams without a dense counter by bucket. ``kind``: 1 for the target's texts, 2 for the background's, 4 for texts to score."""

    def portion(texts, keys, number):
        # rows of a portion have numbers of their own
        row = (TaskContext.get().partitionId() << 20 | number) << 22
        common = held.value
        size, first, word = tokens(texts)
        left, doc = before(word, first, _START), np.repeat(np.arange(len(size)), size)
        left_at, word_at, cell = common.places(first, word)
        if kind & 4:
            sums, known, inside = [], left_at >= 0, cell >= 0
            for m in range(2):
                loss = np.zeros(len(word))
                loss[known] = np.log(common.left[m][left_at[known]] + PRIOR)
                loss[inside] -= common.gain(m, common.dense[m][cell[inside]], common.n[m][word_at[inside]])
                sums.append(np.bincount(doc, loss, len(size)))
            yield {"bucket": int(keys[0]) % buckets, "kind": kind, "row": row, "keys": keys.tobytes(),
                   "here": np.concatenate([size.astype(np.float64), *sums]).tobytes()}
        # what a rare word adds as the word before is added where the word is counted, unless it is the last
        last = np.cumsum(size)[size > 0] - 1
        last = last[word_at[last] < 0]
        go = np.concatenate([np.flatnonzero(cell < 0), last])
        if not len(go):
            return
        w, d, lf = word[go], doc[go], left[go]
        rare = word_at[go] < 0
        codes = np.stack([np.where(rare, 0, word_at[go] + 2), np.where(left_at[go] < 0, 0, left_at[go] + 2)])
        mark = len(go) - len(last)
        lf[mark:], codes[1, mark:] = _END, 1
        bucket = (mix64(np.where(rare, w, _both(lf, w))) % np.uint64(buckets)).astype(np.int64)
        # by bucket, then by the leading bits of the words: a bigram that another cuts in two is sent as two. Stable, so documents stay in order
        free = 64 - buckets.bit_length()
        half = free // 2
        order = np.argsort(bucket.astype(np.uint64) << np.uint64(free) | w >> np.uint64(64 - half) << np.uint64(free - half)
                           | lf >> np.uint64(64 - free + half), kind="stable")
        w, d, lf, bucket, codes = w[order], d[order], lf[order], bucket[order], codes[:, order]
        post = _starts(bucket, w, lf, d)
        n = np.diff(np.append(post, len(w)))
        w, d, lf, bucket, codes = w[post], d[post], lf[post], bucket[post], codes[:, post]
        pair = _starts(bucket, w, lf)
        edge = np.append(pair, len(w))
        posts, count = np.diff(edge), np.add.reduceat(n, pair)
        first = _starts(bucket[pair])
        for a, z in zip(first, np.append(first[1:], len(pair))):
            at = pair[a:z]
            group = _starts(w[at])
            of, ahead = codes[0, at[group]], codes[1, at]
            out = {"bucket": int(bucket[at[0]]), "kind": kind, "row": row, "words": _pack(of), "rare_words": w[at[group]][of == 0].tobytes(),
                   "pairs": _pack(np.diff(np.append(group, z - a))), "left": _pack(ahead), "rare_left": lf[at][ahead == 0].tobytes(),
                   "count": _pack(count[a:z])}
            if kind & 4:
                out |= {"posts": _pack(posts[a:z]), "doc": _pack(d[edge[a]:edge[z]]), "n": _pack(n[edge[a]:edge[z]])}
            yield out

    schema = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("row", pa.int64()),
                        *((c.split()[0], pa.binary()) for c in _SENT.split(", ")[3:])])

    def run(batches):
        texts, keys, size, number = [], [], 0, 0

        def done():
            rows = list(portion(texts, np.array(keys, np.int64), number))
            for i in range(0, len(rows), 256):
                yield pa.RecordBatch.from_pylist(rows[i:i + 256], schema=schema)

        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), texts_of(b.column(1))):
                texts.append(text)
                keys.append(key)
                size += len(text or b"") // 6 + 1
                if size >= PORTION:
                    yield from done()
                    texts, keys, size, number = [], [], 0, number + 1
        if texts:
            yield from done()

    return docs.select(_key(), F.col("text").cast("string")).mapInArrow(run, _SENT)


def _key():
    """Rows of equal texts have the same losses: the text names them."""
    return F.xxhash64(F.col("text").cast("string")).alias("key")


def _judge(held):
    """Losses of a bucket's bigrams, summed per document: one row per portion."""

    def judge(t: pd.DataFrame) -> pd.DataFrame:
        common = held.value
        local = t["here"].notna().to_numpy()
        out = [(row, keys, here, None, None, None) for row, keys, here in zip(t["row"][local], t["keys"][local], t["here"][local])]
        rows = t[~local]
        if len(rows):
            word = np.concatenate([np.repeat(common.decode(w, r), _unpack(p))
                                   for w, r, p in zip(rows["words"], rows["rare_words"], rows["pairs"])])
            lefts = [common.decode(x, r) for x, r in zip(rows["left"], rows["rare_left"])]
            left, size = np.concatenate(lefts), [len(x) for x in lefts]
            count = np.concatenate([_unpack(x).astype(np.int64) for x in rows["count"]])
            kind = np.repeat(rows["kind"].to_numpy(), size)
            # equal bigrams together, then bigrams by their word
            name = mix64(_both(left, word))
            order = np.argsort(name)
            pair = _starts(name[order])
            by_word = np.argsort(word[order[pair]])
            w, lf = word[order[pair]][by_word], left[order[pair]][by_word]
            group = _starts(w)
            of_word = np.repeat(np.arange(len(group)), np.diff(np.append(group, len(pair))))
            end, at = lf == _END, common.find(w[group])
            value = np.empty((2, len(pair)))
            for m in range(2):
                c = np.add.reduceat(np.where(kind[order] & (m + 1), count[order], 0), pair)[by_word]
                n = np.add.reduceat(np.where(end, 0, c), group)
                ahead = n - np.add.reduceat(np.where(end, c, 0), group)
                if len(common.word):
                    n = np.where(at >= 0, common.n[m][at], n)
                # the losses of the tokens after a rare word hold this
                next_ = np.where(at >= 0, 0.0, np.log(ahead + PRIOR))[of_word]
                value[m, by_word] = np.where(end, -next_, next_ - common.gain(m, c, n[of_word]))
            named = np.empty(len(word), np.int64)
            named[order] = np.repeat(np.arange(len(pair)), np.diff(np.append(pair, len(word))))
            at = np.cumsum([0, *size])
            for r, a, z in zip(rows.itertuples(), at, at[1:]):
                if r.kind & 4:
                    doc = _unpack(r.doc)
                    of, n = np.repeat(named[a:z], _unpack(r.posts)), _unpack(r.n)
                    sums = [np.bincount(doc, value[m][of] * n) for m in range(2)]
                    own = np.flatnonzero(np.bincount(doc))
                    out.append((r.row, None, None, _pack(own), *(x[own].tobytes() for x in sums)))
        return pd.DataFrame(out, columns=[x.split()[0] for x in _PART.split(", ")])

    return judge


def _portion_sums(t: pd.DataFrame) -> pd.DataFrame:
    """The documents of a portion with what its own row and its buckets give them."""
    here = t["here"].notna().to_numpy()
    n, *sums = np.frombuffer(t["here"][here].iloc[0]).reshape(3, -1).copy()
    for doc, *parts in t.loc[~here, ["doc", "target", "background"]].itertuples(index=False):
        at = _unpack(doc)
        for total, part in zip(sums, parts):
            total[at] += np.frombuffer(part)
    return pd.DataFrame({"key": np.frombuffer(t["keys"][here].iloc[0], np.int64), "n": n.astype(np.int64),
                         "target": sums[0], "background": sums[1]})


def _common(spark: SparkSession, corpora: list, common: int, dense: int, bucket: int = BUCKET) -> Common:
    """Counts every word of ``[(docs, kind)]``."""
    counts = None
    for docs, kind in corpora:
        c = word_counts(docs, kind)
        counts = c if counts is None else counts.unionAll(c)
    of = lambda c, m: F.sum(F.when(F.col("kind").bitwiseAND(m + 1) > 0, F.col(c)).otherwise(0)).alias(f"{c}{m}")
    words = stage(spark, counts.groupBy("word").agg(of("n", 0), of("n", 1), of("left", 0), of("left", 1), F.sum("n").alias("seen")), "words")
    total = words.agg(F.sum("n0").alias("a"), F.sum("n1").alias("b"), F.sum((F.col("n0") + F.col("n1") > 0).cast("long")).alias("v")).head()
    # the lowest count of which all words fit, by eighths of powers of two; a word that fills a bucket is common in any case
    level = F.floor(F.log2(F.col("seen")) * 8).cast("int")
    room, least = common, None
    for r in words.where("seen > 0").groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        if r["count"] > room and r["level"] < 8 * np.log2(bucket):
            break
        room, least = room - r["count"], r["level"]
    start = F.col("word") == int(_START)
    rows = words.where(start | (level >= least) if least is not None else start).toPandas()
    rows.loc[rows["word"] == int(_START), "seen"] = rows["seen"].max() if len(rows) else 0
    unstage(words)
    return Common(rows, (total["a"] or 0, total["b"] or 0), max(WORDS, (total["v"] or 0) + 1), dense)


def _scores(spark: SparkSession, docs: DataFrame, corpora: list, common: int = COMMON, dense: int = DENSE, bucket: int = BUCKET) -> DataFrame:
    """``docs`` with scores; ``corpora`` are ``[(texts, kind)]`` with kinds as in :func:`_send`."""
    known = _common(spark, corpora, common, dense, bucket)
    held = spark.sparkContext.broadcast(known)
    cells = [_dense(d, held) if kind & 3 else None for d, kind in corpora]
    known.dense = [sum((c for c, (_, kind) in zip(cells, corpora) if kind & (m + 1)), np.zeros(max(1, known.width ** 2), np.int64))
                   for m in range(2)]
    held = spark.sparkContext.broadcast(known)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(sum(known.tokens)) // bucket)
    sent = None
    for d, kind in corpora:
        s = _send(d, kind, held, buckets)
        sent = s if sent is None else sent.unionAll(s)
    sums = [F.sum(c).alias(c) for c in ("n", "target", "background")]
    parts = sent.groupBy("bucket").applyInPandas(_judge(held), _PART)
    losses = parts.groupBy("row").applyInPandas(_portion_sums, _LOSS)
    losses = losses.groupBy("key").agg(F.count("*").alias("copies"), *sums)
    mean = lambda c: F.when(F.col("n") > 0, F.col(c) / F.col("n")).otherwise(0.0)
    losses = losses.select(F.col("key").alias("__key"), F.struct(
        (F.col("n") / F.col("copies")).cast("long").alias("n_tokens"), mean("target").alias("target_loss"),
        mean("background").alias("background_loss")).alias("__s"))
    d = docs.withColumn("__key", _key()).join(losses.hint("merge"), "__key", "left").drop("__key")
    d = d.withColumns({c: F.col(f"__s.{c}") for c in ("n_tokens", "target_loss", "background_loss")}).drop("__s")
    return d.withColumn("score", F.col("target_loss") - F.col("background_loss"))


def score(spark: SparkSession, docs: DataFrame, target: DataFrame, background: DataFrame) -> DataFrame:
    """``docs`` plus ``n_tokens``, ``target_loss``, ``background_loss`` and ``score``; all use the column ``text``.

    A null text or one without words has no tokens and losses and score 0. Empty corpora give uniform models.
    Columns of the added names are replaced.
    """
    if docs is background:
        return _scores(spark, docs, [(target, 1), (docs, 6)])
    return _scores(spark, docs, [(target, 1), (background, 2), (docs, 4)])


def score_by_labels(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score all documents with those of ``labels.quality = 1`` as the target and all of them as background."""
    # labels grow with the documents: the same shuffle join at every size
    good = labels.where("quality = 1").select("doc_id").distinct().hint("merge")
    target = stage(spark, docs.join(good, "doc_id", "left_semi").select("text"), "target")
    return score(spark, docs, target, docs)

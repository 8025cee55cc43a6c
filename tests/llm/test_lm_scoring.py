import math
import random
from collections import Counter

from tokenloom.llm import lm_scoring
from tokenloom.llm.lm_scoring import score, score_by_labels


def test_matches_plain_counts(spark):
    rng = random.Random(0)
    vocab = [f"w{i}" for i in range(12)]
    docs = [(i, " ".join(rng.choices(vocab, range(1, 13), k=rng.randrange(0, 60)))) for i in range(60)] + [(100, None), (101, "W1 w1 novel")]
    target = docs[:9]
    d, t = (spark.createDataFrame(x, "doc_id long, text string") for x in (docs, target))

    def model(rows):
        word, left, pair = Counter(), Counter(), Counter()
        for _, text in rows:
            w = ["<s>", *(text or "").lower().split()]
            word.update(w[1:]), left.update(w[:-1]), pair.update(zip(w, w[1:]))
        total = sum(word.values())

        def loss(a, b):
            one = (word[b] + lm_scoring.ALPHA) / (total + lm_scoring.ALPHA * lm_scoring.WORDS)
            return -math.log((pair[a, b] + lm_scoring.PRIOR * one) / (left[a] + lm_scoring.PRIOR))
        return loss

    losses = [model(target), model(docs)]
    out = {r["doc_id"]: r for r in score(spark, d, t, d).collect()}
    assert len(out) == len(docs)
    for i, text in docs:
        w = ["<s>", *(text or "").lower().split()]
        want = [sum(f(a, b) for a, b in zip(w, w[1:])) / max(1, len(w) - 1) for f in losses]
        r = out[i]
        assert r["n_tokens"] == len(w) - 1
        assert abs(r["target_loss"] - want[0]) < 1e-3 and abs(r["background_loss"] - want[1]) < 1e-3
        assert abs(r["score"] - (want[0] - want[1])) < 2e-3


def test_prefers_the_target(spark):
    d = spark.createDataFrame([(i, "good fine words of prose here" if i % 2 else "junk 77 zz junk 9") for i in range(40)]
                              + [(None, "good fine")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)] + [(None, 1), (3, 1), (3, None)], "doc_id long, quality int")
    out = score_by_labels(spark, d, labels).collect()
    assert len(out) == 41
    good = [r["score"] for r in out if r["doc_id"] is None or r["doc_id"] % 2]
    assert max(good) < min(r["score"] for r in out if r["doc_id"] is not None and r["doc_id"] % 2 == 0)
    assert score_by_labels(spark, d.limit(0), labels.limit(0)).collect() == []


def test_every_word_and_pair_has_its_own_count(spark):
    from tokenloom.llm.common import word_hashes
    from tokenloom.llm.lm_scoring import _scores

    rng = random.Random(1)
    vocab = [f"v{i}" for i in range(3000)]
    same: dict = {}
    for v in vocab:
        same.setdefault(int(word_hashes(v.encode())[0]) % lm_scoring.WORDS, []).append(v)
    often, never = next(x for x in same.values() if len(x) > 1)[:2]  # one hash class of 2^17
    docs = [(i, " ".join(rng.choices(vocab, k=rng.randrange(0, 80)))) for i in range(40)] + [
        (50, f"{often} a " * 300), (51, f"{often} a " * 300), (52, ""), (None, None)]
    docs = [(i, t and t.replace(never, "x")) for i, t in docs]
    target, other = docs[:20] + docs[40:42], docs[10:]
    new = [(60, f"{never} a {never} a"), (61, "unseen words only"), (62, docs[3][1])]
    d, t, b = (spark.createDataFrame(x, "doc_id long, text string") for x in (docs + new, target, other))

    def model(rows):
        word, left, pair = Counter(), Counter(), Counter()
        for _, text in rows:
            w = ["<s>", *(text or "").split()]
            word.update(w[1:]), left.update(w[:-1]), pair.update(zip(w, w[1:]))
        return lambda a, c: -math.log((pair[a, c] + lm_scoring.PRIOR * (word[c] + lm_scoring.ALPHA) / (
            word.total() + lm_scoring.ALPHA * lm_scoring.WORDS)) / (left[a] + lm_scoring.PRIOR))

    losses = [model(target), model(other)]
    want = sorted((i or 0, *(sum(f(*p) for p in zip(["<s>", *(x or "").split()], (x or "").split())) / max(1, len((x or "").split()))
                             for f in losses)) for i, x in docs + new)
    # all counts where the text is, some there and some in buckets, all in buckets
    for common, dense in ((lm_scoring.COMMON, lm_scoring.DENSE), (200, 20), (1, 1)):
        out = _scores(spark, d, [(t, 1), (b, 2), (d, 4)], common, dense, bucket=100).collect()
        got = sorted((r["doc_id"] or 0, r["target_loss"], r["background_loss"]) for r in out)
        assert len(got) == len(want)
        assert all(g[0] == w[0] and max(abs(x - y) for x, y in zip(g, w)) < 1e-9 for g, w in zip(got, want))


def test_vocabulary_grows_with_the_corpora(spark):
    words = spark.range(8).selectExpr("id as doc_id", f"concat_ws(' ', transform(sequence(0, {lm_scoring.WORDS // 8}), x -> concat(id, '-', x))) as text")
    known = lm_scoring._common(spark, [(words, 6)], 100, 10)
    assert known.vocabulary == lm_scoring.WORDS + 8 + 1 and known.tokens == (0, lm_scoring.WORDS + 8)
    assert len(known.word) <= 101


def test_texts_hashed_at_once(monkeypatch):
    from tokenloom.llm.common import word_hashes

    rng = random.Random(3)
    texts = [None, b"", b" ", b"A", b"b a\tB", "É é".encode(), b"a" * 9] + [b" ".join(rng.choices([b"x", b"Y", b"zz"], k=n)) for n in (1, 50)]
    for some in (texts, texts[::-1], texts[:1], texts[3:4], [*texts, b"not \xff UTF-8"]):
        each = [word_hashes((t or b"").lower()).tolist() for t in some]
        size, first, word = lm_scoring.tokens(some)
        assert size.tolist() == [len(x) for x in each] and word.tolist() == sum(each, [])
        left = lm_scoring.before(word, first, lm_scoring._START)
        assert left.tolist() == [y for x in each for y in [int(lm_scoring._START), *x][:len(x)]]


def test_common_words_are_found():
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(5)
    for n in (0, 1, 5, 3000):
        word = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64) >> np.uint64(0 if n > 5 else 60))
        rows = pd.DataFrame({"word": word.view(np.int64), **{c: np.ones(len(word), np.int64) for c in ("n0", "n1", "left0", "left1", "seen")}})
        common = lm_scoring.Common(rows, (1, 1), 10, 4)
        asked = np.concatenate([word, word + np.uint64(1), rng.integers(0, 1 << 64, 100, dtype=np.uint64)])
        place = {int(w): i for i, w in enumerate(word)}
        assert common.find(asked).tolist() == [place.get(int(w), -1) for w in asked]

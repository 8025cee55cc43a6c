import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np

from conftest import SF01
from tokenloom.llm import language_id
from tokenloom.llm.common import table
from tokenloom.llm.language_id import identify, keep_identified, predict, train, viterbi


def test_viterbi_is_optimal():
    rng = np.random.default_rng(0)
    lengths = np.array([4, 0, 1, 6, 5])
    scores = rng.normal(size=(lengths.sum(), 3)).astype(np.float32)
    got = viterbi(scores, lengths, 1.2)
    at = 0
    for n in lengths:
        s, lab = scores[at:at + n], got[at:at + n]
        at += n
        value = lambda p: sum(s[i, p[i]] for i in range(n)) - 1.2 * sum(a != b for a, b in zip(p, p[1:]))
        assert n == 0 or abs(value(lab) - max(map(value, itertools.product(range(3), repeat=int(n))))) < 1e-4


def test_held_out_accuracy(spark):
    d = table(spark, SF01, "documents")
    out = identify(spark, d).select("doc_id", "lang", "held_out", "lang_pred", "score").collect()
    assert len(out) == 1000
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    held = [r for r in out if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.98


def training():
    rng = random.Random(0)
    say = {"aa": "kala makana hulu", "bb": "strump grotz flink", "ru": "привет мирный дом"}
    rows = [(i, " ".join(rng.choices(w.split(), k=20)), lang) for i, (lang, w) in enumerate(list(say.items()) * 8)]
    return rows, say


def test_spans_scripts_and_odd_texts(spark):
    rows, say = training()
    odd = [(100, None, None), (101, "", "aa"), (102, "123 !? 4", "aa"), (103, " ".join([say["aa"]] * 4 + [say["ru"]] * 9), None),
           (104, "дом " * 3, None), (105, "日本", None), (None, say["bb"], "bb"), (103, say["bb"], "zz") ]
    d = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumnRenamed("lang", "lang")
    model = train(spark, d.where("lang <> 'zz' or lang is null"))
    assert model.langs == ["aa", "bb", "ru"]
    out = predict(spark, d, model).collect()
    by = {(r["doc_id"], r["text"]): r for r in out}
    assert len(out) == len(rows) + len(odd)
    for i, text, _ in odd[:3]:
        assert (by[i, text]["lang_pred"], by[i, text]["score"], by[i, text]["spans"]) == ("und", 0.0, [])
    mixed = by[103, odd[3][1]]
    assert mixed["lang_pred"] == "ru" and [(s["first"], s["words"], s["lang"]) for s in mixed["spans"]] == [(0, 12, "aa"), (12, 27, "ru")]
    assert by[104, odd[4][1]]["lang_pred"] == "ru" and by[105, "日本"]["lang_pred"] in model.langs
    assert by[None, say["bb"]]["lang_pred"] == "bb"


def test_nothing_to_learn_and_filter(spark):
    d = spark.createDataFrame([(1, "words", None), (2, None, "aa"), (3, "12", None)], "doc_id long, text string, lang_pred string")
    with_lang = d.selectExpr("*", "cast(null as string) lang")
    assert {r["lang_pred"] for r in identify(spark, with_lang).collect()} == {"und"}
    kept = keep_identified(spark, with_lang)
    assert kept.columns == with_lang.columns and [r["doc_id"] for r in kept.collect()] == [1]
    assert identify(spark, with_lang.limit(0)).collect() == []
    rows, _ = training()
    kept = keep_identified(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert kept.count() == len(rows)


def test_training_sample_is_bounded(spark):
    rows, _ = training()
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert train(spark, d, train_docs=3).langs == ["aa", "bb", "ru"]


def test_portions_do_not_matter(monkeypatch):
    rng = random.Random(4)
    texts = [None, b"", b" ", "É1 x".encode()] + [" ".join(rng.choices(["ab1c", "дом", "--", "x", "İstanbul"], k=n)).encode() for n in (1, 5, 40)]
    w = language_id.Words(texts)
    assert w.lengths.tolist() == [len((t or b"").split()) for t in texts]
    assert w.letters.sum() == sum(c.isalpha() for t in texts for c in (t or b"").decode().lower())
    model = language_id.LanguageModel(["p", "q"], np.random.default_rng(0).normal(size=(language_id.BUCKETS, 2)).astype(np.float32),
                                      np.zeros((language_id.N_SCRIPTS, 2), bool))
    alone = np.concatenate([model.scores(language_id.Words([t])) for t in texts])
    assert np.allclose(model.scores(w), alone, atol=1e-4)


def plain_script(c):
    return [name for start, name in language_id.SCRIPTS if start <= ord(c)][-1]


def plain_grams(word):
    """Every run of one to four of a word's letters and its two ends, but an end alone, by hash."""
    marked = [0, *map(ord, word), 0]
    mix, whole = 0x9E3779B97F4A7C15, (1 << 64) - 1
    out = []
    for n in (1, 2, 3, 4):
        for i in range(len(marked) - n + 1):
            if marked[i:i + n] != [0]:
                h = 0
                for code in marked[i:i + n]:
                    h = (h + code + 1) * mix & whole
                out.append(((h ^ h >> 31) * mix & whole) >> 48)
    return out


def plain_words(text):
    return ["".join(c for c in w if c.isalpha()) for w in (text or "").lower().translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]


def plain_identify(rows):
    """(lang_pred, score, spans) of each (id, text, lang)."""
    learnt = [(t, lang) for i, t, lang in rows if None not in (i, t, lang) and zlib.crc32(str(i).encode()) % 5]
    langs = sorted({lang for _, lang in learnt})
    logp, usable = {}, {}
    for lang in langs:
        words = [w for t, x in learnt if x == lang for w in plain_words(t)]
        count = Counter(g for w in words for g in plain_grams(w) if w)
        total = sum(count.values()) + 0.3 * 65536
        logp[lang] = lambda g, count=count, total=total: math.log((count[g] + 0.3) / total)
        seen = Counter(plain_script(c) for w in words for c in w)
        usable[lang] = {x for x, n in seen.items() if n > 0.02 * sum(seen.values())}
    out = []
    for _, text, _ in rows:
        words = plain_words(text)
        letters = sum(map(len, words))
        if not letters:
            out.append(("und", 0.0, []))
            continue
        paths = {x: (0.0, []) for x in langs}
        for n, w in enumerate(words):
            fit = [x for x in langs if w and plain_script(w[0]) in usable[x]] or langs
            raw = {x: sum(map(logp[x], plain_grams(w))) / 4 if w else 0.0 for x in langs}
            best = max(raw[x] for x in fit)
            here = {x: raw[x] - best if x in fit else -4 * 12.0 - 100 for x in langs}
            cost = lambda x, y: 12.0 if n and x != y else 0.0
            paths = {x: max((paths[y][0] - cost(x, y) + here[x], [*paths[y][1], x]) for y in langs if n or x == y) for x in langs}
        labels = max(paths.values())[1]
        share = Counter()
        for w, x in zip(words, labels):
            share[x] += len(w)
        top = min(langs, key=lambda x: (-share[x], x))
        spans, at = [], 0
        for x, run in itertools.groupby(labels):
            size = len(list(run))
            spans.append((at, size, x))
            at += size
        out.append((top, share[top] / letters, spans))
    return out


def test_matches_plain_scoring(spark):
    rng = random.Random(8)
    say = {"aa": "kala makana hulu nani wai", "bb": "strump grotz flink ärger über", "cc": "kalo mekene hilu neni woi", "ru": "привет мирный дом река"}
    rows = []
    for i in range(60):
        lang = rng.choice(sorted(say))
        rows.append((i, " ".join(rng.choice(say[lang].split()) for _ in range(rng.randrange(3, 12))), lang))
    for i in range(60, 90):  # mixed, with marks and numbers between
        parts = [" ".join(rng.choices(say[x].split() + ["12", "--", "x1y"], k=rng.randrange(1, 9))) for x in rng.sample(sorted(say), 2)]
        rows.append((i, "\t".join(parts).title(), None))
    rows += [(100, None, "aa"), (101, "12 !", None), (102, "kala " * 3000 + "дом " * 2000, None), (None, "hulu", "bb")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    got = identify(spark, d).collect()
    want = plain_identify(rows)
    assert len(got) == len(rows)
    assert len({w[0] for w in want}) == 5 and any(len(w[2]) > 1 for w in want)
    for r, (_, text, _), (lang, score, spans) in zip(got, rows, want):
        assert (r["text"], r["lang_pred"]) == (text, lang) and abs(r["score"] - score) < 1e-9, r
        # words without letters score nothing, so a change of language may fall on either side of them
        spelled = [n for n, w in enumerate(plain_words(text)) if w]
        every = [[lang for _, words, lang in found for _ in range(words)] for found in (spans, [(s["first"], s["words"], s["lang"]) for s in r["spans"]])]
        assert len(every[0]) == len(every[1]) and [every[0][n] for n in spelled if every[0]] == [every[1][n] for n in spelled if every[1]]

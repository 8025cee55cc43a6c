import itertools
import random

import numpy as np

from brute import sha
from tokenloom.llm import fingerprints
from tokenloom.llm.fingerprints import compare, compare_edits, edited, fingerprint, likeness, signatures


def prose(rng, n):
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_equal_substrings_share_signatures():
    rng = random.Random(0)
    a, b = prose(rng, 400), prose(rng, 400)
    s = signatures([a, "xyz" + a, b + a, b, a])
    assert (s[0] == s[4]).all()
    assert likeness(s[0], s[1]) > 0.9
    assert 0.35 < likeness(s[0], s[2]) < 0.65
    assert likeness(s[0], s[3]) < 0.1


def test_batch_does_not_matter():
    rng = random.Random(1)
    texts = ["", "a", "aaaaaaaa", "ab", "abab" * 50, "é日🎉", "\n"] + [prose(rng, n) for n in (1, 3, 30, 300)]
    alone = np.concatenate([signatures([t]) for t in texts])
    assert (signatures(texts) == alone).all()
    assert not signatures([""]).any() and signatures(["a"]).any()


def test_compare_edits(spark):
    rng = random.Random(2)
    rows = [(i * 3, prose(rng, rng.randrange(1, 80))) for i in range(60)] + [(500, None), (501, ""), (502, "é🎉" * 30), (None, "last by null id")]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in compare_edits(spark, d).collect()}
    rows.sort(key=lambda r: (r[0] is None, r[0]))
    fp = lambda t: signatures([t])[0].tobytes().hex()
    assert len(got) == len(rows)
    for (i, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        t, nxt, r = t or "", nxt or "", got[i]
        e = edited(t, nxt)
        assert len(e) == len(t) - len(t) // 4 + min(len(t) // 4, len(nxt))
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (len(t), sha(e), fp(t), fp(e))
        assert r["near_edited"] == compare(fp(t), fp(e)) and r["near_next"] == compare(fp(t), fp(nxt))


def test_ties_single_and_empty(spark):
    d = spark.createDataFrame([(1, "same id one"), (1, "same id two"), (1, "same id one")], "doc_id long, text string")
    assert compare_edits(spark, d).count() == 3
    assert compare_edits(spark, d.limit(1)).collect()[0]["near_next"] == 1.0
    assert compare_edits(spark, d.limit(0)).collect() == []
    assert len({r[0] for r in d.select(fingerprint("text")).collect()}) == 2


M = (1 << 64) - 1


def _mix(x):
    x &= M
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & M
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & M
    return x ^ (x >> 31)


def plain_signature(text):
    """One text, one character at a time, with whole numbers."""
    slots = {}

    def add(name):
        h = _mix(name)
        slots[h % 128] = min(slots.get(h % 128, h), h)

    def toss(a, left, first):
        low = 0 if first or a == left else ((a ^ left) & -(a ^ left)).bit_length() - 1
        return 2 * low + (a >> low & 1)

    names, level = [ord(c) + 1 for c in text], 0
    while names:
        if level >= 2 or len(names) == 1:
            for x in names:
                add(x)
        if len(names) == 1:
            break
        level += 1
        runs = [(x, len(list(g))) for x, g in itertools.groupby(names)]
        names = [x if n == 1 else _mix(x + n * 0xD6E8FEB86659FD93) for x, n in runs]
        labels = names
        for _ in range(4):
            labels = [toss(a, labels[i - 1] if i else 0, i == 0) for i, a in enumerate(labels)]
        assert max(labels) < 6 and all(a != b for a, b in zip(labels[1:], labels[2:]))
        phrases = []
        for i, x in enumerate(names):
            peak = i > 0 and labels[i] > labels[i - 1] and (i + 1 == len(names) or labels[i] >= labels[i + 1])
            if i == 0 or peak:
                phrases.append([])
            phrases[-1].append(x)
        names = [_mix(sum(x * pow(0x9E3779B97F4A7C15, j + 1, M + 1) for j, x in enumerate(p)) + len(p) * 0xC2B2AE3D27D4EB4F + level)
                 for p in phrases]
    return [_mix(slots[i]) % 255 + 1 if i in slots else 0 for i in range(128)]


def test_against_a_plain_parse():
    rng = random.Random(11)
    texts = ["", "a", "aa", "ab", "aaaa", "abab" * 9, "\x00\x00\U0010ffff"]
    texts += ["".join(rng.choice("ab é\n𝄞") for _ in range(rng.randrange(1, 400))) for _ in range(30)]
    texts.append("word " * 3000 + "".join(chr(rng.randrange(32, 3000)) for _ in range(4000)))  # a long one
    got = fingerprints.signatures(texts)
    for t, row in zip(texts, got):
        assert row.tolist() == plain_signature(t), t[:40]
        assert (fingerprints.signatures([t])[0] == row).all()

"""Plain-Python versions of the operators, for small inputs."""

import hashlib
from collections import Counter, defaultdict


def words(text):
    return (text or "").encode().split()


def union_find(ids, links):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def line_dedup(rows):
    """rows: (id, text). Returns {row number: (lines, dropped, kept text)}."""
    key = lambda x: x.strip(b" \t\n\x0b\x0c\r").lower()
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").encode().split(b"\n"):
            holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").encode().split(b"\n")
        kept = [x for x in lines if len(key(x).decode()) < 10 or min(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), b"\n".join(kept).decode()))
    return out


def substring_dedup(rows, window):
    every = [(i, words(t)) for i, t in rows]
    count = Counter()
    for _, w in every:
        count.update(tuple(w[j:j + window]) for j in range(len(w) - window + 1))
    out = []
    for i, w in every:
        gone = set()
        for j in range(len(w) - window + 1):
            if count[tuple(w[j:j + window])] > 1:
                gone.update(range(j, j + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def shingles(text, k):
    w = [x.lower() for x in words(text)]
    k = min(k, len(w))
    return {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()


def jaccard(rows, k, num, den):
    sets = {i: shingles(t, k) for i, t in rows}
    ids, links = sorted(sets), []
    for x, i in enumerate(ids):
        for j in ids[:x]:
            a, b = sets[i], sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                links.append((i, j))
    comp = union_find(ids, links)
    return {i: (len(sets[i]), comp[i]) for i in ids}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()

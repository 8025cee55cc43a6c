"""The trie against prefixes in plain dictionaries, its arrays, and the edge cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tokenloom.llm.conversation_trie import DoubleArray, prefix_trie, rebuilt_trie

COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(convs):
    """convs: id -> list of (role, text)."""
    members = defaultdict(list)
    for i, seq in convs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(i)
    below = lambda p: [q for q in members if q[:len(p)] == p]
    saved = lambda p: (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
    children = lambda p: [q for q in members if len(q) == len(p) + 1 and q[:-1] == p]
    out = []
    for p, ids in members.items():
        ends = ",".join(str(i) for i in sorted(ids) if len(convs[i]) == len(p))
        out.append((min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), len(children(p)),
                    sum(not children(q) for q in below(p)), sum(map(saved, below(p))), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rows_of(df):
    return sorted(map(repr, (tuple(r[c] for c in COLS) for r in df.collect())))


@pytest.mark.parametrize("band, most", [(256, 1024), (2, 1), (4, 2), (3, 5)])
def test_against_dictionaries(spark, band, most):
    rng = random.Random(band)
    convs = {i: [(rng.choice("ua"), rng.choice(["x", "é", ""])) for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 9]))] for i in range(-5, 60)}
    for i in range(100, 140):  # many copies, some going on
        convs[i] = [("u", "x")] * 4 + [("a", "y")] * (i % 3 == 0)
    turns = [(i, d, r, t) for i, seq in convs.items() for d, (r, t) in enumerate(seq, 1)]
    got = prefix_trie(spark, spark.createDataFrame(turns, "conv long, place long, role string, text string"),
                      spark.createDataFrame([(i,) for i in convs], "conv long"), band, most)
    assert rows_of(got) == sorted(map(repr, brute(convs)))


def test_rebuilt_with_nulls_ties_and_clashing_names(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(25), rng.choice([None, 0, 1, 2, 3, 3, 5]), rng.choice(["user", "assistant", None]),
             rng.choice(["hi", "", None, "long " * 20000]), 1, "x", 2, "y") for _ in range(150)]
    rows += [(None, 1, "user", "lost", 1, "x", 2, "y"), (7, 3, "user", "hi", 1, "x", 2, "y")] * 2
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place long, conv string, pos int, root string")
    own = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            own[r[0]].append((r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    own = {i: [x[2:] for x in sorted(seq)] for i, seq in own.items()}
    convs = {}
    for i, seq in own.items():
        h = zlib.crc32(str(i).encode()) % 9
        convs[i] = own.get(i - i % 5, [])[:h] + seq[h:]
    assert rows_of(rebuilt_trie(spark, df)) == sorted(map(repr, brute(convs)))


def test_empty_tables(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert rebuilt_trie(spark, df).collect() == []


def test_double_array():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 9, 400)
    codes = rng.integers(0, 300, (400, 8)) * (rng.random((400, 8)) < 0.7)
    trie, levels = DoubleArray.of(codes, sizes)
    slots = {}
    for i in range(400):
        state = 0
        for level in range(sizes[i]):
            state = int(trie.step(np.array([state]), codes[i, level:level + 1])[0])
            assert state > 0 and levels[level][i] == state
            assert slots.setdefault(state, tuple(codes[i, :level + 1])) == tuple(codes[i, :level + 1])
        assert all((lv[i] == -1) for lv in levels[sizes[i]:])
    assert len(slots) == len({tuple(codes[i, :d]) for i in range(400) for d in range(1, sizes[i] + 1)}) == int((trie.check >= 0).sum())
    assert trie.step(np.array([0]), np.array([10 ** 6]))[0] == -1

import random

import numpy as np
import pytest

from brute import union_find
from tokenloom.llm import common


def test_word_hashes_name_words(monkeypatch):
    rng = random.Random(0)
    w = ["".join(rng.choice("abcé日🎉x\x1c") for _ in range(rng.randrange(1, 9))) for _ in range(2000)]
    text = "".join(x + rng.choice([" ", "\t", "\n", "  ", "\r\n", "\x0b", "\x0c "]) for x in w).encode()
    h = common.word_hashes(text)
    assert [int(x) for x in h] == [int(common.word_hashes(x)[0]) for x in text.split()]
    assert len(set(h.tolist())) == len(set(text.split()))
    monkeypatch.setattr(common, "_PORTION", 40)
    assert (common.word_hashes(text) == h).all()
    assert (common.word_hashes(b"x" * 500 + b" y")[1:] == common.word_hashes(b"y")).all()
    for empty in (None, b"", b" \n\t"):
        assert len(common.word_hashes(empty)) == 0


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(55)] + [(100 + i, 101 + i) for i in range(30)] + [(500, 500)]
    edges += [(1000, 1000 + i) for i in range(1, 200)]
    got = {r["node"]: r["comp"] for r in common.components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == union_find(linked, [(a, b) for a, b in edges if a != b])


def test_components_of_nothing(spark):
    assert common.components(spark, spark.createDataFrame([], "a long, b long")).collect() == []


def test_dense_counts(spark):
    def count(texts, total):
        for t in texts:
            np.add.at(total, np.frombuffer(t or b"", np.uint8), 1)

    d = spark.createDataFrame([("abca",), (None,), ("",), ("bé",)], "text string").repartition(3)
    total = common.dense_counts(d, 256, count)
    assert total[ord("a")] == 2 and total[ord("b")] == 2 and total.sum() == 7
    assert common.dense_counts(d.limit(0), 256, count).sum() == 0

import random

import numpy as np
import pytest

from brute import jaccard as brute
from conftest import SF01
from tokenloom.llm import jaccard_join
from tokenloom.llm.common import table
from tokenloom.llm.jaccard_join import jaccard_classes, keep_one


def sample():
    rng = random.Random(1)
    rows = []
    for _ in range(12):
        base = [rng.choice("abcdefghijklmnop") + rng.choice("xyz") for _ in range(rng.choice([4, 30, 60]))]
        for _ in range(rng.choice([1, 2, 9, 25])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = rng.choice("qrst") + str(rng.randrange(50))
            rows.append((len(rows), " ".join(w)))
    return rows + [(900, None), (901, ""), (902, "A"), (903, "a"), (904, "a b"), (905, "A\tb"), (906, "  \n"), (907, "É b c"), (908, "é b c")]


def classes(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.mark.parametrize("k,similarity,hubs", [(3, (90, 100), 24), (5, (80, 100), 1), (2, (60, 100), 3)])
def test_matches_brute_force(spark, monkeypatch, k, similarity, hubs):
    monkeypatch.setattr(jaccard_join, "ALL_HUBS", hubs)
    monkeypatch.setattr(jaccard_join, "HUBS", 1)
    rows = sample()
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert classes(jaccard_classes(spark, d, k, similarity)) == brute(rows, k, *similarity)


def test_whole_table(spark):
    d = table(spark, SF01, "documents").select("doc_id", "text")
    assert classes(jaccard_classes(spark, d)) == brute([tuple(r) for r in d.collect()], 3, 90, 100)


def test_keep_one(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long, 0), (2, long + " end", 1), (3, None, 2), (4, "", 3), (None, long, 4), (None, "other", 5), (5, long, 6), (1, long, 7), (6, "x", 8)]
    d = spark.createDataFrame(rows, "doc_id long, text string, comp long")
    kept = keep_one(spark, d)
    assert kept.columns == d.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 1, 3, 4, 6]
    assert keep_one(spark, d.limit(0)).collect() == []


def test_repeated_and_null_ids(spark):
    rows = [(1, "a b c d"), (1, "q r s t"), (2, "q r s t"), (None, "a b c d"), (None, None)]
    out = jaccard_classes(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(repr, map(tuple, out))) == sorted(map(repr, [(1, 2, 1), (1, 2, 1), (2, 2, 1), (None, 2, 1), (None, 0, None)]))


def test_keep_one_keeps_different_texts_of_an_id(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(20)) for c in "ab")
    d = spark.createDataFrame([(3, a), (7, a), (7, b), (7, b), (8, b)], "doc_id long, text string")
    assert sorted(map(tuple, keep_one(spark, d).collect())) == [(3, a), (7, b)]


def test_keep_one_moves_no_text_before_the_join(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(jaccard_join, "jaccard_classes", lambda sp, nodes, *a: seen.append(nodes) or jaccard_classes(sp, nodes, *a))
    d = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, "x")], "doc_id long, text string")
    assert sorted(map(tuple, keep_one(spark, d).collect())) == [(1, "a b c d e f"), (3, "x")]
    assert "Exchange" not in seen[0]._jdf.queryExecution().executedPlan().toString()


def test_repeated_rows_make_one_set(spark):
    d = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (1, "e f g")], "doc_id long, text string")
    wanted = spark.createDataFrame([(1,)], "id long")
    assert sorted(len(r["set"]) for r in jaccard_join._sets(d, wanted, 3).collect()) == [1, 2]


def test_levels_tell_frequent_shingles_in_a_full_sketch():
    rng = np.random.default_rng(2)
    total = rng.poisson(1 << 26, 1 << 12)  # what rare shingles put into every counter
    often = rng.choice(len(total), 40, replace=False)
    total[often] += 1 << 20  # a 64th of that
    level = jaccard_join.levels_of(total)
    others = np.delete(level, often)
    assert level[often].min() >= 19 and others.max() < 19 and (others == 0).mean() > 0.4
    assert jaccard_join.levels_of(np.zeros(8, np.int64)).tolist() == [0] * 8


def test_sketch_grows_with_the_corpus(spark, monkeypatch):
    d = spark.createDataFrame([(i, "six by te " * 600) for i in range(64)] + [(99, None)], "doc_id long, text string")
    monkeypatch.setattr(jaccard_join, "A_COUNTER", 4)
    sizes = []
    for least, most in ((1, 1 << 24), (1 << 18, 1 << 24), (1, 256)):
        monkeypatch.setattr(jaccard_join, "SKETCH", least)
        monkeypatch.setattr(jaccard_join, "SKETCH_MOST", most)
        sizes.append(jaccard_join.sketch_size(d))
    assert sizes == [1 << 14, 1 << 18, 256]
    assert jaccard_join.sketch_size(d.limit(0)) == 1


@pytest.mark.parametrize("size", [1, 64, 1 << 20])
def test_any_sketch_gives_the_same_classes(spark, monkeypatch, size):
    monkeypatch.setattr(jaccard_join, "SKETCH", size)
    monkeypatch.setattr(jaccard_join, "SKETCH_MOST", size)
    rows = sample()[:120]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert classes(jaccard_classes(spark, d, 3, (90, 100))) == brute(rows, 3, 90, 100)

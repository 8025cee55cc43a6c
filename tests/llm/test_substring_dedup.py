import random

import pytest

from brute import substring_dedup as brute
from tokenloom.llm.substring_dedup import remove_repeats


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def sample():
    rng = random.Random(3)
    passages = [[rng.choice("abcde") + rng.choice("vwxyz") for _ in range(rng.choice([6, 9, 14]))] for _ in range(5)]
    rows = []
    for i in range(120):
        w = []
        for _ in range(rng.randrange(0, 5)):
            w += [rng.choice("abc") + str(rng.randrange(9)) for _ in range(rng.randrange(0, 8))]
            w += rng.choice(passages)[:rng.randrange(3, 15)]
        rows.append((i, " ".join(w)))
    return rows + [(500, None), (501, ""), (502, "z " * 60), (503, "q r " * 40), (504, rows[3][1]), (504, rows[3][1]), (505, "\t\n"),
                   (3, "x1 x2 x3 x4 x5 x6 x7"), (506, "Z " * 9)]


@pytest.mark.parametrize("window,gram,subtree", [(6, 3, 4), (7, 2, 1), (5, 5, 100), (1, 1, 3)])
def test_matches_brute_force(spark, window, gram, subtree):
    rows = sample()
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(remove_repeats(spark, d, window, gram, subtree)) == sorted(brute(rows, window), key=repr)


def test_null_ids_and_empty_table(spark):
    text = " ".join(map(str, range(40)))
    d = spark.createDataFrame([(None, text, 1), (None, "short", 2), (7, text + " end", 3)], "doc_id long, text string, rid long")
    assert rows_of(remove_repeats(spark, d)) == sorted([(None, 40, 40, ""), (None, 1, 0, "short"), (7, 41, 40, "end")], key=repr)
    assert remove_repeats(spark, d.limit(0)).collect() == []

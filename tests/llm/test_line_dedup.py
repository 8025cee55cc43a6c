import random
import time

import numpy as np
import pytest

from brute import line_dedup as brute
from tokenloom.llm import line_dedup
from tokenloom.llm.line_dedup import CuckooFilter, LineIndex, dedup_lines, rewrite_texts

LONG = "a line that is long enough"
ROWS = [
    (3, f"{LONG}\nown words here\n{LONG}"), (1, f"  {LONG.upper()}\t\r\nshort"), (2, "short\n" + LONG + "\nshort"), (4, None), (5, ""),
    (6, "\n\n"), (7, "éééééééééé tail\nsame same same"), (8, "ÉÉÉÉÉÉÉÉÉÉ tail\nsame same same"), (9, "ééééééééé\nx" * 40),
    (10, "ééééééééé\nx"), (11, "\u00a0" + LONG), (12, "once only in here\n" * 50), (13, "0123456789"), (14, "0123456789\n012345678"),
    (15, "012345678"),
]


def rows_of(df):
    return sorted((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in df.collect())


def test_matches_brute_force(spark):
    d = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    assert rows_of(dedup_lines(spark, d)) == sorted(brute(ROWS))


def test_repeated_and_null_ids_extra_columns(spark):
    rows = [(1, LONG, "k"), (1, LONG + "\nmore of the same", "l"), (2, LONG, "m"), (None, LONG, "n"), (None, "solitary line", "o")]
    d = spark.createDataFrame(rows, "doc_id long, text string, keys string")
    out = {r["keys"]: (r["n_dropped"], r["kept_text"]) for r in dedup_lines(spark, d).collect()}
    assert out == {"k": (0, LONG), "l": (0, LONG + "\nmore of the same"), "m": (1, ""), "n": (1, ""), "o": (0, "solitary line")}
    d = d.withColumnRenamed("keys", "n_lines")
    kept = rewrite_texts(spark, d)
    assert kept.columns == d.columns and {r["n_lines"] for r in kept.collect()} == {"k", "l", "m", "n", "o"}


def test_empty_table(spark):
    assert dedup_lines(spark, spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_insert_and_delete_are_reversible(spark):
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    table = lambda i: sorted(map(tuple, i.counts.collect()))
    first, second = ROWS[:6], ROWS[6:] + [(0, LONG + "\nbrand new line")]
    one = LineIndex.of(spark, frame(first))
    both = one.insert(frame(second))
    assert rows_of(both.apply(frame(first + second))) == sorted(brute(first + second))
    back = both.delete(frame(second).select("doc_id"))
    assert table(back) == table(one)
    assert rows_of(back.apply(frame(first))) == sorted(brute(first))
    # the keeper goes: the next document keeps the line
    less = both.delete(frame([(0, ""), (1, "")]).select("doc_id"))
    left = [r for r in first + second if r[0] > 1]
    assert rows_of(less.apply(frame(left))) == sorted(brute(left))
    # keys without a reference have left their filter
    gone = back.delete(frame(first).select("doc_id"))
    assert gone.counts.count() == 0
    for r in gone.filters.collect():
        f = CuckooFilter.load(bytes(r["blob"]))
        assert r["keys"] == f.keys == 0 and not f.table.any() and not len(f.over)


def test_batches_and_growing_shards(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 3)
    rng = random.Random(5)
    rows = [(i, "\n".join(f"the line number {rng.randrange(60)} of all" for _ in range(rng.randrange(6)))) for i in range(50)]
    frame = lambda x: spark.createDataFrame(x, "doc_id long, text string")
    index = LineIndex.empty(spark, 2)
    shards = [index.shards]
    for at in range(0, 50, 10):
        index = index.insert(frame(rows[at:at + 10]))
        shards.append(index.shards)
    assert shards[-1] > shards[1] >= shards[0]
    back = index.delete(frame(rows[30:]).select("doc_id"))
    for x, some in ((index, rows), (back, rows[:30]), (LineIndex.of(spark, frame(rows), 4), rows)):
        assert rows_of(x.apply(frame(some))) == sorted(brute(some))
        counts = {(r["k1"], r["k2"]) for r in x.counts.collect()}
        total = 0
        for r in x.filters.collect():
            f = CuckooFilter.load(bytes(r["blob"]))
            total += f.keys
            assert f.keys == r["keys"] <= f.room
        assert total == len(counts)
    # a batch whose keys are known: the filters send all of them to the exact table
    again = index.insert(frame([(i + 100, t) for i, t in rows]))
    assert again.counts.count() == index.counts.count()
    assert {(r["docs"], r["lines"]) for r in again.counts.collect()} == {(2 * r["docs"], 2 * r["lines"]) for r in index.counts.collect()}


def test_cuckoo_filter():
    rng = np.random.default_rng(0)
    k = rng.integers(-2**62, 2**62, (2, 20_000))
    f = CuckooFilter(15_000)
    f.insert(*k[:, :5000])
    f.insert(*k[:, 5000:15_000])
    assert f.contains(*k[:, :15_000]).all()
    assert f.contains(*k[:, 15_000:]).mean() < 0.01
    f = CuckooFilter.load(f.dump())
    f.delete(*k[:, :10_000])
    assert f.contains(*k[:, 10_000:15_000]).all()
    assert f.contains(*k[:, :10_000]).mean() < 0.01
    assert (f.table != 0).sum() + len(f.over) == f.keys == 5000
    with pytest.raises(KeyError):
        CuckooFilter(4).delete(*k[:, :1])


def test_a_full_table_loses_no_key():
    rng = np.random.default_rng(1)
    k = rng.integers(-2**62, 2**62, (2, 40))
    k = np.concatenate([k, k[:, :1].repeat(20, axis=1)], axis=1)  # twenty keys that can't be told apart
    f = CuckooFilter(20)
    for i in range(0, 60, 7):
        f.insert(*k[:, i:i + 7])
    assert f.contains(*k).all() and len(f.over)
    f.delete(*k[:, 1:55])
    assert f.contains(*k[:, 55:]).all() and f.keys == 6 == (f.table != 0).sum() + len(f.over)
    f.delete(*k[:, 55:])
    f.delete(*k[:, :1])
    assert not f.table.any() and not len(f.over)


def test_a_million_keys_stay_exact_and_fast():
    rng = np.random.default_rng(2)
    k = rng.integers(-2**62, 2**62, (2, 1_000_000))
    f, began = CuckooFilter(1_000_000), time.perf_counter()
    for i in range(0, 1_000_000, 125_000):
        f.insert(*k[:, i:i + 125_000])
    assert time.perf_counter() - began < 30
    for i in range(0, 600_000, 60_000):
        f.delete(*k[:, i:i + 60_000])
    f.insert(*k[:, :100_000])
    assert f.contains(*k[:, 600_000:]).all() and f.contains(*k[:, :100_000]).all()
    left = np.concatenate([k[:, :100_000], k[:, 600_000:]], axis=1)
    whole = CuckooFilter(1_000_000)
    whole.insert(*left)
    names = lambda x: np.sort(np.r_[(np.minimum(*(b := (np.nonzero(x.table)[0], x._other(np.nonzero(x.table)[0], x.table[x.table != 0])))) << 16)
                                    | x.table[x.table != 0], x.over[:, 0] << 16 | x.over[:, 1]])
    assert (names(f) == names(whole)).all() and f.keys == 500_000
    f.delete(*left)
    assert not f.table.any() and not len(f.over)

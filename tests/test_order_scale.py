"""Sort-free shuffles, token-budget batches and appended positions against plain walks."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.functions import tokens as T
from tokenloom.operators import budget, position
from tokenloom.operators.append import PositionLog
from tokenloom.operators.budget import Steps, budget_batches
from tokenloom.operators.permute import grid, permuted, permuted_batches
from tokenloom.sources.files import work_dir


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 16, 17, 26, 99, 100, 101, 997, 5000])
def test_permutation_is_a_bijection(spark, n):
    a, b = grid(n)
    assert a * b >= n and a * b - n < max(a, 2)
    rows = spark.range(n).select("id", permuted("id", n, 3, 7).alias("x"), permuted("id", n, 4, 7).alias("y")).collect()
    assert sorted(r["x"] for r in rows) == sorted(r["y"] for r in rows) == list(range(n))
    if n > 90:
        x = np.array([r["x"] for r in rows])
        assert (x != [r["y"] for r in rows]).mean() > 0.9
        assert abs(np.corrcoef(np.arange(n), x)[0, 1]) < 0.35


def test_permuted_batches_need_no_shuffle(spark):
    df = spark.range(1000).withColumnRenamed("id", "pos")
    plan = permuted_batches(df, 10, 1, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    with pytest.raises(ValueError):
        permuted_batches(df.where("pos <> 5"), 10, 1, 2)


def walk(lengths, most):
    out, used, batch = [], 0, -1
    for x in lengths:
        if batch < 0 or used + x > most:
            batch, used = batch + 1, 0
        used += x
        out.append(batch)
    return out


def test_steps_against_a_walk():
    rng = random.Random(2)
    for _ in range(300):
        most = rng.choice([1, 5, 20, 100])
        parts = [np.array([rng.choice([0, 0, 1, 3, most, most + 4, rng.randrange(1, 9)]) for _ in range(rng.randrange(0, 12))], np.int64)
                 for _ in range(rng.randrange(1, 6))]
        whole = None
        for p in parts:
            s = Steps.of(p, most)
            whole = s if whole is None else whole.then(s)
        flat = [int(x) for p in parts for x in p]
        for u in range(most + 2):
            used, cuts = u, 0
            for x in flat:
                if used + x > most:
                    cuts, used = cuts + 1, 0
                used = used + x
            (got,), (n,) = whole.apply([u])
            assert (int(got), int(n)) == (min(used, most + 1), cuts)
        assert len(whole.ends) <= most + 2


@pytest.mark.parametrize("rows, most, fan", [(0, 10, 64), (1, 10, 64), (500, 50, 2), (500, 7, 3), (500, 100000, 64)])
def test_budget_batches(spark, monkeypatch, rows, most, fan):
    monkeypatch.setattr(position, "ROWS_PER_RANGE", 17)
    monkeypatch.setattr(budget, "FAN", fan)
    rng = random.Random(rows)
    data = [(f"k{i}", rng.choice([0, 1, 2, 5, 30, 60]), i) for i in range(rows)]
    df = spark.createDataFrame(rng.sample(data, rows), "key string, n int, pos int")
    got = {r["key"]: (r["n"], r["batch_id"]) for r in budget_batches(df, most, "n", ["n", "pos"], "key").collect()}
    order = sorted(data, key=lambda r: (r[1], r[2]))
    assert got == {k: (n, b) for (k, n, _), b in zip(order, walk([r[1] for r in order], most))}


def test_budget_batches_have_no_single_task(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 50).alias("n"), "id")
    plan = budget_batches(df, 100, "n", ["id"], "key")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_appended_positions(spark):
    rng = random.Random(3)
    log = PositionLog(spark, work_dir(spark, "append-test"))
    files = [[(f"{f}-{i}", i) for i in range(n)] for f, n in enumerate([13, 0, 40, 1])]
    frame = lambda rows: spark.createDataFrame(rng.sample(rows, len(rows)), "key string, line int")
    assert [log.append(frame(f), ["line"]) for f in files] == [13, 0, 40, 1] and log.size() == 54
    want = [k for f in files for k, _ in f]
    assert [r["key"] for r in log.read().orderBy("pos").collect()] == want
    # a file sent again, with one new row
    assert log.append(frame(files[2] + [("new", 99)]), ["line"]) == 1
    rows = {r["key"]: r["pos"] for r in log.read().collect()}
    assert rows == {**{k: i for i, k in enumerate(want)}, "new": 54}
    # rows of an append whose total was not stored don't count
    spark.createDataFrame([("torn", 1, 55)], "key string, line int, pos long").write.parquet(log._folder("rows") + "/run=torn")
    assert log.read().count() == 55 and log.append(frame([("next", 1)]), ["line"]) == 1
    assert log.read().where("key = 'next'").first()["pos"] == 55


def test_rows_are_worked_out_once(spark):
    df = spark.createDataFrame([([1, 2, 1025, 2049, 2050, 3, 9],), ([],), ([2048, 5],)], "t array<int>")
    text, codes = T.deinterleave("t", 1024)
    assert [tuple(r) for r in df.select(text, codes).collect()] == [([2049], [[1], [1]]), ([], [[], []]), ([], [[], []])]
    df = spark.createDataFrame([([3, 4, 5], [[1, 2], [7, 8, 9]]), ([], [[], []])], "t array<int>, c array<array<int>>")
    got = [r[0] for r in df.select(T.stage2_input("t", "c", 4)).collect()]
    assert got == [[[3, 4, 5, 1], [1024, 1024, 1024, 7]], [[1024] * 4, [1024] * 4]]
    assert df.select(T.stage2_input("t", "c", 8)).first()[0] == [[3, 4, 5, 1, 2, 1024, 1024, 1024], [1024, 1024, 1024, 7, 8, 9, 1024, 1024]]

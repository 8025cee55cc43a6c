"""Dense positions, shards, splits, batches."""

import random

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import position as P


@pytest.fixture(params=[1_000_000, 300])
def ranges(request, monkeypatch):
    monkeypatch.setattr(P, "ROWS_PER_RANGE", request.param)


def test_with_position_with_hot_key(spark, ranges):
    # a third of the rows share one order value; the unique tie-break spreads them out
    rows = [(i, 5 if i % 3 == 0 else random.Random(i).randint(0, 1000)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, v long")
    expect = {id_: p for p, (id_, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    got = P.with_position(df, ["v", "id"], out="p").collect()
    assert {r.id: r.p for r in got} == expect
    wide = df.withColumn("payload", F.lit("x"))
    joined = P.with_position(wide, ["v", "id"], out="p", key="id").collect()
    assert {r.id: r.p for r in joined} == expect and all(r.payload == "x" for r in joined)


def test_with_position_has_one_path(spark):
    df = spark.range(5).withColumnRenamed("id", "k")
    out = P.with_position(df, ["k"], out="p")
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    assert P.with_position(df.limit(0), ["k"], out="p").collect() == []


def test_with_position_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(0, 1000, 1, 4).mapInArrow(touch, "id long")
    assert P.with_position(df, ["id"], out="p").count() == 1000
    assert seen.value == 1000


def test_with_position_reused_twice_is_consistent(spark, ranges):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"))
    pos = P.with_position(df, ["k"], out="p")
    joined = pos.alias("a").join(pos.alias("b"), "k").filter(F.col("a.p") != F.col("b.p"))
    assert joined.count() == 0
    assert sorted(r.p for r in pos.collect()) == list(range(5000))


def test_shards_are_contiguous_and_balanced(spark):
    # 10 rows in 4 shards -> 3, 3, 2, 2
    df = spark.range(10).withColumnRenamed("id", "pos")
    got = P.assign_shard(df, 4).groupBy("shard").agg(F.count("*").alias("n"), F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    assert [(r.n, r.lo, r.hi) for r in got.orderBy("shard").collect()] == [(3, 0, 2), (3, 3, 5), (2, 6, 7), (2, 8, 9)]


@pytest.mark.parametrize("ids", [[1, 2, 3], [0, 1, 3], [0, 0, 2], [0, 1, None], [0, 2, 2, 2]])
def test_positions_that_are_not_dense_fail(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "pos long")
    with pytest.raises(ValueError, match="dense"):
        P.assign_shard(df, 2)
    with pytest.raises(ValueError, match="dense"):
        P.tail_split(df, 1)


def test_split_sizes_overlap():
    cases = {1300: (800, 500, 500), 1000: (500, 500, 500), 800: (300, 0, 500), 500: (0, 0, 500),
             400: (300, 300, 100), 200: (0, 0, 200)}
    for n, sizes in cases.items():
        b = P.split_bounds(n, 500, "overlap")
        assert tuple(hi - lo for lo, hi in (b["train"], b["val"], b["test"])) == sizes, n


def test_split_disjoint_has_no_leakage(spark):
    df = spark.range(1300).withColumnRenamed("id", "pos").withColumn("key", F.col("pos").cast("string"))
    s = P.tail_split(df, 500, "disjoint")
    train = s.filter("split = 'train'").select("key")
    val = s.filter("split = 'val'").select("key")
    assert val.join(train, "key", "left_semi").count() == 0
    assert s.count() == 1300
    o = P.tail_split(df, 500, "overlap")
    assert o.filter("split = 'val'").join(o.filter("split = 'train'").select("key"), "key", "left_semi").count() == 500


def test_first_wins_keeps_lowest_position(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z")], "key string, pos long, v string")
    got = {r.key: (r.pos, r.v) for r in P.first_wins(df).collect()}
    assert got == {"a": (1, "y"), "b": (2, "z")}


def test_length_sorted_batches_tie_break_by_pos(spark):
    df = spark.createDataFrame([(i, l) for i, l in enumerate([5, 3, 5, 1, 3])], "pos long, length int")
    got = P.length_sorted_batches(df, 2, "length").orderBy("sorted_pos").collect()
    assert [r.pos for r in got] == [3, 1, 4, 0, 2]
    assert [r.batch_id for r in got] == [0, 0, 1, 1, 2]


def test_with_position_null_keys_sort_first(spark, ranges):
    rows = [(i, None if i % 5 == 0 else (i * 37) % 11) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, v long")
    expect = {id_: p for p, (id_, _) in enumerate(sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0])))}
    got = P.with_position(df, ["v", "id"], out="p").collect()
    assert {r.id: r.p for r in got} == expect
    s = spark.createDataFrame([(i, None if i % 4 == 0 else f"k{i % 9}") for i in range(100)], "id long, s string")
    got = {r.id: r.p for r in P.with_position(s, ["s", "id"], out="p").collect()}
    exp = {r.id: i for i, r in enumerate(s.orderBy(F.col("s").asc_nulls_first(), "id").collect())}
    assert got == exp

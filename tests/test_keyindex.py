"""The indexed store: rows equal to the plain anti join, files skipped, Bloom filters written."""

import random

import pytest
from pyspark.sql import functions as F

from tokenloom.operators.joins import pending
from tokenloom.sources import keyindex
from tokenloom.sources.files import work_dir
from tokenloom.sources.keyindex import KeyedStore, memoize_in


@pytest.fixture()
def store(spark):
    s = KeyedStore(spark, work_dir(spark, "keyed-test"), "txt")
    for part in ("a", "b", "é"):
        s.add(spark.range(200).select(F.format_string(f"{part}/%04d", F.col("id") * 3).alias("key"), (F.col("id") * 1.5).alias("v")))
    return s


@pytest.mark.parametrize("pushed", [5000, 3])
def test_pending_equals_the_anti_join(spark, store, monkeypatch, pushed):
    monkeypatch.setattr(keyindex, "PUSHED", pushed)
    rng = random.Random(1)
    keys = [rng.choice("abcé") + f"/{rng.randrange(700):04d}" for _ in range(400)] + [None, "", "a/0000", "a/0000"]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, n int")
    want = sorted(map(tuple, pending(df, store.read()).collect()), key=repr)
    assert sorted(map(tuple, store.pending(df).select("key", "n").collect()), key=repr) == want and want


def test_only_files_that_may_hold_a_key_are_read(spark, store):
    frame = lambda *k: spark.createDataFrame([(x,) for x in k], "key string")
    assert store.files().count() == 3
    assert store.candidates(frame("a/0003", "a/0004", None)) == [p for p in store.candidates(frame("a/0003"))]
    assert len(store.candidates(frame("a/0003"))) == 1 and len(store.candidates(frame("a/0003", "é/0003"))) == 2
    assert store.candidates(frame("0", "a/9999", "zz")) == [] and store.candidates(frame()) == []
    held = store._holding(frame("b/0004", "b/0006"), ["key"])
    assert len(held.inputFiles()) == 1 and [r["key"] for r in held.collect()] == ["b/0006"]
    assert "PushedFilters: [In(key, [b/0004,b/0006])" in held._jdf.queryExecution().executedPlan().toString()


def test_files_have_bloom_filters(spark, store):
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(store.candidates(spark.createDataFrame([("a/0003",)], "key string"))[0])
    file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, spark._jsc.hadoopConfiguration())
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
    try:
        block = reader.getFooter().getBlocks().get(0)
        cols = {c.getPath().toDotString(): c for c in block.getColumns()}
        bloom = reader.readBloomFilter(cols["key"])
        has = lambda k: bloom.findHash(bloom.hash(jvm.org.apache.parquet.io.api.Binary.fromString(k)))
        assert has("a/0003") and not all(has(f"a/{i:04d}") for i in range(1, 598, 3))
        assert reader.readBloomFilter(cols["v"]) is None
    finally:
        reader.close()


def test_add_is_idempotent_and_compact_keeps_rows(spark, store, monkeypatch):
    rows = spark.createDataFrame([("a/0003", 9.0, 1), ("new", 2.0, 5), ("new", 1.0, 2), (None, 3.0, 0)], "key string, v double, pos int")
    assert store.add(rows.drop("pos")) == 1 and store.add(rows.drop("pos")) == 0
    first = KeyedStore(spark, work_dir(spark, "keyed-test"), "x")
    assert first.lookup(rows.select("key"), ["v"]).where("stored").count() == 0
    assert first.add(rows) == 2 and sorted(r["v"] for r in first.read().collect()) == [1.0, 9.0]
    assert first.add(rows.limit(0)) == 0
    monkeypatch.setattr(keyindex, "ROWS_PER_FILE", 100)
    small = store.compact()
    assert sorted(map(tuple, small.read().collect())) == sorted(map(tuple, store.read().collect()))
    files = small.files().orderBy("low").collect()
    assert len(files) > 3 and all(a["high"] < b["low"] for a, b in zip(files, files[1:]))
    monkeypatch.setattr(keyindex, "MAX_FILES", 2)
    with pytest.raises(ValueError, match="compact"):
        small.candidates(rows)


def test_memo_computes_once(spark):
    store = KeyedStore(spark, work_dir(spark, "keyed-test"), "m")
    df = spark.range(30).select(F.col("id").cast("string").alias("key"), "id")
    calls = []

    def compute(miss):
        calls.append(miss.count())
        return miss.withColumn("v", F.col("id") * 2)

    one = memoize_in(store, df.where("id < 20"), compute, "v").collect()
    two = memoize_in(store, df, compute, "v").collect()
    assert calls == [20, 10] and len(one) == 20 and sum(r["cache_hit"] for r in two) == 20
    assert all(r["v"] == 2 * r["id"] for r in two)

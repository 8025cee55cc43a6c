"""Stateful firsts: replay, late and repeated rows."""

import os

from pyspark.sql import functions as F

from tokenloom.sources.files import write_jsonl
from tokenloom.streaming import firsts


def test_lower_positions_are_reported(spark, tmp_path):
    src, store, ckpt = (str(tmp_path / x) for x in ("in", "store", "ck"))
    drops = [[("a", "x", 5), ("a", "late", 9), ("b", "y", 7), (None, "z", 1), ("c", "w", None)],
             [("a", "again", 5), ("b", "earlier", 2), ("d", "", 1), ("d", "second", 3)],
             [("b", "higher", 4), ("a", "lowest", 0), ("a", "lower", 3)]]
    for i, rows in enumerate(drops):
        write_jsonl(spark.createDataFrame(rows, "key string, text string, pos long"), os.path.join(src, f"d{i}"))
        before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
        firsts.stream_first_positions(spark, os.path.join(src, "*"), store, ckpt)
        assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    firsts.stream_first_positions(spark, os.path.join(src, "*"), store, ckpt)  # no new file
    read = lambda kind: spark.read.parquet(os.path.join(store, kind))
    assert sorted((r["key"], r["pos"]) for r in read("txt").collect()) == [("a", 5), ("b", 7), ("d", 1)]
    assert sorted((r["key"], r["pos"], r["stored"]) for r in read("earlier").collect()) == [("a", 0, 5), ("b", 2, 7)]
    # a micro-batch that is replayed replaces its folders
    batch = spark.createDataFrame([("q", "t", 1, "first", None)], firsts.OUTPUT)
    for _ in range(2):
        firsts.write_firsts(batch, 99, store)
    assert read("txt").where("key = 'q'").count() == 1
    assert read("txt").where("key = 'd'").select(F.size("tokens")).first()[0] == 1

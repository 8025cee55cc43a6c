"""Ids of long texts: batches in Arrow, bounded by bytes."""

import numpy as np
import pyarrow as pa
from pyspark.sql.types import DoubleType

from tokenloom.functions import tokens as T
from tokenloom.functions.util import cuts, list_array
from tokenloom.operators import models as U
from tokenloom.sources import keyindex
from tokenloom.sources.files import work_dir


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cuts_hold_at_most_the_limit():
    assert list(cuts(np.array([0, 3, 4, 20, 21, 22]), 5)) == [(0, 2), (2, 3), (3, 5)]
    assert list(cuts(np.array([0]), 5)) == []
    a = list_array([np.array([1, 2]), None, np.array([], int)], pa.int32())
    assert a.to_pylist() == [[1, 2], None, []]


def test_bpe_stays_in_arrow(spark):
    """a batch's ids were Python integers."""
    texts = ["ab é", None, "", f"x{U.EOT_STRING}", "long " * 300_000, "end"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string").coalesce(1)
    enc = U.bpe_encode(df, "s")
    dec = U.bpe_decode(enc)
    assert "MapInPandas" not in _plan(dec)
    got = {r["i"]: r for r in dec.collect()}
    for i, s in enumerate(texts):
        if s is None or U.EOT_STRING in s:
            assert got[i]["tokens"] is None and got[i]["decoded"] is None and got[i]["error"]
        else:
            assert got[i]["tokens"][:-1] == [b + 2049 for b in s.encode()] and got[i]["decoded"] == s + U.EOT_STRING


def test_bytes_are_widened_at_once(spark):
    """A text was split into one string per byte."""
    texts = ["a\u00e9\U0001F600", "", None, "z" * 3_000_000, "b"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string").coalesce(1)
    d = df.select("i", T.byte_tokens("s").alias("t")).select("i", "t", T.byte_decode("t").alias("d"))
    assert "split(" not in _plan(d) and "hex(" not in _plan(d)
    for r in d.collect():
        s = texts[r["i"]]
        assert r["d"] == s and r["t"] == (None if s is None else [b + 2049 for b in s.encode()] + [2305])
    odd = spark.sql("SELECT array(2048, 2049 + 65, NULL, 2305, 2049 + 66) AS t").select(T.byte_decode("t").alias("d"))
    assert odd.first()["d"] == "AB"


def test_stored_files_are_bounded_by_bytes(spark, monkeypatch):
    """up to a million rows went to one task, whatever their size."""
    monkeypatch.setattr(keyindex, "BYTES_PER_FILE", 2000)
    store = keyindex.KeyedStore(spark, work_dir(spark, "keyed-test"), "x")
    rows = spark.range(200).selectExpr("cast(id as string) AS key", "sha2(cast(id as string), 512) AS v")
    assert store.add(rows) == 200 and store.add(rows) == 0
    assert store.files().count() > 3 and store.read().count() == 200


def test_models_see_arrow_columns(spark):
    """columns that only pass through a model, and those it doesn't keep, were Python objects."""
    df = spark.createDataFrame([(1, [[1.0, 2.0]]), (2, None)], "i int, m array<array<float>>")
    out = U.map_model(df, lambda: 2.0, lambda f, p: [f * float(np.asarray(m[0]).sum()) for m in p["m"]], "v", DoubleType(), keep=["i"])
    assert "MapInPandas" not in _plan(out) and out.columns == ["i", "v", "v_error"]
    got = {r["i"]: r for r in out.collect()}
    assert got[1]["v"] == 6.0 and got[2]["v"] is None and "TypeError" in got[2]["v_error"]



"""J1 strict and lenient, J3 keys and write-back, pending/anti joins."""

import pytest

from tokenloom.operators import joins as J


def test_strict_assembly_raises_on_missing_artifact(spark):
    man = spark.createDataFrame([("a", 0), ("b", 1)], "key string, pos long")
    txt = spark.createDataFrame([("a", [1]), ("b", [2])], "key string, tokens array<int>")
    emb = spark.createDataFrame([("a", [0.5])], "key string, embedding array<float>")
    tok = spark.createDataFrame([("a", [[1]]), ("b", [[2]])], "key string, codes array<array<int>>")
    with pytest.raises(Exception, match="missing artifact for key b"):
        J.assemble_samples(man, txt, emb, tok).collect()
    assert [r.key for r in J.assemble_samples(man, txt, emb, tok, strict=False).collect()] == ["a"]
    admitted = J.admit(man, {"text": txt, "embedding": emb.unionAll(emb), "codes": tok}).collect()
    assert sorted((r.key, r.reason) for r in admitted) == [("a", None), ("b", "missing embedding")]
    missing = J.missing_artifacts(man, {"text": txt, "embedding": emb, "codes": tok}).collect()
    assert [(r.key, r.has_text, r.has_embedding, r.has_codes) for r in missing] == [("b", True, False, True)]


def test_pending_and_guidance(spark):
    man = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "key string, pos long")
    done = spark.createDataFrame([("b",)], "key string")
    assert sorted(r.key for r in J.pending(man, done).collect()) == ["a", "c"]
    cond = spark.createDataFrame([(0, 0, 2.0), (0, 1, 1.0)], "grp long, item int, logit double")
    unc = spark.createDataFrame([(0, 0, 1.0), (0, 1, 3.0)], "grp long, item int, logit double")
    got = {r.item: r.logit for r in J.guide(cond, unc, 3.0).collect()}
    assert got == {0: 3.0 * 2.0 - 2.0 * 1.0, 1: 3.0 * 1.0 - 2.0 * 3.0}


def test_memoize_by_content_and_write_back(spark, tmp_path):
    from pyspark.sql import functions as F

    from tokenloom.sources.files import read_artifact

    df = spark.createDataFrame([("a", None), ("a", ""), ("b", "x")], "t string, u string")
    run = lambda cache: J.memoize(df, cache, lambda m: m.withColumn("v", F.length("t")), "h", "v", content=["t", "u"])
    first = run(spark.createDataFrame([], "h string, v int"))
    assert first.where("not cache_hit").count() == 3 and first.select("h").distinct().count() == 3
    J.write_back(first, str(tmp_path), "cache", "h", "v")
    store = read_artifact(spark, str(tmp_path), "cache")
    twice = run(store.unionAll(store))
    assert twice.count() == 3 and twice.where("not cache_hit").count() == 0


def test_batch_shapes_join_sizes_not_arrays(spark):
    from conftest import SF001

    from tokenloom.operators.collate import batch_shape
    from tokenloom.plans.catalog import QUERIES, load_all
    from tokenloom.plans.training import batched_samples

    load_all()
    out = QUERIES["batch_shapes"](spark, SF001)
    want = batch_shape(batched_samples(spark, SF001, 16))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect())) and out.schema == want.schema
    # the joins of the samples read sizes in place of arrays
    joins, plans = 0, [out._jdf.queryExecution().optimizedPlan()]
    while plans:
        node = plans.pop()
        plans += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Join":
            joins += 1
            assert "tokens:array" not in node.schema().simpleString() and "codes:array" not in node.schema().simpleString()
    assert joins >= 3

"""Quantile sketches against exact ranks; merges in any order and grouping."""

import random

from pyspark.sql import functions as F

from tokenloom.operators import percentiles as PC


def test_rank_error_after_merging(spark):
    rng = random.Random(1)
    rows = [(f"2024-0{1 + i % 9}-{1 + i % 28:02d}", int(rng.lognormvariate(5, 1)) + 1, 1 + rng.random(), 1, rng.choice([0.0, 1.0, 9.0]))
            for i in range(60_000)]
    log = spark.createDataFrame(rows, "day string, tokens long, seconds double, model_bytes long, audio_seconds double").repartition(7)
    days = PC.day_sketches(log).cache()
    assert days.count() == len({r[0] for r in rows}) and days.agg(F.max(F.octet_length("rtf"))).first()[0] < 60_000
    months = PC.merge_sketches(days, F.substring("day", 1, 7).alias("month"))
    tokens = sorted(r[1] / r[2] for r in rows)
    rtf = sorted(r[2] / r[4] for r in rows if r[4] > 0)
    for whole in (PC.merge_sketches(days), PC.merge_sketches(months), PC.merge_sketches(PC.merge_sketches(days, F.substring("day", 9, 2).alias("d")))):
        r = whole.select("n_runs", *[PC.percentile(m, p).alias(f"{m}{p}") for m in PC.METRICS for p in (0.1, 0.5, 0.99)]).first()
        assert r["n_runs"] == len(rows)
        for m, exact in (("tokens_per_s", tokens), ("rtf", rtf)):
            for p in (0.1, 0.5, 0.99):
                rank = sum(x <= r[f"{m}{p}"] for x in exact) / len(exact)
                assert abs(rank - p) < 0.01, (m, p, rank)


def test_no_audio_and_no_runs(spark):
    log = spark.createDataFrame([("d", 10, 2.0, 1, 0.0), ("d", 30, 2.0, 1, None)],
                                "day string, tokens long, seconds double, model_bytes long, audio_seconds double")
    r = PC.merge_sketches(PC.day_sketches(log)).select("n_runs", "rtf", PC.percentile("tokens_per_s", 1.0).alias("top")).first()
    assert (r["n_runs"], r["rtf"], r["top"]) == (2, None, 15.0)
    assert PC.day_sketches(log.limit(0)).count() == 0

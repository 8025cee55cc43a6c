"""A10 percentiles: mergeable quantile sketches of run metrics, one row per day, merged upward.

A day's runs are summed up once, by partial aggregation, in a sketch of bounded size per metric. Months, years or the whole log are
merges of stored day rows; a new day adds a row and reads no old run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ("tokens_per_s", "rtf")
#: Size of a sketch: its normalised rank error is about 2.3 / K**0.9, under half a percent.
K = 1000


def run_metrics(run_log: DataFrame) -> DataFrame:
    """``run_log`` with tokens per second and real-time factor of every run; null without audio."""
    return run_log.withColumns({
        "tokens_per_s": F.col("tokens") / F.col("seconds"),
        "rtf": F.col("seconds") / F.when(F.col("audio_seconds") > 0, F.col("audio_seconds"))})


def day_sketches(run_log: DataFrame, day: str = "day", k: int = K) -> DataFrame:
    """``(day, n_runs, tokens_per_s, rtf)``: one sketch per metric and day, null where a day has no value."""
    d = run_metrics(run_log)
    return d.groupBy(day).agg(F.count(F.lit(1)).alias("n_runs"), *[
        F.when(F.count(m) > 0, F.kll_sketch_agg_double(F.col(m).cast("double"), F.lit(k))).alias(m) for m in METRICS])


def merge_sketches(sketches: DataFrame, *by: Column) -> DataFrame:
    """Rows of ``day_sketches`` (or of this) merged per ``by``; none: all of them."""
    return sketches.groupBy(*by).agg(F.sum("n_runs").alias("n_runs"), *[
        F.when(F.count(m) > 0, F.kll_merge_agg_double(m)).alias(m) for m in METRICS])


def percentile(sketch, p: float) -> Column:
    """Value at rank ``p`` of a sketch."""
    return F.kll_sketch_get_quantile_double(F.col(sketch) if isinstance(sketch, str) else sketch, F.lit(p))

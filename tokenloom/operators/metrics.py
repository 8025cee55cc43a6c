"""Run metrics: evaluation means, rank merges, reductions, loss, throughput."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.operators.position import with_position


def eval_mean_of_means(losses: DataFrame, name: str = "name", batch: str = "batch_id", rank: str = "rank",
                       value: str = "value") -> DataFrame:
    """Mean over (rank, batch) entries of each entry's mean value, per metric name.

    This is the original's (unweighted) summary; ``value_mean_weighted`` beside it weighs
    every logged value equally.
    """
    per_batch = losses.groupBy(name, rank, batch).agg(F.avg(value).alias("_tl_m"), F.count(F.lit(1)).alias("_tl_n"),
                                                      F.sum(value).alias("_tl_s"))
    return per_batch.groupBy(name).agg(
        F.avg("_tl_m").alias("value_mean"),
        (F.sum("_tl_s") / F.sum("_tl_n")).alias("value_mean_weighted"),
        F.count(F.lit(1)).alias("n_batches"),
    )


def merge_rank_lists(metrics: DataFrame, name: str = "name", rank: str = "rank", order: str = "step",
                     value: str = "value", out: str = "idx") -> DataFrame:
    """Per-rank metric lists concatenated rank after rank, kept in long form.

    ``idx`` is the position in the merged list of its name (rank-major, then ``order``):
    the dense position (O1) in (name, rank, order) less the first position of its name. First positions are one row per
    name (a partial aggregate) and meet the log in a join, so the plan doesn't grow with the names.
    """
    ranked = with_position(metrics.select(name, rank, order, value), [name, rank, order], out="_tl_g")
    first = ranked.groupBy(F.col(name).alias("_tl_name")).agg(F.min("_tl_g").alias("_tl_first"))
    return ranked.join(first, F.col(name).eqNullSafe(F.col("_tl_name"))).select(
        name, rank, order, value, (F.col("_tl_g") - F.col("_tl_first")).cast("long").alias(out))


def reduce_metrics(metrics: DataFrame, world_size: int, keys=("name", "batch_id"), value: str = "value",
                   average: bool = True) -> DataFrame:
    """Sum of a metric over ranks, divided by the world size when ``average``."""
    agg = F.sum(value)
    return metrics.groupBy(*keys).agg((agg / world_size if average and world_size > 1 else agg).alias(value))


def masked_nll(logits: DataFrame, position=("row", "head", "t"), item: str = "item", logit: str = "logit",
               target: str = "target", ignore: int = -1) -> DataFrame:
    """A9 (unreduced): cross-entropy per scored position, ``logsumexp - logit[target]``.

    A position is a window partition of at most vocabulary-size rows; the following
    grouped aggregate reuses the same partitioning, so there is one shuffle.
    """
    pos = list(position)
    w = Window.partitionBy(*pos)
    shifted = logits.filter(F.col(target) != ignore).withColumn("_tl_m", F.max(logit).over(w))
    return shifted.groupBy(*pos).agg(
        (F.first("_tl_m") + F.log(F.sum(F.exp(F.col(logit) - F.col("_tl_m"))))
         - F.max(F.when(F.col(item) == F.col(target), F.col(logit)))).alias("nll"))


def masked_nll_mean(logits: DataFrame, head: str = "head", **kw) -> DataFrame:
    """A9 (reduced): mean NLL per head over non-ignored positions; ``head = null`` row holds
    the mean over heads. A scored position whose target isn't among its items is an error."""
    per_pos = masked_nll(logits, **kw)
    known = F.when(F.col("nll").isNull(), F.raise_error(F.lit("target outside the logits")).cast("double")).otherwise(F.col("nll"))
    # per-head means and their mean in one evaluation: heads are few after the first aggregate
    per_head = per_pos.groupBy(head).agg(F.avg(known).alias("loss"))
    both = per_head.select(F.explode(F.array(F.struct(F.col(head).alias("h"), F.lit(False).alias("all"), "loss"),
                                             F.struct(F.lit(None).cast(per_head.schema[head].dataType).alias("h"),
                                                      F.lit(True).alias("all"), "loss"))).alias("x")).select("x.*")
    return both.groupBy("h", "all").agg(F.avg("loss").alias("loss")).select(F.col("h").alias(head), "loss")


def throughput_metrics(run_log: DataFrame) -> DataFrame:
    """A10: tokens/s, memory bandwidth (GB/s) and real-time factor, per run and averaged."""
    per_run = run_log.select(
        (F.col("tokens") / F.col("seconds")).alias("tokens_per_s"),
        (F.col("model_bytes") * F.col("tokens") / F.col("seconds") / 1e9).alias("bandwidth_gb_s"),
        (F.col("seconds") / F.when(F.col("audio_seconds") > 0, F.col("audio_seconds"))).alias("rtf"),
    )
    return per_run.agg(F.count(F.lit(1)).alias("n_runs"), F.avg("tokens_per_s").alias("tokens_per_s"),
                       F.avg("bandwidth_gb_s").alias("bandwidth_gb_s"), F.avg("rtf").alias("rtf"))


def metric_names(metrics: DataFrame, split: str, name: str = "name", step: str = "step") -> DataFrame:
    """Tracker metric keys ``split/name`` with the step they belong to, as ``metric`` and ``at_step``."""
    return metrics.withColumns({"metric": F.concat_ws("/", F.lit(split), F.col(name)), "at_step": F.col(step)})

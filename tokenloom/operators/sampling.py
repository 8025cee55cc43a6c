"""Distribution filtering and drawing over long logit tables.

Input is ``(grp, item, logit)``: one row per candidate. Every operator is a window
partitioned by the group (a group is bounded by the vocabulary size, so no window
partition can grow with the data) or a grouped aggregate with map-side combine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.operators.joins import guide
from tokenloom.operators.position import hash_unit


def scale_logits(df: DataFrame, temperature: float, floor: float | None = None, logit: str = "logit") -> DataFrame:
    """``logit / temperature``; the fast variant floors the temperature at ``floor``."""
    t = max(temperature, floor) if floor is not None else temperature
    return df.withColumn(logit, F.col(logit) / F.lit(float(t)))


def softmax(df: DataFrame, grp: str = "grp", logit: str = "logit", out: str = "prob") -> DataFrame:
    """``exp(l - max) / sum(exp(l - max))`` per group; -inf logits (masked) get 0."""
    w = Window.partitionBy(grp)
    m = F.max(logit).over(w)
    e = F.exp(F.col(logit) - m)
    return df.withColumn("_tl_e", e).withColumn(out, F.col("_tl_e") / F.sum("_tl_e").over(w)).drop("_tl_e")


def top_k_mask(df: DataFrame, k: int, grp: str = "grp", logit: str = "logit", drop: bool = True) -> DataFrame:
    """Keep logits >= the k-th largest of the group (ties at the border are kept).

    ``rank() <= k`` keeps exactly those rows; ``k`` larger than the group keeps all.
    With ``drop=False`` the others are kept with a -inf logit instead.
    """
    r = F.rank().over(Window.partitionBy(grp).orderBy(F.col(logit).desc()))
    if drop:
        return df.withColumn("_tl_r", r).filter(F.col("_tl_r") <= k).drop("_tl_r")
    return df.withColumn(logit, F.when(r <= k, F.col(logit)).otherwise(F.lit(float("-inf"))))


def top_p_filter(df: DataFrame, p: float, variant: str = "A", grp: str = "grp", item: str = "item",
                 prob: str = "prob", logit: str = "logit") -> DataFrame:
    """O10 nucleus filter.

    A (probabilities, descending): keep an item while the mass strictly before it is <= p;
      the first item is always kept; probabilities are renormalised.
    B (logits, ascending): drop items while the inclusive ascending mass is <= 1-p; the
      largest item is always kept; the result is re-softmaxed.
    Ties are broken by item id so both engines agree.
    """
    if variant == "A":
        w = Window.partitionBy(grp).orderBy(F.col(prob).desc(), F.col(item))
        before = F.coalesce(F.sum(prob).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
        kept = df.withColumn("_tl_before", before).filter(F.col("_tl_before") <= p).drop("_tl_before")
        return kept.withColumn(prob, F.col(prob) / F.sum(prob).over(Window.partitionBy(grp)))
    if variant == "B":
        sm = softmax(df, grp, logit, "_tl_p")
        w = Window.partitionBy(grp).orderBy(F.col(logit).asc(), F.col(item).desc())
        incl = F.sum("_tl_p").over(w.rowsBetween(Window.unboundedPreceding, 0))
        last = F.row_number().over(Window.partitionBy(grp).orderBy(F.col(logit).desc(), F.col(item)))
        kept = sm.withColumn("_tl_incl", incl).withColumn("_tl_last", last).filter(
            (F.col("_tl_incl") > 1 - p) | (F.col("_tl_last") == 1)).drop("_tl_incl", "_tl_last", "_tl_p")
        return softmax(kept, grp, logit, prob)
    raise ValueError(f"unknown top-p variant {variant!r}")


def draw_one(df: DataFrame, seed: int, grp: str = "grp", item: str = "item", prob: str = "prob",
             out: str = "drawn") -> DataFrame:
    """One weighted draw per group by an exponential race, ``argmin(-ln(u)/p)``.

    ``u`` comes from md5(grp:item:seed), so reruns (and other engines) draw the same item.
    ``min_by`` is a partial aggregate: no group is ever collected into one task.
    """
    u = hash_unit(grp, item, F.lit(str(seed)))
    key = -F.log(F.greatest(u, F.lit(1e-300))) / F.col(prob)
    return (df.filter(F.col(prob) > 0).withColumn("_tl_k", key)
            .groupBy(grp).agg(F.min_by(F.col(item), F.struct(F.col("_tl_k"), F.col(item))).alias(out)))


def sample_tokens(cond: DataFrame, uncond: DataFrame | None, *, guidance: float | None, temperature: float,
                  top_k: int | None, top_p: float | None, seed: int, variant: str = "A",
                  grp: str = "grp", item: str = "item") -> DataFrame:
    """Guidance -> temperature -> top-k -> softmax -> top-p -> draw.

    Variant A rejects top-k together with top-p; variant B applies top-k then top-p and
    floors the temperature at 1e-5.
    """
    if variant == "A" and top_k is not None and top_p is not None:
        raise ValueError("variant A takes either top_k or top_p")
    df = guide(cond, uncond, guidance, (grp, item)) if guidance is not None else cond
    df = scale_logits(df, temperature, 1e-5 if variant == "B" else None)
    if top_k is not None:
        df = top_k_mask(df, top_k, grp)
    if top_p is not None and variant == "B":
        df = top_p_filter(df, top_p, "B", grp, item)
    else:
        df = softmax(df, grp)
        if top_p is not None:
            df = top_p_filter(df, top_p, "A", grp, item)
    return draw_one(df, seed, grp, item)


def double_batch(df: DataFrame, embedding: str = "embedding", out: str = "copy") -> DataFrame:
    """Each row twice; the second copy (``copy = 1``) is unconditional (null embedding)."""
    dup = df.withColumn(out, F.explode(F.array(F.lit(0), F.lit(1))))
    return dup.withColumn(embedding, F.when(F.col(out) == 0, F.col(embedding)))


def embedding_dropout(df: DataFrame, p: float, seed: int, key: str = "key", embedding: str = "embedding") -> DataFrame:
    """Zero the embedding of rows whose md5-uniform draw is below ``p``."""
    u = hash_unit(key, F.lit(str(seed)))
    zero = F.lit(0.0).cast("float")
    return df.withColumn(embedding, F.when(u < p, F.transform(embedding, lambda x: x * zero)).otherwise(F.col(embedding)))

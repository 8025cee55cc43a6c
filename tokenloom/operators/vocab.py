"""Distribution operators over per-row logit arrays (O8-O11, T15, T16 array form).

When a row already holds the whole vocabulary as ``array<double>`` (the usual shape of
model output), nothing needs to be exploded or shuffled: every operator is a projection.
Per-row scalars (max, sum, k-th value, nucleus size) are first stored in helper columns
so that the element lambdas read them in O(1) -- an expression over the whole array
inside an element lambda would be re-evaluated for every element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEG_INF = float("-inf")


def _tmp(df: DataFrame, name: str, expr: Column) -> DataFrame:
    return df.withColumn(name, expr)


def scale(df: DataFrame, logits: str, temperature: float, floor: float | None = None) -> DataFrame:
    """Divide every logit by the temperature (optionally floored)."""
    t = float(max(temperature, floor) if floor is not None else temperature)
    return df.withColumn(logits, F.transform(logits, lambda x: x / t))


def softmax(df: DataFrame, logits: str, out: str = "probs") -> DataFrame:
    """Max-shifted softmax of each row's array; -inf entries get probability 0."""
    d = _tmp(df, "_tl_m", F.array_max(logits))
    d = d.withColumn("_tl_e", F.transform(logits, lambda x: F.exp(x - F.col("_tl_m"))))
    d = d.withColumn("_tl_s", F.aggregate("_tl_e", F.lit(0.0), lambda a, x: a + x))
    return d.withColumn(out, F.transform("_tl_e", lambda x: x / F.col("_tl_s"))).drop("_tl_m", "_tl_e", "_tl_s")


def top_k(df: DataFrame, logits: str, k: int) -> DataFrame:
    """Entries below the k-th largest become -inf (ties at the border kept)."""
    d = _tmp(df, "_tl_th", F.element_at(F.sort_array(logits, asc=False), F.least(F.lit(k), F.size(logits))))
    return d.withColumn(logits, F.transform(logits, lambda x: F.when(x >= F.col("_tl_th"), x)
                                            .otherwise(F.lit(NEG_INF)))).drop("_tl_th")


def _ranked(arr: str) -> Column:
    """(value desc, index asc) order as an array of structs."""
    pairs = F.transform(arr, lambda x, i: F.struct((-x).alias("nv"), i.alias("i"), x.alias("v")))
    return F.array_sort(pairs)


def top_p(df: DataFrame, probs: str, p: float) -> DataFrame:
    """O10 A on probabilities: keep entries while the mass strictly before them is <= p
    (the first always), zero the rest, renormalise. One sort and one pass per row."""
    d = _tmp(df, "_tl_r", _ranked(probs))
    # prefix sums grow, so the kept count is 1 + #{m >= 1 : prefix(m) <= p} (capped at size)
    acc = F.aggregate("_tl_r", F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n")),
                      lambda a, x: F.struct((a["s"] + x["v"]).alias("s"),
                                            (a["n"] + F.when(a["s"] + x["v"] <= p, 1).otherwise(0)).alias("n")))
    d = d.withColumn("_tl_k", F.least(acc["n"] + 1, F.size("_tl_r")))
    d = d.withColumn("_tl_last", F.element_at("_tl_r", F.col("_tl_k")))
    kept = F.transform(probs, lambda x, i: F.when(
        (x > F.col("_tl_last")["v"]) | ((x == F.col("_tl_last")["v"]) & (i <= F.col("_tl_last")["i"])), x)
        .otherwise(F.lit(0.0)))
    d = d.withColumn(probs, kept).withColumn("_tl_s", F.aggregate(probs, F.lit(0.0), lambda a, x: a + x))
    return d.withColumn(probs, F.transform(probs, lambda x: x / F.col("_tl_s"))).drop("_tl_r", "_tl_k", "_tl_last", "_tl_s")


def guide(df: DataFrame, cond: str, uncond: str, scale_by: float, out: str = "logits") -> DataFrame:
    """Classifier-free guidance ``g*cond + (1-g)*uncond`` element by element."""
    g = F.lit(float(scale_by))
    return df.withColumn(out, F.zip_with(cond, uncond, lambda c, u: g * c + (F.lit(1.0) - g) * u))


def top_p_b(df: DataFrame, logits: str, p: float, out: str = "probs") -> DataFrame:
    """O10 B on logits: from the smallest up, drop entries while their inclusive mass is <= 1-p (the
    largest always stays), then softmax of what is left. One sort and one pass per row."""
    d = softmax(df, logits, "_tl_p")
    ranked = F.array_sort(F.zip_with(logits, F.transform("_tl_p", lambda x, i: F.struct(x.alias("p"), i.alias("i"))),
                                     lambda v, q: F.struct((-v).alias("nv"), q["i"].alias("i"), q["p"].alias("p"))))
    d = d.withColumn("_tl_r", ranked)
    dropped = F.aggregate(F.reverse("_tl_r"), F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n")),
                          lambda a, x: F.struct((a["s"] + x["p"]).alias("s"),
                                                (a["n"] + F.when(a["s"] + x["p"] <= 1 - p, 1).otherwise(0)).alias("n")))["n"]
    d = d.withColumn("_tl_last", F.element_at("_tl_r", F.greatest(F.size("_tl_r") - dropped, F.lit(1))))
    d = d.withColumn(logits, F.transform(logits, lambda x, i: F.when(
        (-x < F.col("_tl_last")["nv"]) | ((-x == F.col("_tl_last")["nv"]) & (i <= F.col("_tl_last")["i"])), x)
        .otherwise(F.lit(NEG_INF))))
    return softmax(d.drop("_tl_p", "_tl_r", "_tl_last"), logits, out)


def sample(df: DataFrame, cond: str, uncond: str | None, *, guidance: float | None, temperature: float,
           k: int | None, p: float | None, seed: int, variant: str = "A", grp: str = "grp", out: str = "drawn") -> DataFrame:
    """T16 on arrays: guidance -> temperature -> top-k -> softmax -> top-p -> draw, a projection throughout.

    Variant A takes either top-k or top-p; variant B applies top-k then top-p and floors the temperature at 1e-5.
    """
    if variant not in ("A", "B"):
        raise ValueError(f"unknown variant {variant!r}")
    if variant == "A" and k is not None and p is not None:
        raise ValueError("variant A takes either top_k or top_p")
    d = guide(df, cond, uncond, guidance, "_tl_l") if guidance is not None else df.withColumn("_tl_l", F.col(cond))
    d = scale(d, "_tl_l", temperature, 1e-5 if variant == "B" else None)
    if k is not None:
        d = top_k(d, "_tl_l", k)
    if p is not None and variant == "B":
        d = top_p_b(d, "_tl_l", p, "_tl_q")
    else:
        d = softmax(d, "_tl_l", "_tl_q")
        if p is not None:
            d = top_p(d, "_tl_q", p)
    return draw(d, "_tl_q", seed, grp, out).drop("_tl_l", "_tl_q")


def draw(df: DataFrame, probs: str, seed: int, grp: str, out: str = "drawn") -> DataFrame:
    """Exponential race per row, ``argmin(-ln(u_i)/p_i)`` with ``u_i`` from
    md5(grp:i:seed) -- the same draw as the long-table form."""
    def key(x, i):
        s = F.concat_ws(":", F.col(grp).cast("string"), i.cast("string"), F.lit(str(seed)))
        u = F.conv(F.substring(F.md5(s), 1, 13), 16, 10).cast("double") / float(16 ** 13)
        return F.when(x > 0, -F.log(F.greatest(u, F.lit(1e-300))) / x)
    keyed = F.transform(probs, lambda x, i: F.struct(key(x, i).alias("k"), i.alias("i")))
    best = F.array_min(F.filter(keyed, lambda s: s["k"].isNotNull()))
    return df.withColumn(out, best["i"])

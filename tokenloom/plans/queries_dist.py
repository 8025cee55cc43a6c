"""Registered queries: distributions and losses."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.operators import sampling as S
from tokenloom.operators.joins import guide
from tokenloom.operators.metrics import masked_nll_mean
from tokenloom.plans import duck as D
from tokenloom.plans.catalog import register
from tokenloom.sources import tables as TB

_SCORES = "SELECT vec_id AS grp, unnest(range(64))::INTEGER AS item, unnest(embedding)::DOUBLE AS logit FROM embeddings"
_UNCOND = ("SELECT vec_id AS grp, unnest(range(64))::INTEGER AS item, unnest(list_reverse(embedding))::DOUBLE AS logit "
           "FROM embeddings")


def _softmax_sql(src: str, out: str = "prob") -> str:
    return f"""SELECT *, exp(logit - max(logit) OVER (PARTITION BY grp))
  / sum(exp(logit - max(logit) OVER (PARTITION BY grp))) OVER (PARTITION BY grp) AS {out} FROM ({src})"""


def _sm2(src: str) -> str:
    # softmax in two steps (window functions cannot nest in DuckDB)
    return f"""SELECT grp, item, logit, e / sum(e) OVER (PARTITION BY grp) AS prob FROM (
  SELECT grp, item, logit, exp(logit - max(logit) OVER (PARTITION BY grp)) AS e FROM ({src}))"""


def _top_p_a_sql(src: str, p: float) -> str:
    return f"""SELECT grp, item, prob / sum(prob) OVER (PARTITION BY grp) AS prob FROM (
  SELECT grp, item, prob, coalesce(sum(prob) OVER (PARTITION BY grp ORDER BY prob DESC, item
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ({src})) WHERE before <= {p}"""


def _top_p_b_sql(src: str, p: float) -> str:
    kept = f"""SELECT grp, item, logit FROM (
  SELECT grp, item, logit, sum(prob) OVER (PARTITION BY grp ORDER BY logit ASC, item DESC
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS incl,
    row_number() OVER (PARTITION BY grp ORDER BY logit DESC, item) AS top FROM ({_sm2(src)}))
  WHERE incl > {1 - p} OR top = 1"""
    return _sm2(kept)


def _draw_sql(src: str, seed: int) -> str:
    u = D.unit(f"CAST(grp AS VARCHAR) || ':' || CAST(item AS VARCHAR) || ':{seed}'")
    return f"""SELECT grp, arg_min(item, (k, item)) AS drawn FROM (
  SELECT grp, item, -ln(greatest({u}, 1e-300)) / prob AS k FROM ({src}) WHERE prob > 0) GROUP BY grp"""


def _r6(c: str) -> F.Column:
    return F.round(c, 6).alias(c)


@register("softmax_scores", f"SELECT grp, item, round(prob, 6) AS prob FROM ({_sm2(_SCORES)})")
def q_softmax_scores(spark, sf):
    return S.softmax(TB.scores(spark, sf)).select("grp", "item", _r6("prob"))


_TIED = "SELECT grp, item, floor(logit * 10) / 10 AS logit FROM ({})".format(_SCORES)


@register("top_k_scores", f"""SELECT grp, item, logit FROM (
  SELECT *, rank() OVER (PARTITION BY grp ORDER BY logit DESC) AS r FROM ({_TIED})) WHERE r <= 5""")
def q_top_k_scores(spark, sf):
    s = TB.scores(spark, sf).withColumn("logit", F.floor(F.col("logit") * 10) / 10)
    return S.top_k_mask(s, 5).select("grp", "item", "logit")


@register("top_p_a", f"SELECT grp, item, round(prob, 6) AS prob FROM ({_top_p_a_sql(_sm2(_SCORES), 0.5)})")
def q_top_p_a(spark, sf):
    return S.top_p_filter(S.softmax(TB.scores(spark, sf)), 0.5, "A").select("grp", "item", _r6("prob"))


@register("top_p_b", f"SELECT grp, item, round(prob, 6) AS prob FROM ({_top_p_b_sql(_SCORES, 0.5)})")
def q_top_p_b(spark, sf):
    return S.top_p_filter(TB.scores(spark, sf), 0.5, "B").select("grp", "item", _r6("prob"))


@register("drawn_tokens", _draw_sql(_sm2(_SCORES), 1))
def q_drawn_tokens(spark, sf):
    return S.draw_one(S.softmax(TB.scores(spark, sf)), seed=1)


@register("scaled_logits", f"SELECT grp, item, round(logit / 0.7, 6) AS logit FROM ({_SCORES})")
def q_scaled_logits(spark, sf):
    return S.scale_logits(TB.scores(spark, sf), 0.7).select("grp", "item", _r6("logit"))


_GUIDED = f"""SELECT c.grp, c.item, 3.0 * c.logit + (1.0 - 3.0) * u.logit AS logit
FROM ({_SCORES}) c JOIN ({_UNCOND}) u USING (grp, item)"""


@register("guided_scores", f"SELECT grp, item, round(logit, 6) AS logit FROM ({_GUIDED})")
def q_guided_scores(spark, sf):
    return guide(TB.scores(spark, sf), TB.scores(spark, sf, reverse=True), 3.0).select("grp", "item", _r6("logit"))


@register("sampled_tokens_a", _draw_sql(_top_p_a_sql(_sm2(_GUIDED), 0.9), 11))
def q_sampled_tokens_a(spark, sf):
    return S.sample_tokens(TB.scores(spark, sf), TB.scores(spark, sf, reverse=True), guidance=3.0, temperature=1.0,
                           top_k=None, top_p=0.9, seed=11, variant="A")


_B_IN = f"""SELECT grp, item, logit FROM (
  SELECT grp, item, logit / greatest(0.8, 1e-5) AS logit,
    rank() OVER (PARTITION BY grp ORDER BY logit DESC) AS r FROM ({_GUIDED})) WHERE r <= 20"""


@register("sampled_tokens_b", _draw_sql(_top_p_b_sql(_B_IN, 0.9), 12))
def q_sampled_tokens_b(spark, sf):
    return S.sample_tokens(TB.scores(spark, sf), TB.scores(spark, sf, reverse=True), guidance=3.0, temperature=0.8,
                           top_k=20, top_p=0.9, seed=12, variant="B")


@register("masked_nll", """WITH l AS (
  SELECT vec_id AS row, (vec_id % 2)::INTEGER AS head, (vec_id // 2)::INTEGER AS t,
    CASE WHEN vec_id % 5 = 0 THEN -1 ELSE vec_id % 64 END AS target,
    unnest(range(64)) AS item, unnest(embedding)::DOUBLE AS logit FROM embeddings),
p AS (SELECT row, head, t, max(logit) + ln(sum(exp(logit - m))) - max(CASE WHEN item = target THEN logit END) AS nll
      FROM (SELECT *, max(logit) OVER (PARTITION BY row, head, t) AS m FROM l WHERE target <> -1)
      GROUP BY row, head, t),
h AS (SELECT head, avg(nll) AS loss FROM p GROUP BY head)
SELECT head, round(loss, 6) AS loss FROM h UNION ALL SELECT NULL, round(avg(loss), 6) FROM h""")
def q_masked_nll(spark, sf):
    return masked_nll_mean(TB.token_logits(spark, sf)).select("head", _r6("loss"))


# ---------------------------------------------------------------- array form (no shuffle)

from tokenloom.operators import vocab as VA  # noqa: E402

_ARR = "SELECT vec_id AS grp, list_transform(embedding, lambda x: x::DOUBLE) AS logits FROM embeddings"


def _arrays(spark, sf):
    e = TB.table(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("grp"), F.transform("embedding", lambda x: x.cast("double")).alias("logits"))


def _both(spark, sf):
    return _arrays(spark, sf).withColumn("uncond", F.reverse("logits"))


def _regroup(sql_long: str, val: str, default: str = "0.0") -> str:
    """Long (grp, item, val) back to one 64-wide array per group (missing items -> default)."""
    return f"""SELECT a.grp, list_transform(range(64), lambda i: coalesce(list_extract(
    list_filter(a.vals, lambda s: s.item = i), 1).v, {default})) AS {val}
  FROM (SELECT grp, list({{'item': item, 'v': {val}}}) AS vals FROM ({sql_long}) GROUP BY grp) a"""


def _r6a(c: str):
    return F.transform(c, lambda x: F.round(x, 6)).alias(c)


@register("softmax_arrays", "SELECT grp, list_transform(prob, lambda x: round(x, 6)) AS probs FROM ({})".format(
    _regroup(_sm2(_SCORES), "prob")))
def q_softmax_arrays(spark, sf):
    return VA.softmax(_arrays(spark, sf), "logits").select("grp", _r6a("probs"))


@register("top_k_arrays", "SELECT grp, logit AS logits FROM ({})".format(
    _regroup(f"""SELECT grp, item, logit FROM (SELECT *, rank() OVER (PARTITION BY grp ORDER BY logit DESC) AS r
      FROM ({_SCORES})) WHERE r <= 5""", "logit", "'-inf'::DOUBLE")))
def q_top_k_arrays(spark, sf):
    return VA.top_k(_arrays(spark, sf), "logits", 5).select("grp", "logits")


@register("top_p_arrays", "SELECT grp, list_transform(prob, lambda x: round(x, 6)) AS probs FROM ({})".format(
    _regroup(_top_p_a_sql(_sm2(_SCORES), 0.5), "prob")))
def q_top_p_arrays(spark, sf):
    d = VA.top_p(VA.softmax(_arrays(spark, sf), "logits"), "probs", 0.5)
    return d.select("grp", _r6a("probs"))


@register("drawn_arrays", _draw_sql(_sm2(_SCORES), 1))
def q_drawn_arrays(spark, sf):
    d = VA.draw(VA.softmax(_arrays(spark, sf), "logits"), "probs", 1, "grp")
    return d.select("grp", F.col("drawn").cast("int").alias("drawn"))


@register("sampled_arrays", _draw_sql(_top_p_a_sql(_sm2(f"SELECT grp, item, logit / 0.7 AS logit FROM ({_SCORES})"), 0.9), 13))
def q_sampled_arrays(spark, sf):
    d = VA.scale(_arrays(spark, sf), "logits", 0.7)
    d = VA.draw(VA.top_p(VA.softmax(d, "logits"), "probs", 0.9), "probs", 13, "grp")
    return d.select("grp", F.col("drawn").cast("int").alias("drawn"))


@register("guided_arrays", "SELECT grp, list_transform(logit, lambda x: round(x, 6)) AS logits FROM ({})".format(_regroup(_GUIDED, "logit")))
def q_guided_arrays(spark, sf):
    return VA.guide(_both(spark, sf), "logits", "uncond", 3.0, "logits").select("grp", _r6a("logits"))


@register("top_p_b_arrays", "SELECT grp, list_transform(prob, lambda x: round(x, 6)) AS probs FROM ({})".format(
    _regroup(_top_p_b_sql(_SCORES, 0.5), "prob")))
def q_top_p_b_arrays(spark, sf):
    return VA.top_p_b(_arrays(spark, sf), "logits", 0.5).select("grp", _r6a("probs"))


@register("sampled_arrays_a", _draw_sql(_top_p_a_sql(_sm2(_GUIDED), 0.9), 11))
def q_sampled_arrays_a(spark, sf):
    d = VA.sample(_both(spark, sf), "logits", "uncond", guidance=3.0, temperature=1.0, k=None, p=0.9, seed=11)
    return d.select("grp", F.col("drawn").cast("int").alias("drawn"))


@register("sampled_arrays_b", _draw_sql(_top_p_b_sql(_B_IN, 0.9), 12))
def q_sampled_arrays_b(spark, sf):
    d = VA.sample(_both(spark, sf), "logits", "uncond", guidance=3.0, temperature=0.8, k=20, p=0.9, seed=12, variant="B")
    return d.select("grp", F.col("drawn").cast("int").alias("drawn"))

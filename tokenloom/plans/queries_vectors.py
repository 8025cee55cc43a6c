"""Registered queries: vectors, windows, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.operators import metrics as M
from tokenloom.operators import segments as SG
from tokenloom.operators import vectors as V
from tokenloom.plans.catalog import register
from tokenloom.sources import tables as TB


def _r6_arr(c: str) -> F.Column:
    return F.transform(c, lambda x: F.round(x, 6)).alias(c)


def _mean_norm_sql(src: str, group: str) -> str:
    return f"""WITH p AS (SELECT {group} AS g, unnest(range(64)) AS i, unnest(vec)::DOUBLE AS x FROM ({src})),
m AS (SELECT g, i, avg(x) AS mx FROM p GROUP BY g, i),
v AS (SELECT g, list(mx ORDER BY i) AS mean FROM m GROUP BY g)
SELECT g, list_transform(mean, lambda x: round(x / sqrt(list_sum(list_transform(mean, lambda y: y * y))), 6)) AS e FROM v"""


@register("utterance_embeddings", "SELECT g AS key, e AS embedding FROM ({})".format(
    _mean_norm_sql("SELECT CAST(label AS VARCHAR) AS key, embedding AS vec FROM embeddings", "key")))
def q_utterance_embeddings(spark, sf):
    return V.utterance_embedding(TB.partial_vectors(spark, sf)).select("key", _r6_arr("embedding"))


_UNIT = """SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE
  / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE)))) AS vec FROM embeddings"""


@register("normalized_embeddings", f"SELECT vec_id, list_transform(vec, lambda x: round(x, 6)) AS embedding FROM ({_UNIT})")
def q_normalized_embeddings(spark, sf):
    e = TB.table(spark, sf, "embeddings")
    return e.select("vec_id", V.l2_normalize("embedding").alias("embedding")).select("vec_id", _r6_arr("embedding"))


@register("speaker_embeddings", "SELECT g AS speaker, e AS embedding FROM ({})".format(
    _mean_norm_sql(_UNIT, "label")))
def q_speaker_embeddings(spark, sf):
    e = TB.table(spark, sf, "embeddings")
    utt = e.select(F.col("label").alias("speaker"), V.l2_normalize("embedding").alias("embedding"))
    return V.speaker_embedding(utt).select("speaker", _r6_arr("embedding"))


_UTT = "SELECT event_id AS utt_id, 8000 + (event_id * 377) % 400000 AS n_samples FROM events"
_KEPT = f"""SELECT utt_id, n_samples, CASE WHEN (n_samples - (n_win - 1) * 77 * 160)::DOUBLE / 25600 < 0.75 AND n_win > 1
  THEN n_win - 1 ELSE n_win END AS kept FROM (
  SELECT utt_id, n_samples, (greatest(1, ceil((n_samples + 1) / 160)::BIGINT - 160 + 77 + 1) - 1) // 77 + 1 AS n_win
  FROM ({_UTT}))"""


@register("segment_windows", f"""SELECT utt_id, w AS win_idx, w * 77 * 160 AS win_start, (w * 77 + 160) * 160 AS win_stop
FROM (SELECT utt_id, unnest(range(kept)) AS w FROM ({_KEPT}))""")
def q_segment_windows(spark, sf):
    w = SG.segment_windows(TB.utterances(spark, sf))
    return w.select("utt_id", F.col("win_idx").cast("long").alias("win_idx"), "win_start", "win_stop")


@register("padded_lengths", f"""SELECT utt_id, n_samples, greatest(n_samples, ((kept - 1) * 77 + 160) * 160) AS padded_samples
FROM ({_KEPT})""")
def q_padded_lengths(spark, sf):
    u = TB.utterances(spark, sf)
    return u.select("utt_id", "n_samples", SG.padded_length("n_samples").alias("padded_samples"))


_LOSS = """SELECT event_id AS step, (event_id % 4)::INTEGER AS rank, event_id // 32 AS batch_id, event_type AS name, value
FROM events"""


@register("eval_loss", f"""SELECT name, round(avg(m), 6) AS value_mean, round(sum(s) / sum(n), 6) AS value_mean_weighted,
  count(*) AS n_batches FROM (SELECT name, rank, batch_id, avg(value) AS m, sum(value) AS s, count(*) AS n
  FROM ({_LOSS}) GROUP BY ALL) GROUP BY name""")
def q_eval_loss(spark, sf):
    e = M.eval_mean_of_means(TB.losses(spark, sf))
    return e.select("name", F.round("value_mean", 6).alias("value_mean"),
                    F.round("value_mean_weighted", 6).alias("value_mean_weighted"), "n_batches")


@register("merged_rank_lists", f"""SELECT name, rank, step, value,
  row_number() OVER (PARTITION BY name ORDER BY rank, step) - 1 AS idx FROM ({_LOSS})""")
def q_merged_rank_lists(spark, sf):
    return M.merge_rank_lists(TB.losses(spark, sf))


@register("reduced_metrics", f"""SELECT name, batch_id, round(sum(value) / 4, 6) AS value FROM ({_LOSS}) GROUP BY ALL""")
def q_reduced_metrics(spark, sf):
    r = M.reduce_metrics(TB.losses(spark, sf), world_size=4)
    return r.select("name", "batch_id", F.round("value", 6).alias("value"))


@register("throughput", """SELECT count(*) AS n_runs, round(avg(tokens / seconds), 6) AS tokens_per_s,
  round(avg(model_bytes * tokens / seconds / 1e9), 6) AS bandwidth_gb_s,
  round(avg(seconds / CASE WHEN audio_seconds > 0 THEN audio_seconds END), 6) AS rtf
FROM (SELECT l_quantity::BIGINT AS tokens, 1.0 + l_discount AS seconds, 2400000000 AS model_bytes,
  l_quantity / 75.0 AS audio_seconds FROM lineitem)""")
def q_throughput(spark, sf):
    t = M.throughput_metrics(TB.run_log(spark, sf))
    return t.select("n_runs", *[F.round(c, 6).alias(c) for c in ("tokens_per_s", "bandwidth_gb_s", "rtf")])

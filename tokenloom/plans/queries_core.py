"""Registered queries: training batches and sample assembly."""

from __future__ import annotations

from tokenloom.plans import duck as D
from tokenloom.plans.catalog import register
from tokenloom.plans.training import training_batches

BATCH = 16
CTX = 2048

_SAMPLES = f"""
m AS ({D.MANIFEST}), t AS ({D.TEXT_ART}), e AS ({D.EMB_ART}), c AS ({D.CODE_ART}),
s AS (SELECT m.key, m.pos, t.tokens AS text_tokens, e.embedding, c.codes
      FROM m JOIN t USING (key) JOIN e USING (key) JOIN c USING (key))
"""


@register("training_batches", f"""
WITH {_SAMPLES},
r AS (SELECT *, row_number() OVER (ORDER BY pos) - 1 AS row FROM s),
b AS (SELECT *, row // {BATCH} AS batch_id FROM r),
w AS (SELECT *,
        max(len(text_tokens)) OVER (PARTITION BY batch_id) AS mt,
        max(len(codes[1])) OVER (PARTITION BY batch_id) AS mf,
        max(len(text_tokens) + 2 * len(codes[1])) OVER (PARTITION BY batch_id) AS ms,
        max(len(embedding)) OVER (PARTITION BY batch_id) AS me
      FROM b)
SELECT batch_id, row, pos, key,
  text_tokens || {D.rep('0', 'mt - len(text_tokens)')} AS text,
  embedding || {D.rep('0.0::FLOAT', 'me - len(embedding)')} AS embedding,
  list_transform(codes, lambda cb: cb || {D.rep('1024', 'mf - len(cb)')}) AS codes,
  list_slice(text_tokens || {D.interleave('codes')} || {D.rep('2048', 'ms - len(text_tokens) - 2 * len(codes[1])')},
             1, {CTX}) AS input,
  list_slice({D.rep('-1', 'len(text_tokens) - 1')} || {D.interleave('codes')} || [2048]
             || {D.rep('-1', 'ms - len(text_tokens) - 2 * len(codes[1])')}, 1, {CTX}) AS target
FROM w
""")
def q_training_batches(spark, sf_dir):
    return training_batches(spark, sf_dir, batch_size=BATCH, max_len=CTX)

"""Registered queries: token sequences (U1 bytes, T1-T14, T17-T19, T22, L3, L4, O13, A12)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tokenloom.functions import tokens as T
from tokenloom.functions.text import normalize_text, normalize_texts
from tokenloom.layout import STAGE1, STAGE2
from tokenloom.operators.aggregates import hierarchy_lengths
from tokenloom.operators.collate import collate
from tokenloom.operators.position import length_sorted_batches
from tokenloom.operators.sampling import double_batch, embedding_dropout
from tokenloom.plans import duck as D
from tokenloom.plans.catalog import register
from tokenloom.plans.training import batched_samples
from tokenloom.sources import tables as TB

E2 = STAGE2.eoa  # the decode adapters split at 1024
CTX = 2048
BATCH = 16
MAX_NEW = 864

_GEN = f"""SELECT doc_id AS pos, txt || {D.interleave('c')} || [2048] || {D.rep('(doc_id % 1024)::INTEGER', 'doc_id % 3')}
  AS tokens FROM (SELECT doc_id, {D.byte_tokens(D.normalize('text'), STAGE1.text_offset)} AS txt,
                         {D.codes()} AS c FROM documents)"""

_TILT = f"""SELECT doc_id AS pos, list_transform(range(1, 9), lambda b: CASE
    WHEN b = 1 THEN txt || c[1] || [1024]
    WHEN b = 2 THEN list_slice(c[2] || [1024], 1, len(c[2]) + 1 - doc_id % 4)
    ELSE c[b] || [1024] END) AS rows
  FROM (SELECT doc_id, {D.byte_tokens(D.normalize('text'), STAGE2.text_offset)} AS txt, {D.codes()} AS c FROM documents)"""

_DEINT = f"""SELECT pos, txt[1:greatest(len(txt) - 1, 0)] AS text, [b0[1:m], b1[1:m]] AS codes FROM (
  SELECT pos, txt, b0, b1, least(len(b0), len(b1)) AS m FROM (
    SELECT pos, list_filter(tokens, lambda v: v < {E2}) AS b0,
      list_transform(list_filter(tokens, lambda v: v >= {E2} AND v < {2 * E2}), lambda v: v - {E2}) AS b1,
      list_filter(tokens, lambda v: v > {2 * E2}) AS txt FROM ({_GEN})))"""


@register("text_tokens", f"SELECT key, tokens FROM ({D.TEXT_ART})")
def q_text_tokens(spark, sf):
    return TB.text_token_artifact(spark, sf)


@register("text_roundtrip", f"SELECT {D.key()} AS key, {D.normalize('text')} AS decoded FROM documents")
def q_text_roundtrip(spark, sf):
    return TB.text_token_artifact(spark, sf).select("key", T.byte_decode("tokens").alias("decoded"))


@register("interleaved_codes", f"SELECT key, {D.interleave('codes')} AS interleaved FROM ({D.CODE_ART})")
def q_interleaved_codes(spark, sf):
    return TB.code_artifact(spark, sf).select("key", T.interleave("codes").alias("interleaved"))


@register("collate_full", f"""WITH m AS ({D.MANIFEST}), t AS ({D.TEXT_ART}), e AS ({D.EMB_ART}), c AS ({D.CODE_ART}),
s AS (SELECT m.key, m.pos, t.tokens AS text_tokens, e.embedding, c.codes
      FROM m JOIN t USING (key) JOIN e USING (key) JOIN c USING (key)),
b AS (SELECT *, (row_number() OVER (ORDER BY pos) - 1) // {BATCH} AS batch_id FROM s),
w AS (SELECT *, max(len(text_tokens) + 2 * len(codes[1])) OVER (PARTITION BY batch_id) AS ms FROM b)
SELECT batch_id, key, len(text_tokens || {D.interleave('codes')} || {D.rep('2048', 'ms - len(text_tokens) - 2 * len(codes[1])')}) AS width,
  text_tokens || {D.interleave('codes')} || {D.rep('2048', 'ms - len(text_tokens) - 2 * len(codes[1])')} AS input,
  {D.rep('-1', 'len(text_tokens) - 1')} || {D.interleave('codes')} || [2048]
    || {D.rep('-1', 'ms - len(text_tokens) - 2 * len(codes[1])')} AS target
FROM w""")
def q_collate_full(spark, sf):
    c = collate(batched_samples(spark, sf, BATCH), max_len=None)
    return c.select("batch_id", "key", F.size("input").cast("long").alias("width"), "input", "target")


@register("deinterleaved", _DEINT)
def q_deinterleaved(spark, sf):
    g = TB.generated_tokens(spark, sf)
    text, codes = T.deinterleave("tokens", E2)
    return g.select("pos", text.alias("text"), codes.alias("codes"))


@register("untilted", f"""SELECT pos, txt[1:greatest(len(txt) - 1, 0)] AS text,
  list_transform(cs, lambda r: r[1:m]) AS codes FROM (
  SELECT pos, txt, cs, list_min(list_transform(cs, lambda r: len(r))) AS m FROM (
    SELECT pos, list_filter(rows[1], lambda v: v > {E2}) AS txt,
      list_transform(rows, lambda r: list_filter(r, lambda v: v < {E2})) AS cs FROM ({_TILT})))""")
def q_untilted(spark, sf):
    t = TB.tilted_rows(spark, sf)
    text, codes = T.untilt("rows", E2)
    return t.select("pos", text.alias("text"), codes.alias("codes"))


@register("hierarchy_lengths", f"""SELECT pos, list_sort(list_distinct(sz)) AS lengths, list_min(sz) AS min_len,
  list_max(sz) AS max_len FROM (SELECT pos, list_transform(rows, lambda r: len(r)) AS sz FROM ({_TILT}))""")
def q_hierarchy_lengths(spark, sf):
    t = TB.tilted_rows(spark, sf)
    d, lo, hi = hierarchy_lengths("rows")
    return t.select("pos", d.cast("array<bigint>").alias("lengths"), lo.cast("long").alias("min_len"),
                    hi.cast("long").alias("max_len"))


@register("filled_codebooks", f"""SELECT pos, codes || {D.rep(D.rep('0', 'len(codes[1])'), '8 - len(codes)')} AS codes
FROM ({_DEINT})""")
def q_filled_codebooks(spark, sf):
    g = TB.generated_tokens(spark, sf)
    _, codes = T.deinterleave("tokens", E2)
    return g.select("pos", T.fill_codebooks(codes, 8).alias("codes"))


def _fit(expr: str, ctx: int = CTX, pad: int = STAGE2.eoa) -> str:
    return f"list_slice({expr} || {D.rep(str(pad), f'{ctx} - len({expr})')}, 1, {ctx})"


_S2 = f"""SELECT doc_id AS pos, [{_fit('txt || c[1] || [1024]')}, {_fit(D.rep('1024', 'len(txt)') + ' || c[2] || [1024]')}] AS rows, c
  FROM (SELECT doc_id, {D.byte_tokens(D.normalize('text'), STAGE2.text_offset)} AS txt, {D.codes()} AS c FROM documents)"""


def _stage2(spark, sf):
    d = TB.table(spark, sf, "documents").select("doc_id", "text")
    # tokens in their own projection: the row builder below refers to them several times
    toks = d.select(F.col("doc_id").alias("pos"), TB.codes_of("doc_id").alias("c"),
                    T.byte_tokens(normalize_text("text"), STAGE2).alias("t"))
    return toks.select("pos", "c", T.stage2_input("t", "c", CTX).alias("rows"))


@register("stage2_inputs", f"SELECT pos, rows FROM ({_S2})")
def q_stage2_inputs(spark, sf):
    return _stage2(spark, sf).select("pos", "rows")


@register("stacked_hierarchies", f"SELECT pos, rows || list_transform(c[3:8], lambda r: {_fit('r')}) AS rows FROM ({_S2})")
def q_stacked_hierarchies(spark, sf):
    s = _stage2(spark, sf)
    pred = F.transform(F.slice("c", 3, 6), lambda r: F.slice(T.pad_right(r, CTX, STAGE2.eoa), 1, CTX))
    return s.select("pos", T.stack_hierarchies("rows", pred).alias("rows"))


_PROMPTS = f"""SELECT key, pos, length, batch_id, max(length) OVER (PARTITION BY batch_id) AS width, tokens FROM (
  SELECT key, pos, length, tokens, (row_number() OVER (ORDER BY length, pos) - 1) // {BATCH} AS batch_id
  FROM (SELECT key, pos, len(tokens) AS length, tokens FROM ({D.TEXT_ART}) JOIN ({D.MANIFEST}) USING (key)))"""


def _prompt_texts(spark, sf):
    # batches and widths on the narrow table; the join sorts texts, not their four times wider tokens
    b = length_sorted_batches(TB.text_lengths(spark, sf), BATCH, "length")
    b = b.withColumn("width", F.max("length").over(Window.partitionBy("batch_id")))
    return b.join(TB.manifest(spark, sf).select("key", "text").hint("merge"), "key")


def _prompts(spark, sf):
    return _prompt_texts(spark, sf).withColumn("tokens", T.byte_tokens(normalize_text("text"))).drop("text")


@register("prompt_batches", f"""SELECT key, batch_id, length AS seq_len,
  [tokens || {D.rep('0', 'width - length')}, {D.rep('1024', 'length')} || {D.rep('0', 'width - length')}] AS rows
FROM ({_PROMPTS})""")
def q_prompt_batches(spark, sf):
    p = _prompts(spark, sf)
    return p.select("key", "batch_id", F.col("length").alias("seq_len"),
                    T.pad_rows(T.prompt_rows("tokens", 2), F.col("width"), 0).alias("rows"))


@register("prefix_masks", f"""SELECT key, list_transform(range(width), lambda i: i < length) AS mask FROM ({_PROMPTS})""")
def q_prefix_masks(spark, sf):
    p = _prompts(spark, sf)
    return p.select("key", T.prefix_mask("length", "width").alias("mask"))


@register("overlays", f"""SELECT key, list_transform(range(1, width + 1), lambda i:
    CASE WHEN i - 1 < length THEN orig[i] ELSE pred[i] END) AS merged
FROM (SELECT p.key, p.width, p.length, p.tokens || {D.rep('0', 'p.width - p.length')} AS orig,
        list_slice(g.tokens || {D.rep('0', 'p.width - len(g.tokens)')}, 1, p.width) AS pred
      FROM ({_PROMPTS}) p JOIN ({_GEN}) g USING (pos))""")
def q_overlays(spark, sf):
    g = TB.table(spark, sf, "documents").select(F.col("doc_id").alias("pos"), F.col("text").alias("gen_text"))
    # both joins carry texts; prompt and generated tokens are made from the joined rows, by one Python worker a task
    j = _prompt_texts(spark, sf).join(g, "pos").select(
        "key", "pos", "length", "width", T.byte_tokens_of_all(normalize_texts(F.array("text", "gen_text"))).alias("both"))
    j = j.select("key", "length", "width", F.col("both")[0].alias("tokens"), TB.generated_from("pos", F.col("both")[1]).alias("gen"))
    orig = T.pad_right("tokens", F.col("width"), 0)
    pred = F.slice(T.pad_right("gen", F.col("width"), 0), F.lit(1), F.col("width"))
    return j.select("key", T.overlay(pred, orig, T.prefix_mask("length", "width")).alias("merged"))


@register("cropped_context", f"""SELECT pos, CASE WHEN len(tokens) <= 1024 THEN tokens
  ELSE tokens[len(tokens) - 1023:] END AS tokens FROM ({_GEN})""")
def q_cropped_context(spark, sf):
    return TB.generated_tokens(spark, sf).select("pos", T.crop_context("tokens", 1024).alias("tokens"))


@register("take_until_eoa", f"""SELECT g.pos, CASE WHEN list_position(g.tokens, 2048) IS NOT NULL
    THEN g.tokens[1:list_position(g.tokens, 2048)] ELSE g.tokens END AS tokens,
  least(len(t.tokens) + {MAX_NEW}, {CTX}) - len(t.tokens) AS budget,
  CASE WHEN least(len(t.tokens) + {MAX_NEW}, {CTX}) - len(t.tokens) <= 0
       THEN 'no room left to generate' END AS budget_error
FROM ({_GEN}) g JOIN (SELECT doc_id AS pos, {D.byte_tokens(D.normalize('text'))} AS tokens FROM documents) t USING (pos)""")
def q_take_until_eoa(spark, sf):
    g = TB.generated_tokens(spark, sf)
    m = TB.manifest(spark, sf).select("key", "pos")
    t = TB.text_token_artifact(spark, sf).join(m, "key").select("pos", F.size("tokens").cast("long").alias("prompt_len"))
    budget = T.generation_budget("prompt_len", MAX_NEW, CTX)
    return g.join(t, "pos").select("pos", T.take_until("tokens", STAGE1.eoa).alias("tokens"), budget.alias("budget"),
                                   T.budget_error(budget).alias("budget_error"))


@register("marker_masks", f"""SELECT pos, list_transform(range(1, len(tokens) + 1), lambda i:
  coalesce(list_position(tokens, 2048), 0) > 0 AND i >= list_position(tokens, 2048)) AS mask FROM ({_GEN})""")
def q_marker_masks(spark, sf):
    return TB.generated_tokens(spark, sf).select("pos", T.mask_after_marker("tokens", STAGE1.eoa).alias("mask"))


@register("null_pad_targets", f"""SELECT key, list_transform({D.rep('-1', 'len(tokens) - 1')} || {D.interleave('codes')} || [2048],
  lambda x: nullif(x, -1)) AS target FROM ({D.TEXT_ART}) JOIN ({D.CODE_ART}) USING (key)""")
def q_null_pad_targets(spark, sf):
    j = TB.text_token_artifact(spark, sf).join(TB.code_artifact(spark, sf), "key")
    tgt = T.stage1_target("tokens", "codes", F.size("tokens") + 2 * T.n_frames("codes"))
    return j.select("key", T.null_pad_tokens(tgt).alias("target"))


@register("gathered_embeddings", """SELECT vec_id, list_transform(range(10), lambda i: embedding[1 + (vec_id + i * 7) % 64])
  AS gathered FROM embeddings""")
def q_gathered_embeddings(spark, sf):
    e = TB.table(spark, sf, "embeddings")
    idx = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.pmod(F.col("vec_id") + i * 7, F.lit(64)).cast("int"))
    return e.select("vec_id", T.gather("embedding", idx).alias("gathered"))


@register("embedding_dropout", f"""SELECT key, CASE WHEN {D.unit("key || ':7'")} < 0.25
  THEN list_transform(embedding, lambda x: (x * 0.0)::FLOAT) ELSE embedding END AS embedding FROM ({D.EMB_ART})""")
def q_embedding_dropout(spark, sf):
    return embedding_dropout(TB.embedding_artifact(spark, sf), 0.25, 7).select("key", "embedding")


@register("double_batch", f"""SELECT key, c AS copy, CASE WHEN c = 0 THEN embedding END AS embedding
FROM ({D.EMB_ART}), (VALUES (0), (1)) v(c)""")
def q_double_batch(spark, sf):
    return double_batch(TB.embedding_artifact(spark, sf)).select("key", "copy", "embedding")

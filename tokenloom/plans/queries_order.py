"""Registered queries: positions, shards, splits, batches, joins, set operations
(O1-O7, L1, L5, A1-A3, A11, G1-G3, J1-J4, J7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.operators import aggregates as AG
from tokenloom.operators import joins as J
from tokenloom.operators import position as P
from tokenloom.operators import sets as G
from tokenloom.operators.collate import batch_shape
from tokenloom.plans import duck as D
from tokenloom.plans.catalog import register
from tokenloom.plans.training import admission, sized_samples, training_samples
from tokenloom.sources import tables as TB

N_SHARDS = 7
VAL = 500
BATCH = 16
MAX_NEW = 864
BLOCK = 2048

_SAMPLES_SQL = f"""m AS ({D.MANIFEST}), t AS ({D.TEXT_ART}), e AS ({D.EMB_ART}), c AS ({D.CODE_ART}),
s AS (SELECT m.key, m.pos, t.tokens AS text_tokens, e.embedding, c.codes
      FROM m JOIN t USING (key) JOIN e USING (key) JOIN c USING (key))"""


@register("positions_by_length", """SELECT doc_id, n_chars,
  row_number() OVER (ORDER BY n_chars, doc_id) - 1 AS pos FROM documents""")
def q_positions_by_length(spark, sf):
    d = TB.table(spark, sf, "documents").select("doc_id", "n_chars")
    return P.with_position(d, ["n_chars", "doc_id"], out="pos")


_SHARD_SQL = f"""WITH m AS ({D.MANIFEST}),
k AS (SELECT count(*) // {N_SHARDS} AS size, count(*) % {N_SHARDS} AS rem FROM m)
SELECT key, pos, (CASE WHEN size = 0 THEN pos
  WHEN pos < rem * (size + 1) THEN pos // (size + 1)
  ELSE rem + (pos - rem * (size + 1)) // size END)::INTEGER AS shard FROM m, k"""


@register("shards", _SHARD_SQL)
def q_shards(spark, sf):
    m = TB.manifest(spark, sf).select("key", "pos")
    return P.assign_shard(m, N_SHARDS)


def _split_sql(mode: str) -> str:
    # overlap: Python slice rules (negative bounds wrap); disjoint: bounds clamp at 0
    train_end = "n - 500" if mode == "overlap" else "n - 1000"
    if mode == "overlap":
        norm = lambda e: f"(CASE WHEN ({e}) < 0 THEN greatest(({e}) + n, 0) ELSE least({e}, n) END)"
    else:
        norm = lambda e: f"greatest({e}, 0)"
    return f"""WITH m AS ({D.MANIFEST}), c AS (SELECT count(*) AS n FROM m),
b AS (SELECT 0 AS tr0, {norm(train_end)} AS tr1, {norm('n - 1000')} AS v0, {norm('n - 500')} AS v1,
             {norm('n - 500')} AS t0, n AS t1 FROM c)
SELECT key, pos, 'train' AS split FROM m, b WHERE pos >= tr0 AND pos < tr1
UNION ALL SELECT key, pos, 'val' FROM m, b WHERE pos >= v0 AND pos < v1
UNION ALL SELECT key, pos, 'test' FROM m, b WHERE pos >= t0 AND pos < t1"""


@register("splits_overlap", _split_sql("overlap"))
def q_splits_overlap(spark, sf):
    return P.tail_split(TB.manifest(spark, sf).select("key", "pos"), VAL, "overlap")


@register("splits_disjoint", _split_sql("disjoint"))
def q_splits_disjoint(spark, sf):
    return P.tail_split(TB.manifest(spark, sf).select("key", "pos"), VAL, "disjoint")


@register("split_leakage", f"""WITH s AS ({_split_sql('overlap')})
SELECT key, pos FROM s WHERE split = 'val' AND key IN (SELECT key FROM s WHERE split = 'train')""")
def q_split_leakage(spark, sf):
    s = P.tail_split(TB.manifest(spark, sf).select("key", "pos"), VAL, "overlap")
    val = s.filter(F.col("split") == "val").drop("split")
    return G.split_leakage(val, s.filter(F.col("split") == "train").select("key"))


@register("split_union", f"""WITH s AS ({_split_sql('disjoint')}) SELECT key, pos, split FROM s""")
def q_split_union(spark, sf):
    m = TB.manifest(spark, sf).select("key", "pos")
    n = m.count()
    b = P.split_bounds(n, VAL, "disjoint")
    parts = [m.filter((F.col("pos") >= lo) & (F.col("pos") < hi)).withColumn("split", F.lit(name))
             for name, (lo, hi) in b.items()]
    return G.union_outputs(*parts)


@register("shuffled_batches", f"""SELECT key, pos, shuffled_pos, shuffled_pos // {BATCH} AS batch_id FROM (
  SELECT key, pos, row_number() OVER (ORDER BY md5(key || ':1:42'), key) - 1 AS shuffled_pos FROM ({D.MANIFEST}))""")
def q_shuffled_batches(spark, sf):
    m = TB.manifest(spark, sf).select("key", "pos")
    return P.shuffled_batches(m, BATCH, epoch=1, seed=42)


_LEN_SQL = f"""SELECT key, pos, length, sorted_pos, sorted_pos // {BATCH} AS batch_id FROM (
  SELECT key, pos, length, row_number() OVER (ORDER BY length, pos) - 1 AS sorted_pos
  FROM (SELECT key, pos, len(tokens) AS length FROM ({D.TEXT_ART}) JOIN ({D.MANIFEST}) USING (key)))"""


def _length_batches(spark, sf):
    return P.length_sorted_batches(TB.text_lengths(spark, sf), BATCH, "length")


@register("length_sorted_batches", _LEN_SQL)
def q_length_sorted_batches(spark, sf):
    return _length_batches(spark, sf)


@register("restored_order", f"SELECT pos, batch_id FROM ({_LEN_SQL}) ORDER BY pos")
def q_restored_order(spark, sf):
    return P.order_restore(_length_batches(spark, sf).select("pos", "batch_id"))


@register("batch_token_len", f"""SELECT max(mn) + {MAX_NEW} AS max_token_len FROM (
  SELECT batch_id, min(length) AS mn FROM ({_LEN_SQL}) GROUP BY batch_id)""")
def q_batch_token_len(spark, sf):
    return AG.batch_token_len(_length_batches(spark, sf), MAX_NEW)


@register("length_guard", f"""SELECT batch_id, max(length) AS max_len,
  CASE WHEN max(length) + {MAX_NEW} >= {BLOCK} THEN 'at most ' || CAST({BLOCK} - max(length) - 1 AS VARCHAR) || ' new tokens fit, not {MAX_NEW}' END AS error
FROM ({_LEN_SQL}) GROUP BY batch_id""")
def q_length_guard(spark, sf):
    # one verdict per batch: the guard runs before each generation call
    return AG.length_guard(_length_batches(spark, sf), MAX_NEW, BLOCK, by="batch_id")


@register("first_turns", """SELECT conv_id, turn, role, text FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations) WHERE rn = 1""")
def q_first_turns(spark, sf):
    c = TB.table(spark, sf, "conversations")
    return P.first_wins(c, key="conv_id", pos="turn").select("conv_id", "turn", "role", "text")


@register("distinct_dirs", f"SELECT DISTINCT split_part(key, '/', 1) AS dir FROM ({D.MANIFEST}) ORDER BY dir")
def q_distinct_dirs(spark, sf):
    return AG.distinct_dirs(TB.manifest(spark, sf))


@register("manifest_count", "SELECT count(*) AS n_rows FROM documents")
def q_manifest_count(spark, sf):
    return AG.manifest_count(TB.manifest(spark, sf))


@register("batch_shapes", f"""WITH {_SAMPLES_SQL},
b AS (SELECT *, (row_number() OVER (ORDER BY pos) - 1) // {BATCH} AS batch_id FROM s)
SELECT batch_id, max(len(text_tokens)) AS max_text, max(len(codes[1])) AS max_frames,
  max(len(text_tokens) + 2 * len(codes[1])) AS max_seq, count(*) AS n_rows FROM b GROUP BY batch_id""")
def q_batch_shapes(spark, sf):
    return batch_shape(sized_samples(spark, sf, BATCH))


@register("repeated_samples", f"SELECT key, unnest(range(3)) AS sample_id FROM ({D.MANIFEST})")
def q_repeated_samples(spark, sf):
    return G.repeat_samples(TB.manifest(spark, sf).select("key"), 3).withColumn("sample_id", F.col("sample_id").cast("long"))


@register("training_samples", f"WITH {_SAMPLES_SQL} SELECT key, pos, text_tokens, embedding, codes FROM s")
def q_training_samples(spark, sf):
    return training_samples(spark, sf).select("key", "pos", "text_tokens", "embedding", "codes")


@register("pending_embeddings", f"""SELECT key, pos FROM ({D.MANIFEST}) m
WHERE NOT EXISTS (SELECT 1 FROM ({D.EMB_ART}) e WHERE e.key = m.key)""")
def q_pending_embeddings(spark, sf):
    return J.pending(TB.manifest(spark, sf).select("key", "pos"), TB.embedding_artifact(spark, sf))


@register("missing_artifacts", f"""WITH m AS ({D.MANIFEST}),
f AS (SELECT m.key, m.pos,
        m.key IN (SELECT key FROM ({D.TEXT_ART})) AS has_text,
        m.key IN (SELECT key FROM ({D.EMB_ART})) AS has_embedding,
        m.key IN (SELECT key FROM ({D.CODE_ART})) AS has_codes FROM m)
SELECT * FROM f WHERE NOT (has_text AND has_embedding AND has_codes)""")
def q_missing_artifacts(spark, sf):
    return J.missing_artifacts(TB.manifest(spark, sf), {
        "text": TB.text_token_artifact(spark, sf), "embedding": TB.embedding_artifact(spark, sf),
        "codes": TB.code_artifact(spark, sf)})


@register("sample_admission", f"""WITH m AS ({D.MANIFEST}) SELECT key, pos,
  CASE WHEN key IN (SELECT key FROM ({D.EMB_ART})) THEN NULL ELSE 'missing embedding' END AS reason FROM m""")
def q_sample_admission(spark, sf):
    """J1's lenient form: kept rows (null reason) and rejected rows together are the manifest."""
    return admission(spark, sf).select("key", "pos", "reason")


@register("memoized_quality", """SELECT d.doc_id, l.quality, true AS cache_hit FROM documents d JOIN labels l USING (doc_id)
UNION ALL
SELECT doc_id, CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END, false FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_memoized_quality(spark, sf):
    d = TB.table(spark, sf, "documents").select("doc_id", "n_chars")
    cache = TB.table(spark, sf, "labels").select("doc_id", "quality")
    compute = lambda miss: miss.withColumn("quality", F.when(F.col("n_chars") >= 1000, 1).otherwise(0))
    return J.memoize(d, cache, compute, "doc_id", "quality").select("doc_id", "quality", "cache_hit")


@register("zip_results", """SELECT d.doc_id AS pos, d.text, l.toxic FROM documents d JOIN labels l ON l.doc_id = d.doc_id
WHERE l.toxic IS NOT NULL""")
def q_zip_results(spark, sf):
    d = TB.table(spark, sf, "documents").select(F.col("doc_id").alias("pos"), "text")
    lab = TB.table(spark, sf, "labels").select(F.col("doc_id").alias("pos"), "toxic")
    return J.zip_results(d, lab, "pos", "toxic")


@register("fixed_batches", f"""SELECT key, pos, row, row // {BATCH} AS batch_id FROM (
  SELECT key, pos, row_number() OVER (ORDER BY pos) - 1 AS row FROM ({D.MANIFEST}))""")
def q_fixed_batches(spark, sf):
    m = TB.manifest(spark, sf).select("key", "pos")
    return P.fixed_batches(P.with_position(m, ["pos"], out="row"), BATCH, pos="row")

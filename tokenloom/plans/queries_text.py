"""Registered queries: text, paths, requests, sidecars."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenloom.functions import requests as R
from tokenloom.functions import text as X
from tokenloom.operators.aggregates import distinct_dirs
from tokenloom.operators.joins import resolve_preset
from tokenloom.operators.metrics import eval_mean_of_means, metric_names
from tokenloom.operators.vectors import check_embedding_dims
from tokenloom.plans import duck as D
from tokenloom.plans.catalog import register
from tokenloom.sources import tables as TB
from tokenloom.sources.requests import PRESET_FILES, PRESET_NAMES, presets, request_payloads, sidecar_json

ARCHIVE_URL = "https://archive.example.org/data/"
BASE = "data"


@register("normalize_text", f"SELECT doc_id, {D.normalize('text')} AS text_norm FROM documents")
def q_normalize_text(spark, sf):
    d = TB.table(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id", X.normalize_text("text").alias("text_norm"))


@register("normalize_turns", f"SELECT conv_id, turn, {D.normalize('text')} AS text_norm FROM conversations")
def q_normalize_turns(spark, sf):
    c = TB.table(spark, sf, "conversations")
    return c.select("conv_id", "turn", X.normalize_text("text").alias("text_norm"))


@register("wide_chars", r"""SELECT doc_id,
  list_sort(list_distinct(regexp_extract_all(text, '[^\x{00}-\x{FF}]'))) AS wide_chars FROM documents""")
def q_wide_chars(spark, sf):
    d = TB.table(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id", X.wide_chars("text").alias("wide_chars"))


@register("artifact_paths", f"""SELECT key,
  '{BASE}/wav/' || key || '.wav' AS wav_path, '{BASE}/tok/' || key || '.tok' AS codes_path,
  '{BASE}/emb/' || key || '.emb' AS embedding_path, '{BASE}/txt/' || key || '.pt' AS text_path
FROM ({D.MANIFEST})""")
def q_artifact_paths(spark, sf):
    m = TB.manifest(spark, sf)
    b = F.lit(BASE)
    return m.select("key", X.artifact_path(b, "wav", "key").alias("wav_path"),
                    X.artifact_path(b, "codes", "key").alias("codes_path"),
                    X.artifact_path(b, "embedding", "key").alias("embedding_path"),
                    X.artifact_path(b, "text", "key").alias("text_path"))


@register("parent_dirs", f"""SELECT key, CASE WHEN n < 1 THEN []::VARCHAR[] ELSE
  list_filter(list_transform(range(1, n + 1), lambda k: regexp_replace(p, '(/+[^/]*){{' || k || '}}$', '')),
              lambda d: d <> '') END AS parents
FROM (SELECT key, p, len(regexp_split_to_array(p, '/+')) - 1 AS n
      FROM (SELECT key, '{BASE}/wav/' || key || '.wav' AS p FROM ({D.MANIFEST})))""")
def q_parent_dirs(spark, sf):
    m = TB.manifest(spark, sf)
    return m.select("key", X.parent_dirs(F.concat(F.lit(f"{BASE}/wav/"), F.col("key"), F.lit(".wav"))).alias("parents"))


@register("result_names", """SELECT conv_id, turn,
  'synth_' || substring(replace(text, ' ', '_'), 1, 25) || '_' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR)
  AS result_name FROM conversations""")
def q_result_names(spark, sf):
    c = TB.table(spark, sf, "conversations")
    ident = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return c.select("conv_id", "turn", X.result_name("text", ident).alias("result_name"))


@register("enhanced_paths", r"""SELECT page_id, './enhanced/' || substring(base, 1, length(base) - length(ext))
  || '_enhanced' || ext AS out_path
FROM (SELECT page_id, base, regexp_extract(base, '^\.*[^.].*(\.[^.]*)$', 1) AS ext
      FROM (SELECT page_id, string_split(url, '/')[-1] AS base FROM pages))""")
def q_enhanced_paths(spark, sf):
    p = TB.table(spark, sf, "pages")
    return p.select("page_id", X.tagged_output_path("url", "_enhanced").alias("out_path"))


@register("wav_suffix", f"""SELECT key, CASE WHEN ends_with(p, '.wav') THEN p ELSE p || '.wav' END AS wav_path
FROM (SELECT key, CASE WHEN pos % 2 = 0 THEN key || '.wav' ELSE key END AS p FROM ({D.MANIFEST}))""")
def q_wav_suffix(spark, sf):
    m = TB.manifest(spark, sf)
    p = F.when(F.pmod("pos", F.lit(2)) == 0, F.concat("key", F.lit(".wav"))).otherwise(F.col("key"))
    return m.select("key", X.ensure_suffix(p).alias("wav_path"))


@register("cache_keys", f"""SELECT uri, CASE WHEN starts_with(uri, 'http')
  THEN 'audio_' || md5(uri) || regexp_extract(regexp_replace(uri, '/+$', ''), '[^/](\\.[^./]+)$', 1)
  ELSE 'embedding_' || md5(uri) || '.pt' END AS cache_key
FROM (SELECT url AS uri FROM pages UNION ALL SELECT '{BASE}/wav/' || key || '.wav' FROM ({D.MANIFEST}))""")
def q_cache_keys(spark, sf):
    p = TB.table(spark, sf, "pages").select(F.col("url").alias("uri"))
    m = TB.manifest(spark, sf).select(F.concat(F.lit(f"{BASE}/wav/"), "key", F.lit(".wav")).alias("uri"))
    u = p.unionByName(m)
    return u.select("uri", X.cache_key("uri").alias("cache_key"))


@register("infer_format", "SELECT page_id, lower(string_split(url, '.')[-1]) AS format FROM pages")
def q_infer_format(spark, sf):
    p = TB.table(spark, sf, "pages")
    return p.select("page_id", X.infer_format("url").alias("format"))


_REQ_EXPECTED = """
SELECT conv_id, turn,
  CASE WHEN turn % 4 = 3 THEN NULL ELSE text END AS text,
  CASE turn % 4 WHEN 0 THEN 1.0::DOUBLE + (conv_id % 5)::DOUBLE * 0.5::DOUBLE WHEN 1 THEN 3.0::DOUBLE END AS guidance,
  CASE WHEN turn % 4 IN (0, 1) THEN 0.9::DOUBLE + (conv_id % 10)::DOUBLE / 100.0::DOUBLE
       WHEN turn % 4 = 2 THEN 0.95::DOUBLE END AS top_p,
  CASE WHEN turn % 4 = 0 THEN 'https://voices.example.org/ref/' || CAST(conv_id AS VARCHAR) || '.wav' END
    AS speaker_ref_path,
  CASE WHEN turn % 4 = 0 THEN (10 + conv_id % 40)::INTEGER END AS top_k,
  CASE WHEN turn % 4 = 3 THEN 'unknown field: voice' END AS error
FROM conversations"""


def _parsed(spark, sf):
    r = request_payloads(spark, sf)
    return r.select("conv_id", "turn", R.parse_request("payload").alias("r")).select("conv_id", "turn", "r.*")


@register("parse_requests", _REQ_EXPECTED)
def q_parse_requests(spark, sf):
    return _parsed(spark, sf)


@register("request_knobs", """SELECT conv_id, turn,
  round(0.9::DOUBLE + (turn % 11)::DOUBLE / 100.0::DOUBLE, 2) AS top_p,
  1.0::DOUBLE + ((1 + conv_id % 5) - 1)::DOUBLE * 2.0::DOUBLE / 4.0::DOUBLE AS guidance
FROM conversations""")
def q_request_knobs(spark, sf):
    c = TB.table(spark, sf, "conversations")
    return c.select("conv_id", "turn",
                    R.slider_value(F.pmod("turn", F.lit(11)), **R.TOP_P_SLIDER).alias("top_p"),
                    R.slider_value(F.lit(1) + F.pmod("conv_id", F.lit(5)), **R.GUIDANCE_SLIDER).alias("guidance"))


@register("validate_requests", f"""SELECT conv_id, turn,
  CASE WHEN text IS NULL OR text = '' THEN 'empty text'
       WHEN upload_bytes::DOUBLE / 1024 / 1024 >= {R.MAX_UPLOAD_MB}
       THEN 'upload too large: ' || CAST(round_even(upload_bytes::DOUBLE / 1024 / 1024, 0)::BIGINT AS VARCHAR)
            || ' MB of at most {R.MAX_UPLOAD_MB}' END AS error,
  substring(text, 1, {R.MAX_CHARS}) AS text_cut,
  length(text) > {R.MAX_CHARS} AS long_text
FROM (SELECT conv_id, turn, text, CASE WHEN conv_id % 10 = 3 THEN 55050240 + (conv_id // 10 % 2) * 1048576
        ELSE length(text)::BIGINT * 40000 END AS upload_bytes FROM ({_REQ_EXPECTED}))""")
def q_validate_requests(spark, sf):
    # conversations ..3 upload 52.5 or 53.5 MB: ties that round to the even neighbour
    tie = F.lit(55050240) + F.pmod(F.floor(F.col("conv_id") / 10), F.lit(2)) * 1048576
    p = _parsed(spark, sf).withColumn("upload_bytes", F.when(F.pmod("conv_id", F.lit(10)) == 3, tie)
                                      .otherwise(F.length("text").cast("long") * 40000))
    return p.select("conv_id", "turn", R.validation_error("text", "upload_bytes").alias("error"),
                    R.cut_text("text").alias("text_cut"), R.is_long_text("text").alias("long_text"))


_PRESETS_SQL = "(VALUES " + ", ".join(
    f"('{n}', 'https://voices.example.org/speakers/{f}')" for n, f in zip(PRESET_NAMES, PRESET_FILES)) + ") AS p(name, url)"


@register("choose_reference", f"""SELECT c.conv_id, c.turn, c.preset,
  CASE c.choice WHEN '{R.VOICE_CHOICES[0]}' THEN p.url
                WHEN '{R.VOICE_CHOICES[1]}' THEN 'uploads/' || CAST(c.conv_id AS VARCHAR) || '.wav'
                WHEN '{R.VOICE_CHOICES[2]}' THEN 'recordings/' || CAST(c.conv_id AS VARCHAR) || '.wav' END AS reference
FROM (SELECT conv_id, turn,
        ['{R.VOICE_CHOICES[0]}', '{R.VOICE_CHOICES[1]}', '{R.VOICE_CHOICES[2]}'][1 + conv_id % 3] AS choice,
        ['Ava', 'Bria', 'Alex', 'Jacob', 'Nobody'][1 + turn % 5] AS preset FROM conversations) c
LEFT JOIN {_PRESETS_SQL} ON c.preset = p.name""")
def q_choose_reference(spark, sf):
    c = TB.table(spark, sf, "conversations")
    choice = F.element_at(F.array(*[F.lit(v) for v in R.VOICE_CHOICES]), (F.pmod("conv_id", F.lit(3)) + 1).cast("int"))
    preset = F.element_at(F.array(*[F.lit(v) for v in PRESET_NAMES + ["Nobody"]]), (F.pmod("turn", F.lit(5)) + 1).cast("int"))
    req = c.select("conv_id", "turn", choice.alias("choice"), preset.alias("preset"))
    joined = resolve_preset(req, presets(spark))
    upload = F.concat(F.lit("uploads/"), F.col("conv_id").cast("string"), F.lit(".wav"))
    record = F.concat(F.lit("recordings/"), F.col("conv_id").cast("string"), F.lit(".wav"))
    return joined.select("conv_id", "turn", "preset",
                         R.choose_reference("choice", "url", upload, record).alias("reference"))


@register("sidecars", f"""SELECT conv_id, turn,
  '{{"speaker": ' || {D.json_string('role')} || ', "text": ' || {D.json_string('text')} || '}}' AS sidecar
FROM conversations""")
def q_sidecars(spark, sf):
    c = TB.table(spark, sf, "conversations")
    return c.select("conv_id", "turn", sidecar_json("role", "text").alias("sidecar"))


@register("archive_list", f"""SELECT DISTINCT split_part(key, '/', 1) AS archive,
  '{ARCHIVE_URL}' || split_part(key, '/', 1) || '.tar' AS url, '{BASE}/' || split_part(key, '/', 1) AS local_dir
FROM ({D.MANIFEST})""")
def q_archive_list(spark, sf):
    dirs = distinct_dirs(TB.manifest(spark, sf), out="archive")
    return dirs.select("archive", F.concat(F.lit(ARCHIVE_URL), "archive", F.lit(".tar")).alias("url"),
                       F.concat(F.lit(f"{BASE}/"), "archive").alias("local_dir"))


@register("durations", """SELECT utt_id, n_samples::DOUBLE / 16000 AS duration_s,
  least(n_samples, 16000 * 120) AS capped_samples, n_samples::DOUBLE / 16000 >= 30 AS long_enough
FROM (SELECT event_id AS utt_id, 8000 + (event_id * 377) % 400000 AS n_samples FROM events)
WHERE n_samples::DOUBLE / 16000 >= 2.0""")
def q_durations(spark, sf):
    return R.duration_filter(TB.utterances(spark, sf), out="duration_s").select(
        "utt_id", "duration_s", R.cap_samples("n_samples", "sample_rate").alias("capped_samples"),
        (F.col("duration_s") >= 30).alias("long_enough"))


@register("embedding_dims", """SELECT count(*) AS n_rows, sum(CASE WHEN len(embedding) <> 64 THEN 1 ELSE 0 END)::BIGINT AS n_bad_width,
  sum(CASE WHEN embedding IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_null, min(len(embedding))::INTEGER AS min_width,
  max(len(embedding))::INTEGER AS max_width FROM embeddings""")
def q_embedding_dims(spark, sf):
    return check_embedding_dims(TB.table(spark, sf, "embeddings"), 64)


@register("metric_keys", """WITH l AS (SELECT (event_id % 4)::INTEGER AS rank, event_id // 32 AS batch_id,
  event_type AS name, value FROM events),
pb AS (SELECT name, rank, batch_id, avg(value) AS m FROM l GROUP BY ALL),
s AS (SELECT name, count(*) AS at_step, avg(m) AS value_mean, (SELECT avg(value) FROM l l2 WHERE l2.name = pb.name) AS value_mean_weighted
      FROM pb GROUP BY name)
SELECT 'val/' || name || '/' || stat AS metric, at_step, round(v, 6) AS value FROM s
UNPIVOT (v FOR stat IN (value_mean AS 'mean', value_mean_weighted AS 'mean_weighted'))""")
def q_metric_keys(spark, sf):
    s = eval_mean_of_means(TB.losses(spark, sf))
    # the step of an evaluation is the number of batches it has seen
    long = s.select("name", "n_batches", F.expr("stack(2, 'mean', value_mean, 'mean_weighted', value_mean_weighted) AS (stat, v)"))
    named = metric_names(long.withColumn("name", F.concat_ws("/", "name", "stat")), "val", step="n_batches")
    return named.select("metric", "at_step", F.round("v", 6).alias("value"))

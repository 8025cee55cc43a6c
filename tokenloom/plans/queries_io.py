"""Registered queries: files, archives, audio, trained tokeniser, model map, streams
(S1-S6, U1-U6, R1-R3). They write derived files into the shared work folder first."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.functions.text import normalize_text
from tokenloom.functions.tokens import utf8_bytes
from tokenloom.operators import models as U
from tokenloom.plans import duck as D
from tokenloom.plans.catalog import register
from tokenloom.plans.corpus import prepare_corpus, speaker_vectors
from tokenloom.sources import archives as AR
from tokenloom.sources import audio as AU
from tokenloom.sources import files as FS
from tokenloom.sources import tables as TB
from tokenloom.sources.requests import (
    PRESET_FILES, PRESET_NAMES, presets, request_payloads, sidecar_json, write_sidecars)
from tokenloom.streaming import incremental, requests as SR


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


# ---------------------------------------------------------------- S1-S3, S6

_NA_SQL = ", ".join(D.q(t) for t in FS.NA_TOKENS)


_TSV_ROWS = f"""SELECT source, doc_id, CASE doc_id % 7 WHEN 0 THEN 'NA' WHEN 1 THEN '' WHEN 2 THEN 'null'
  WHEN 3 THEN 'say "x"' || chr(10) || 'and' || chr(9) || {D.normalize('text')} ELSE {D.normalize('text')} END AS t FROM documents"""


@register("manifest_from_tsv", f"""SELECT replace(source || '/' || CAST(doc_id AS VARCHAR) || '.flac', '.flac', '') AS key,
  CASE WHEN t IS NULL OR t IN ({_NA_SQL}) THEN NULL ELSE t END AS text
FROM ({_TSV_ROWS})""")
def q_manifest_from_tsv(spark, sf):
    return FS.read_tsv_manifest(spark, _tsv_files(spark, sf))


def _tsv_files(spark, sf, one=False):
    d = TB.table(spark, sf, "documents")
    t = F.when(F.pmod("doc_id", F.lit(7)) == 0, F.lit("NA")).when(F.pmod("doc_id", F.lit(7)) == 1, F.lit("")) \
        .when(F.pmod("doc_id", F.lit(7)) == 2, F.lit("null")) \
        .when(F.pmod("doc_id", F.lit(7)) == 3, F.concat(F.lit('say "x"\nand\t'), normalize_text("text"))) \
        .otherwise(normalize_text("text"))
    rows = d.select(F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".flac")).alias("path"),
                    t.alias("text"))
    path = FS.work_dir(spark, "tsv")
    FS.write_tsv_manifest(rows, path)
    if one:  # written in parts, as many tasks as read the table, then put behind each other
        whole = FS.work_dir(spark, "tsv-whole")
        FS.join_files(spark, path, os.path.join(whole, "part-00000.csv"))
        return whole
    return path


@register("manifest_quarantine", f"""SELECT key, NULL AS line, 'null text' AS reason FROM (
  SELECT {D.key()} AS key, t FROM ({_TSV_ROWS})) WHERE t IN ({_NA_SQL})
UNION ALL SELECT NULL, 'broken ' || CAST(doc_id AS VARCHAR), 'corrupt line' FROM documents WHERE doc_id % 50 = 0
UNION ALL SELECT {D.key()}, NULL, NULL FROM ({_TSV_ROWS}) WHERE t NOT IN ({_NA_SQL})""")
def q_manifest_quarantine(spark, sf):
    """S1 -> S3 -> S2 with broken lines among the files: rows that go on (null reason) and quarantined rows."""
    path = FS.work_dir(spark, "quarantine")
    FS.write_jsonl(FS.read_tsv_manifest(spark, _tsv_files(spark, sf)), os.path.join(path, "good"))
    broken = TB.table(spark, sf, "documents").where("doc_id % 50 = 0").select(F.concat(F.lit("broken "), F.col("doc_id").cast("string")))
    broken.write.text(os.path.join(path, "bad"))
    ok, bad = FS.quarantine(FS.read_jsonl(spark, os.path.join(path, "*")))
    return (ok.select("key", F.lit(None).cast("string").alias("line"), F.lit(None).cast("string").alias("reason"))
            .unionAll(bad.select("key", F.col("_corrupt_record").alias("line"), "reason")))


@register("file_order", f"SELECT {D.key()} AS key, doc_id AS row FROM documents")
def q_file_order(spark, sf):
    """S2 without a stored position: rows written in manifest order are numbered in file order."""
    path = FS.work_dir(spark, "ordered")
    d = TB.manifest(spark, sf).select("key", "pos")
    FS.write_jsonl(d.repartitionByRange(4, "pos").sortWithinPartitions("pos").select("key"), path)
    return FS.with_file_order(FS.read_jsonl(spark, path, "key string", corrupt=False), out="row")


@register("manifest_jsonl", f"SELECT key, text, pos FROM ({D.MANIFEST})")
def q_manifest_jsonl(spark, sf):
    path = FS.work_dir(spark, "jsonl")
    FS.write_jsonl(TB.manifest(spark, sf), path)
    return FS.read_jsonl(spark, path).drop("_corrupt_record")


@register("artifact_store", f"SELECT key, codes FROM ({D.CODE_ART})")
def q_artifact_store(spark, sf):
    base = FS.work_dir(spark, "store")
    codes = TB.code_artifact(spark, sf)
    FS.write_artifact(codes, base, "tok")
    FS.write_artifact(codes, base, "tok")  # second run: every key already stored, nothing appended
    return FS.read_artifact(spark, base, "tok")


# ---------------------------------------------------------------- U1, U2

_BPE_SQL = f"""SELECT key, CASE WHEN contains(n, '{U.EOT_STRING}') THEN NULL ELSE {D.byte_tokens('n')} END AS tokens,
  CASE WHEN contains(n, '{U.EOT_STRING}') THEN '{U.SPECIAL_TOKEN_ERROR}' END AS error
FROM (SELECT {D.key()} AS key, {D.normalize('text')} AS n FROM documents)"""


def _bpe(spark, sf):
    m = TB.manifest(spark, sf).select("key", normalize_text("text").alias("text"))
    return U.bpe_encode(m, "text")


@register("bpe_tokens", _BPE_SQL)
def q_bpe_tokens(spark, sf):
    return _bpe(spark, sf).select("key", "tokens", "error")


@register("bpe_roundtrip", f"""SELECT key, CASE WHEN contains(n, '{U.EOT_STRING}') THEN NULL ELSE n || '{U.EOT_STRING}' END AS decoded
FROM (SELECT {D.key()} AS key, {D.normalize('text')} AS n FROM documents)""")
def q_bpe_roundtrip(spark, sf):
    return U.bpe_decode(_bpe(spark, sf), "tokens").select("key", "decoded")


def _projection_model():
    return (np.arange(64, dtype=np.float64) + 1.0) / 64.0


def _score(model, pdf):
    return [None if e is None else round(float(np.dot(np.asarray(e, dtype=np.float64), model)), 6)
            for e in pdf["embedding"]]


@register("model_scores", """SELECT vec_id, round(list_sum(list_transform(range(64),
  lambda i: embedding[i + 1]::DOUBLE * (i + 1)::DOUBLE / 64.0)), 6) AS score, NULL::VARCHAR AS score_error FROM embeddings""")
def q_model_scores(spark, sf):
    e = TB.table(spark, sf, "embeddings").select("vec_id", "embedding")
    out = U.map_model(e, _projection_model, _score, "score", T.DoubleType())
    return out.select("vec_id", "score", "score_error")


# ---------------------------------------------------------------- S4

@register("archive_members", """SELECT source || '-' || CAST(doc_id // 100 AS VARCHAR) AS archive,
  CAST(doc_id AS VARCHAR) || '.txt' AS member, strlen(text) AS size, md5(text) AS content_md5, NULL::VARCHAR AS error FROM documents""")
def q_archive_members(spark, sf):
    d = TB.table(spark, sf, "documents")
    rows = d.select(F.concat("source", F.lit("-"), F.floor(F.col("doc_id") / 100).cast("string")).alias("archive"),
                    F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("member"),
                    F.encode("text", "UTF-8").alias("content"))
    out = FS.work_dir(spark, "tar")
    _force(AR.write_archives(rows, out, "archive", "member", "content"))
    paths = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").load(out).select("path")
    return AR.unpack_archives(spark, paths).select("archive", "member", "size", F.md5("content").alias("content_md5"), "error")


# ---------------------------------------------------------------- S5, U3-U6

def _write_wavs(spark, sf):
    d = TB.manifest(spark, sf).select("key", "text")
    rows = d.select("key", F.transform(utf8_bytes("text"), lambda x: ((x - 128) / 128.0).cast("float")).alias("pcm"),
                    F.lit(16000).alias("sample_rate"))
    out = FS.work_dir(spark, "wav")
    _force(AU.write_wavs(rows, out))
    return out


def _audio(spark, sf):
    root = _write_wavs(spark, sf)
    a = AU.read_audio(spark, root)
    return a.withColumn("key", AU.key_from_path("path", root))


# 16-bit sample of each byte as the WAV sink writes it, and the sum of the samples
_PCM16 = ("list_transform(regexp_extract_all(hex(encode(text)), '..'), "
          "lambda h: round_even((('0x' || h)::INTEGER - 128) * 32767.0::DOUBLE / 128.0::DOUBLE, 0)::BIGINT)")


@register("audio_files", f"""SELECT {D.key()} AS key, 16000 AS sample_rate, 1 AS channels, strlen(text) AS n_samples,
  coalesce(list_sum({_PCM16}), 0)::BIGINT AS pcm_sum, NULL::VARCHAR AS error FROM documents""")
def q_audio_files(spark, sf):
    pcm_sum = F.aggregate(F.col("pcm")[0], F.lit(0).cast("long"), lambda a, x: a + (x * 32768).cast("long"))
    return _audio(spark, sf).select("key", "sample_rate", "channels", "n_samples", pcm_sum.alias("pcm_sum"), "error")


# windowed sinc at output sample o, input time 2 o / 3: weights cos^2(pi t / 12) sinc(t) for |t| < 6, summing to one
_SINC_SQL = f"""WITH d AS (SELECT {D.key()} AS key, {_PCM16} AS x, (strlen(text) * 3 + 1) // 2 AS m FROM documents),
o AS (SELECT key, x, m, unnest([0, m // 2, m - 1]) AS o, unnest(['first_value', 'mid_value', 'last_value']) AS name FROM d WHERE m > 0),
t AS (SELECT key, m, o, name, 2 * o // 3 + j AS k, (2 * o // 3 + j) - 2.0::DOUBLE * o / 3 AS t, x FROM o, range(-5, 7) r(j)),
w AS (SELECT key, m, o, name, cos(pi() * t / 12) ** 2 * CASE WHEN abs(t) < 1e-9 THEN 1 ELSE sin(pi() * t) / (pi() * t) END AS w,
        CASE WHEN k BETWEEN 0 AND len(x) - 1 THEN x[k + 1]::DOUBLE / 32768 ELSE 0 END AS v FROM t WHERE abs(t) < 6)
SELECT key, name, round(sum(w * v) / sum(w), 2) + 0.0 AS y FROM w GROUP BY key, name, o"""


@register("resampled_audio", f"""SELECT d.key, d.n_samples, CASE WHEN d.n_samples < 9600 THEN 'audio shorter than 400 ms' END AS error,
  max(y) FILTER (name = 'first_value') AS first_value, max(y) FILTER (name = 'mid_value') AS mid_value,
  max(y) FILTER (name = 'last_value') AS last_value
FROM (SELECT {D.key()} AS key, (strlen(text) * 3 + 1) // 2 AS n_samples FROM documents) d LEFT JOIN ({_SINC_SQL}) s USING (key)
GROUP BY d.key, d.n_samples""")
def q_resampled_audio(spark, sf):
    from tokenloom.functions.requests import synthesis_error

    r = AU.resample_audio(_audio(spark, sf), 24000, "first", keep=["key"])
    n = F.size("wave").cast("long")
    value = lambda i: F.round(F.get("wave", i.cast("int")).cast("double"), 2) + F.lit(0.0)
    return r.select("key", n.alias("n_samples"), synthesis_error(n).alias("error"), value(F.lit(0)).alias("first_value"),
                    value(F.floor(n / 2)).alias("mid_value"), value(n - 1).alias("last_value"))


# frames of 2048 samples every 512, centred: frame f covers samples 512 f - 1024 .. 512 f + 1023
_TRIM_SQL = f"""WITH a AS (SELECT {D.key()} AS key, strlen(text) AS n,
    list_transform({_PCM16}, lambda v: (v::DOUBLE / 32768) ** 2) AS sq FROM documents),
p AS (SELECT key, n, list_transform(range(1 + n // 512), lambda f:
    greatest(coalesce(list_sum(sq[greatest(512 * f - 1024, 0) + 1:512 * f + 1024]), 0) / 2048, 1e-10)) AS power FROM a),
l AS (SELECT key, n, list_filter(range(len(power)), lambda f: power[f + 1] / list_max(power) > 0.01) AS loud FROM p)
SELECT key, CASE WHEN n = 0 THEN 0 ELSE 512 * loud[1] END AS trim_start,
  CASE WHEN n = 0 THEN 0 ELSE least(n, 512 * (loud[-1] + 1)) END AS trim_end,
  CASE WHEN n = 0 THEN 0 ELSE least(n, 512 * (loud[-1] + 1)) - 512 * loud[1] END::INTEGER AS n_samples FROM l"""


@register("trimmed_audio", _TRIM_SQL)
def q_trimmed_audio(spark, sf):
    r = AU.trim_audio(AU.resample_audio(_audio(spark, sf), 16000, "mean", keep=["key"]))
    return r.select("key", "trim_start", "trim_end", F.size("wave").alias("n_samples"))


# Summed mel energy of one frame by a direct transform: frame f covers samples 160 f - 200 .. 160 f + 199.
_BANK = ", ".join(f"({k}, {float(w)!r}::DOUBLE)" for k, w in enumerate(AU.mel_filterbank().sum(axis=0)))


_WAVES = f"SELECT {D.key()} AS key, {_PCM16} AS x FROM documents"


def _energy_sql(frames: str, waves: str = _WAVES) -> str:
    """``(key, f, energy)`` of the frames ``(key, f)`` over the waveforms, in tenths of a decade."""
    return f"""SELECT key, f, round(log10(sum(g * (re * re + im * im)) + 1e-6), 1) + 0.0 AS energy FROM (
  SELECT key, f, k, sum(v * cos(2 * pi() * k * i / 400)) AS re, sum(v * sin(2 * pi() * k * i / 400)) AS im FROM (
    SELECT key, f, i, (0.5 - 0.5 * cos(2 * pi() * i / 400))
      * CASE WHEN 160 * f - 200 + i BETWEEN 0 AND len(x) - 1 THEN x[160 * f - 200 + i + 1]::DOUBLE / 32768 ELSE 0 END AS v
    FROM (SELECT a.key, b.f, a.x FROM ({waves}) a JOIN ({frames}) b USING (key)),
      range(400) t(i)), range(201) b(k) GROUP BY key, f, k)
JOIN (VALUES {_BANK}) bank(k, g) USING (k) GROUP BY key, f"""


def _energy(mels) -> F.Column:
    total = F.aggregate(mels, F.lit(0.0), lambda a, x: a + x.cast("double"))
    return F.round(F.log10(total + 1e-6), 1) + F.lit(0.0)  # no negative zero


_KEPT_DOC = f"""SELECT key, n, CASE WHEN (n - (n_win - 1) * 77 * 160)::DOUBLE / 25600 < 0.75 AND n_win > 1
  THEN n_win - 1 ELSE n_win END AS kept FROM (
  SELECT key, n, (greatest(1, ceil((n + 1) / 160)::BIGINT - 160 + 77 + 1) - 1) // 77 + 1 AS n_win
  FROM (SELECT {D.key()} AS key, strlen(text) AS n FROM documents))"""


@register("partial_mels", f"""WITH w AS (
  SELECT key, unnest(range(kept)) AS w, greatest(n, ((kept - 1) * 77 + 160) * 160) AS padded FROM ({_KEPT_DOC})),
e AS ({_energy_sql("SELECT key, w * 77 + 10 AS f FROM w")})
SELECT key, w::INTEGER AS win_idx, (1 + padded // 160)::INTEGER AS n_frames, padded AS padded_samples,
  160 AS n_rows, 40 AS n_mels, energy FROM w JOIN e ON e.key = w.key AND e.f = w.w * 77 + 10""".replace("SELECT key, w::INTEGER", "SELECT w.key, w.w::INTEGER"))
def q_partial_mels(spark, sf):
    w = AU.resample_audio(_audio(spark, sf), 16000, "mean", keep=["key"])
    m = AU.partial_mels(w.select("key", "wave"))
    return m.select("key", "win_idx", "n_frames", "padded_samples", F.size("mels").alias("n_rows"),
                    F.size(F.col("mels")[0]).alias("n_mels"), _energy(F.col("mels")[10]).alias("energy"))


# ---------------------------------------------------------------- R1-R3

_PRESETS_SQL = "(VALUES " + ", ".join(
    f"('{n}', 'https://voices.example.org/speakers/{f}')" for n, f in zip(PRESET_NAMES, PRESET_FILES)) + ") AS p(name, url)"
_STREAM_SQL = f"""SELECT r.conv_id, r.turn, {D.normalize('r.text')} AS text, r.guidance, r.top_p, r.top_k,
  coalesce(r.speaker_ref_path, p.url) AS reference,
  coalesce(r.error, CASE WHEN r.text IS NULL OR r.text = '' THEN 'empty text' END) AS error
FROM (SELECT *, ['Ava', 'Bria', 'Alex', 'Jacob'][1 + conv_id % 4] AS preset FROM (
  SELECT conv_id, turn,
    CASE WHEN turn % 4 = 3 THEN NULL ELSE text END AS text,
    CASE turn % 4 WHEN 0 THEN 1.0::DOUBLE + (conv_id % 5)::DOUBLE * 0.5::DOUBLE WHEN 1 THEN 3.0::DOUBLE END AS guidance,
    CASE WHEN turn % 4 IN (0, 1) THEN 0.9::DOUBLE + (conv_id % 10)::DOUBLE / 100.0::DOUBLE
         WHEN turn % 4 = 2 THEN 0.95::DOUBLE END AS top_p,
    CASE WHEN turn % 4 = 0 THEN 'https://voices.example.org/ref/' || CAST(conv_id AS VARCHAR) || '.wav' END AS speaker_ref_path,
    CASE WHEN turn % 4 = 0 THEN (10 + conv_id % 40)::INTEGER END AS top_k,
    CASE WHEN turn % 4 = 3 THEN 'unknown field: voice' END AS error
  FROM conversations)) r LEFT JOIN {_PRESETS_SQL} ON r.preset = p.name"""


def _run_request_stream(spark, sf):
    work = FS.work_dir(spark, "requests")
    src, out, ckpt = os.path.join(work, "in"), os.path.join(work, "out"), os.path.join(work, "ckpt")
    req = request_payloads(spark, sf)
    pre = presets(spark)
    # requests arrive in two drops; each availableNow run picks up only the new files
    for step in (0, 1):
        req.filter(F.pmod("turn", F.lit(2)) == step).write.mode("overwrite").json(os.path.join(src, f"drop{step}"))
        SR.stream_prepare_requests(spark, os.path.join(src, "*"), out, ckpt, pre)
    return out


@register("stream_requests", _STREAM_SQL)
def q_stream_requests(spark, sf):
    out = _run_request_stream(spark, sf)
    return SR.read_outputs(spark, out, "ok").unionByName(SR.read_outputs(spark, out, "err")).drop("batch")


@register("stream_dead_letters", f"SELECT * FROM ({_STREAM_SQL}) WHERE error IS NOT NULL")
def q_stream_dead_letters(spark, sf):
    return SR.read_outputs(spark, _run_request_stream(spark, sf), "err").drop("batch")


@register("stream_text_tokens", f"SELECT key, tokens FROM ({D.TEXT_ART})")
def q_stream_text_tokens(spark, sf):
    work = FS.work_dir(spark, "incremental")
    src, store, ckpt = os.path.join(work, "in"), os.path.join(work, "store"), os.path.join(work, "ckpt")
    m = TB.manifest(spark, sf)
    # first drop: even positions; second drop: odd positions plus every key again (re-sent rows)
    FS.write_jsonl(m.filter(F.pmod("pos", F.lit(2)) == 0), os.path.join(src, "drop0"))
    incremental.stream_text_tokens(spark, os.path.join(src, "*"), store, ckpt)
    FS.write_jsonl(m, os.path.join(src, "drop1"))
    incremental.stream_text_tokens(spark, os.path.join(src, "*"), store, ckpt)
    return FS.read_artifact(spark, store, "txt")


def _energy_model():
    return 1e-6


def _mel_energy(floor, pdf):
    """A stand-in for a speaker model: tenths of a decade of the mel energy of frames 10 and 60, and one."""
    level = lambda m, i: round(float(np.log10(np.asarray(m[i], np.float64).sum() + floor)), 1)
    return [[level(m, 10), level(m, 60), 1.0] for m in pdf["mels"]]


_TRIMMED = f"SELECT w.key, w.x[t.trim_start + 1:t.trim_end] AS x FROM ({_WAVES}) w JOIN ({_TRIM_SQL}) t USING (key)"
_UNIT = "list_transform({0}, lambda q: q / sqrt(list_sum(list_transform({0}, lambda r: r * r))))"


@register("speaker_from_audio", f"""WITH w AS (SELECT key, len(x) AS n FROM ({_TRIMMED})),
c AS (SELECT key, n, (greatest(1, ceil((n + 1) / 160)::BIGINT - 160 + 77 + 1) - 1) // 77 + 1 AS n_win FROM w),
k AS (SELECT key, unnest(range(CASE WHEN (n - (n_win - 1) * 77 * 160)::DOUBLE / 25600 < 0.75 AND n_win > 1 THEN n_win - 1 ELSE n_win END)) AS i FROM c),
e AS ({_energy_sql("SELECT key, i * 77 + d AS f FROM k, (VALUES (10), (60)) o(d)", _TRIMMED)}),
p AS (SELECT k.key, a.energy AS v0, b.energy AS v1 FROM k JOIN e a ON a.key = k.key AND a.f = k.i * 77 + 10
      JOIN e b ON b.key = k.key AND b.f = k.i * 77 + 60),
u AS (SELECT key, split_part(key, '/', 1) AS speaker, [avg(v0), avg(v1), 1.0] AS m FROM p GROUP BY key),
n AS (SELECT speaker, {_UNIT.format("m")} AS q FROM u),
s AS (SELECT speaker, [avg(q[1]), avg(q[2]), avg(q[3])] AS m FROM n GROUP BY speaker)
SELECT speaker, list_transform({_UNIT.format("m")}, lambda z: round(z, 3)) AS embedding FROM s""")
def q_speaker_from_audio(spark, sf):
    """From WAV files to one unit vector per speaker, a source standing for a speaker."""
    a = _audio(spark, sf).withColumn("speaker", F.split("key", "/")[0])
    v = speaker_vectors(a, _energy_model, _mel_energy)
    return v.select("speaker", F.transform("embedding", lambda x: F.round(x, 3)).alias("embedding"))


@register("prepared_corpus", f"""WITH r AS (SELECT {D.key()} AS key, t AS text FROM ({_TSV_ROWS}) WHERE t NOT IN ({_NA_SQL})),
p AS (SELECT *, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS n FROM r)
SELECT key, pos, CASE WHEN pos < n - 100 THEN 'train' WHEN pos < n - 50 THEN 'val' ELSE 'test' END AS split,
  {D.byte_tokens(D.normalize('text'))} AS tokens FROM p""")
def q_prepared_corpus(spark, sf):
    """TSV manifest to token store and split files, run twice (the second run adds nothing), read back."""
    out = FS.work_dir(spark, "corpus")
    tsv = _tsv_files(spark, sf)
    for _ in range(2):
        prepare_corpus(spark, tsv, out, val_size=50)
    rows = spark.read.schema(FS.MANIFEST_SCHEMA + ", split string").json(os.path.join(out, "splits"))
    return rows.select("key", "pos", "split").join(FS.read_artifact(spark, out, "txt"), "key")


@register("sidecar_files", f"""SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS name,
  '{{"speaker": ' || {D.json_string('role')} || ', "text": ' || {D.json_string('text')} || '}}' AS sidecar FROM conversations""")
def q_sidecar_files(spark, sf):
    c = TB.table(spark, sf, "conversations")
    name = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    out = FS.work_dir(spark, "sidecars")
    _force(write_sidecars(c.select(name.alias("name"), sidecar_json("role", "text").alias("sidecar")), out))
    files = spark.read.option("wholetext", "true").text(out)
    return files.select(F.regexp_extract(F.col("_metadata.file_name"), r"(.+)\.json$", 1).alias("name"), F.col("value").alias("sidecar"))


@register("mel_frames", f"""WITH n AS (SELECT {D.key()} AS key, 1 + strlen(text) // 160 AS n FROM documents),
e AS ({_energy_sql("SELECT key, n // 2 AS f FROM n")})
SELECT key, n::INTEGER AS n_frames, 40 AS n_mels, energy FROM n JOIN e USING (key)""")
def q_mel_frames(spark, sf):
    w = AU.resample_audio(_audio(spark, sf), 16000, "mean", keep=["key"])
    m = AU.mel_spectrogram(w.select("key", "wave"))
    middle = F.element_at("mels", (F.floor(F.col("n_frames") / 2) + 1).cast("int"))
    return m.select("key", "n_frames", "n_mels", _energy(middle).alias("energy"))


@register("training_samples_bucketed", f"""WITH m AS ({D.MANIFEST}), t AS ({D.TEXT_ART}), e AS ({D.EMB_ART}), c AS ({D.CODE_ART})
SELECT m.key, m.pos, t.tokens AS text_tokens, e.embedding, c.codes
FROM m JOIN t USING (key) JOIN e USING (key) JOIN c USING (key)""")
def q_training_samples_bucketed(spark, sf):
    """J1 over artifact tables stored bucketed by key (S6 co-located form): the joins
    read matching buckets side by side, with no shuffle."""
    from tokenloom.operators.joins import assemble_samples

    base = FS.work_dir(spark, "bucketed")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    suffix = os.path.basename(base).replace("-", "_")
    arts = {"man": TB.manifest(spark, sf).select("key", "pos"), "txt": TB.text_token_artifact(spark, sf),
            "emb": TB.embedding_artifact(spark, sf), "tok": TB.code_artifact(spark, sf)}
    for kind, df in arts.items():
        FS.write_bucketed_artifact(df, f"{kind}_{suffix}", os.path.join(base, kind), n)
    t = {k: FS.read_bucketed_artifact(spark, f"{k}_{suffix}") for k in arts}
    # half of the manifest has no embedding yet: only admitted rows go on (see sample_admission)
    return assemble_samples(t["man"], t["txt"], t["emb"], t["tok"], strict=False).select(
        "key", "pos", "text_tokens", "embedding", "codes")


@register("stream_text_tokens_state", f"SELECT key, tokens FROM ({D.TEXT_ART})")
def q_stream_text_tokens_state(spark, sf):
    """R3 with keys deduplicated in the streaming state store instead of a store scan."""
    work = FS.work_dir(spark, "incremental-state")
    src, store, ckpt = os.path.join(work, "in"), os.path.join(work, "store"), os.path.join(work, "ckpt")
    m = TB.manifest(spark, sf)
    FS.write_jsonl(m.filter(F.pmod("pos", F.lit(2)) == 0), os.path.join(src, "drop0"))
    incremental.stream_text_tokens(spark, os.path.join(src, "*"), store, ckpt, dedupe="state")
    FS.write_jsonl(m, os.path.join(src, "drop1"))
    incremental.stream_text_tokens(spark, os.path.join(src, "*"), store, ckpt, dedupe="state")
    return FS.read_artifact(spark, store, "txt")

"""Registered queries: indexed stores, split scans, member ranges, permutations and budget batches."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tokenloom.operators import percentiles as PC
from tokenloom.operators.append import PositionLog
from tokenloom.operators.budget import budget_batches
from tokenloom.operators.permute import ROUNDS, permuted_batches
from tokenloom.plans import duck as D
from tokenloom.plans.catalog import ORACLE, register
from tokenloom.plans.queries_io import _energy, _tsv_files, _write_wavs
from tokenloom.sources import archives as AR
from tokenloom.sources import audio as AU
from tokenloom.sources import chunks as CH
from tokenloom.sources import files as FS
from tokenloom.sources import tables as TB
from tokenloom.sources.keyindex import KeyedStore, memoize_in
from tokenloom.sources.splitscan import index_archives, read_members, read_tsv_splits
from tokenloom.sources.requests import presets, request_payloads
from tokenloom.streaming import firsts, incremental
from tokenloom.streaming import requests as SR

# ---------------------------------------------------------------- indexed store


def _code_store(spark, sf):
    """Codes of the documents with a vector, stored in four runs that split the sources, and once more as a whole."""
    store = KeyedStore(spark, FS.work_dir(spark, "keyed"), "tok")
    codes = TB.code_artifact(spark, sf).join(TB.embedding_artifact(spark, sf).select("key"), "key", "left_semi")
    for part in range(4):
        store.add(codes.where(F.pmod(F.xxhash64(F.split("key", "/")[0]), F.lit(4)) == part))
    store.add(codes)  # nothing new
    return store


@register("indexed_resume", f"""SELECT key, pos FROM ({D.MANIFEST}) m
WHERE NOT EXISTS (SELECT 1 FROM ({D.EMB_ART}) e WHERE e.key = m.key)""")
def q_indexed_resume(spark, sf):
    """J2 over an indexed store: the rows of the manifest that no stored file holds."""
    return _code_store(spark, sf).pending(TB.manifest(spark, sf).select("key", "pos"))


@register("indexed_memo", f"""SELECT {D.key()} AS key, CASE WHEN l.doc_id IS NULL THEN CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END
  ELSE l.quality END AS quality, l.doc_id IS NOT NULL AS cache_hit
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def q_indexed_memo(spark, sf):
    """J3 over an indexed store: labels are stored values, the rest is computed and stored; the second call only reads."""
    d = TB.table(spark, sf, "documents").select(
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("key"), "doc_id", "n_chars")
    store = KeyedStore(spark, FS.work_dir(spark, "memo"), "quality")
    labels = TB.table(spark, sf, "labels").select("doc_id", "quality")
    store.add(d.join(labels, "doc_id").select("key", "quality"))
    compute = lambda miss: miss.withColumn("quality", F.when(F.col("n_chars") >= 1000, 1).otherwise(0).cast(
        store.read().schema["quality"].dataType))
    first = memoize_in(store, d, compute, "quality")
    again = memoize_in(store, d, compute, "quality").where("cache_hit").select("key")
    return first.join(again, "key", "left_semi").select("key", "quality", "cache_hit")


@register("stream_text_tokens_index", f"SELECT key, tokens FROM ({D.TEXT_ART})")
def q_stream_text_tokens_index(spark, sf):
    """R3 with keys looked up in an indexed store."""
    work = FS.work_dir(spark, "incremental-index")
    src, store, ckpt = os.path.join(work, "in"), os.path.join(work, "store"), os.path.join(work, "ckpt")
    m = TB.manifest(spark, sf)
    FS.write_jsonl(m.filter(F.pmod("pos", F.lit(2)) == 0), os.path.join(src, "drop0"))
    incremental.stream_text_tokens(spark, os.path.join(src, "*"), store, ckpt, dedupe="index")
    FS.write_jsonl(m, os.path.join(src, "drop1"))
    incremental.stream_text_tokens(spark, os.path.join(src, "*"), store, ckpt, dedupe="index")
    return KeyedStore(spark, store, "txt").read()


# ---------------------------------------------------------------- split scans

@register("manifest_tsv_splits", ORACLE["manifest_from_tsv"])
def q_manifest_tsv_splits(spark, sf):
    """S1 over one large file with quoted newlines, in splits of 64 KB."""
    return read_tsv_splits(spark, _tsv_files(spark, sf, one=True), split_bytes=1 << 16)


@register("archive_ranges", """SELECT source AS archive, lpad(CAST(doc_id AS VARCHAR), 12, '0') || '.txt' AS member, strlen(text) AS size,
  md5(text) AS content_md5, NULL::VARCHAR AS error FROM documents""")
def q_archive_ranges(spark, sf):
    """S4 over one archive per source: members indexed by header, then read by byte range, 256 KB a task."""
    d = TB.table(spark, sf, "documents")
    member = F.concat(F.lpad(F.col("doc_id").cast("string"), 12, "0"), F.lit(".txt"))
    out = FS.work_dir(spark, "tar-large")
    written = FS.stage(AR.write_archives(d.select(F.col("source").alias("archive"), member.alias("member"),
                                                  F.encode("text", "UTF-8").alias("content")), out, "archive", "member", "content"), "written")
    index = FS.stage(index_archives(written.select("path")), "members")
    return read_members(index, portion=1 << 18).select("archive", "member", "size", F.md5("content").alias("content_md5"), "error")


# ---------------------------------------------------------------- order without sorts and walks

BATCH = 16
BUDGET = 16384


def _feistel_sql(n: str, epoch: int, seed: int) -> str:
    """The same rounds: ``x`` of the rows that aren't below n goes through the grid again."""
    step = "SELECT key, pos, n, a, b, l, r FROM (SELECT *, x // b AS l, x % b AS r FROM w WHERE x < 0 OR x >= n)"
    step = step.replace("x // b", "(CASE WHEN x < 0 THEN pos ELSE x END) // b").replace("x % b", "(CASE WHEN x < 0 THEN pos ELSE x END) % b")
    for i in range(ROUNDS):
        mix = f"('0x' || substr(md5('{seed}:{epoch}:{i}:' || r), 1, 12))::BIGINT"
        step = f"SELECT key, pos, n, a, b, r AS l, (l + {mix}) % {'a' if i % 2 == 0 else 'b'} AS r FROM ({step})"
    return f"""WITH RECURSIVE g AS (SELECT n, a, (n + a - 1) // a AS b FROM (
    SELECT {n} AS n, greatest(1, floor(sqrt(greatest({n} - 1, 0)))::BIGINT + 1) AS a)),
w(key, pos, n, a, b, x) AS (SELECT key, pos, n, a, b, -1::BIGINT FROM ({D.MANIFEST}), g
  UNION ALL SELECT key, pos, n, a, b, l * b + r FROM ({step}))
SELECT key, pos, x AS shuffled_pos, x // {BATCH} AS batch_id FROM w WHERE x >= 0 AND x < n"""


@register("permuted_batches", _feistel_sql("(SELECT count(*) FROM documents)", 1, 42))
def q_permuted_batches(spark, sf):
    """O5 as a projection: shuffled position of every row by a keyed permutation, then batches."""
    return permuted_batches(TB.manifest(spark, sf).select("key", "pos"), BATCH, epoch=1, seed=42)


_LENGTHS = f"SELECT key, pos, len(tokens) AS length FROM ({D.TEXT_ART}) JOIN ({D.MANIFEST}) USING (key)"
_BUDGET_SQL = f"""WITH RECURSIVE l AS (SELECT key, length, row_number() OVER (ORDER BY length, pos) AS i FROM ({_LENGTHS})),
w AS (SELECT key, length, i, length AS used, 0::BIGINT AS batch_id FROM l WHERE i = 1
  UNION ALL SELECT l.key, l.length, l.i, CASE WHEN w.used + l.length > {BUDGET} THEN l.length ELSE w.used + l.length END,
    w.batch_id + (w.used + l.length > {BUDGET})::BIGINT FROM w JOIN l ON l.i = w.i + 1)
SELECT key, length, batch_id FROM w"""


@register("token_budget_batches", _BUDGET_SQL)
def q_token_budget_batches(spark, sf):
    """O6 by tokens: rows sorted by length, cut into batches of at most 16,384 tokens."""
    return budget_batches(TB.text_lengths(spark, sf), BUDGET, "length", ["length", "pos"], "key")


@register("appended_positions", f"""SELECT key, row_number() OVER (ORDER BY CASE WHEN pos % 3 = 0 THEN 0 WHEN pos % 3 = 1 THEN 1 ELSE 2 END, pos) - 1 AS pos
FROM ({D.MANIFEST})""")
def q_appended_positions(spark, sf):
    """O1 over a manifest that comes in three parts; the second is sent twice."""
    log = PositionLog(spark, FS.work_dir(spark, "positions"))
    m = TB.manifest(spark, sf).select("key", F.col("pos").alias("line"))
    for part in (0, 1, 1, 2):
        log.append(m.where(F.pmod("line", F.lit(3)) == part), ["line"])
    return log.read().select("key", "pos")


# ---------------------------------------------------------------- chunked recordings

SOUND = 30_720  # samples of a chunk: small, so that recordings of the test tables have several


def _sound(spark, sf, mode="first"):
    root = _write_wavs(spark, sf)
    c = CH.read_chunks(spark, root, SOUND, mode)
    return c.select(AU.key_from_path("path", root).alias("key"), "n", "chunk", "samples")


@register("chunked_resample", ORACLE["resampled_audio"])
def q_chunked_resample(spark, sf):
    """S5 and U3 on chunks: the first, middle and last sample of every recording at 24 kHz."""
    from tokenloom.functions.requests import synthesis_error

    size = SOUND * 3 // 2
    r = CH.resample_chunks(_sound(spark, sf), 16000, 24000, SOUND)  # read once, so its chunks needn't be stored
    at = lambda i: F.max(F.when(F.floor(i / size) == F.col("chunk"), F.get("samples", (i % size).cast("int")))).cast("double")
    n = F.col("n")
    v = r.groupBy("key", "n").agg(at(F.lit(0)).alias("a"), at(F.floor(n / 2)).alias("b"), at(n - 1).alias("c"))
    value = lambda c: F.round(c, 2) + F.lit(0.0)
    return v.select("key", n.alias("n_samples"), synthesis_error(n).alias("error"), value("a").alias("first_value"),
                    value("b").alias("mid_value"), value("c").alias("last_value"))


@register("chunked_trim", ORACLE["trimmed_audio"])
def q_chunked_trim(spark, sf):
    """S5 and U4 on chunks."""
    t = CH.trim_chunks(_sound(spark, sf, "mean"), SOUND)
    return t.select("key", "trim_start", "trim_end", (F.col("trim_end") - F.col("trim_start")).cast("int").alias("n_samples"))


@register("chunked_mels", ORACLE["mel_frames"])
def q_chunked_mels(spark, sf):
    """S5 and U5 on chunks: frames counted and the middle one summed up."""
    m = FS.stage(CH.mel_chunks(_sound(spark, sf, "mean"), SOUND), "mels")
    total = 1 + F.floor(F.col("n") / 160)
    i = F.floor(total / 2) - F.col("first")
    there = (i >= 0) & (i < F.size("mels"))
    d = m.groupBy("key", "n").agg(F.sum(F.size("mels")).cast("int").alias("n_frames"),
                                  F.max(F.when(there, F.get("mels", i.cast("int")))).alias("middle"))
    return d.select("key", "n_frames", F.size("middle").alias("n_mels"), _energy(F.col("middle")).alias("energy"))


@register("chunked_partials", ORACLE["partial_mels"])
def q_chunked_partials(spark, sf):
    """S5, T21, U5 and U6 on chunks: the windows of every recording, across chunk edges."""
    m = CH.partial_chunks(_sound(spark, sf, "mean"), SOUND)
    return m.select("key", "win_idx", "n_frames", "padded_samples", F.size("mels").alias("n_rows"),
                    F.size(F.col("mels")[0]).alias("n_mels"), _energy(F.col("mels")[10]).alias("energy"))


# ---------------------------------------------------------------- stateful firsts (R3, O7), percentiles (A10)

@register("stream_first_positions", f"""SELECT key, CASE WHEN pos % 2 = 0 THEN pos + 10 ELSE pos END AS pos, 'first' AS kind, NULL AS stored,
  len(tokens) AS n_tokens FROM ({D.MANIFEST}) JOIN ({D.TEXT_ART}) USING (key)
UNION ALL SELECT key, pos, 'earlier', pos + 10, len(tokens) FROM ({D.MANIFEST}) JOIN ({D.TEXT_ART}) USING (key) WHERE pos % 2 = 0""")
def q_stream_first_positions(spark, sf):
    """R3/O7 in state: half of the keys come with a position ten too high first, then all with their own, twice."""
    work = FS.work_dir(spark, "firsts")
    src, store, ckpt = os.path.join(work, "in"), os.path.join(work, "store"), os.path.join(work, "ckpt")
    m = TB.manifest(spark, sf)
    FS.write_jsonl(m.where("pos % 2 = 0").withColumn("pos", F.col("pos") + 10), os.path.join(src, "drop0"))
    firsts.stream_first_positions(spark, os.path.join(src, "*"), store, ckpt)
    FS.write_jsonl(m.unionAll(m), os.path.join(src, "drop1"))
    firsts.stream_first_positions(spark, os.path.join(src, "*"), store, ckpt)
    n = F.size("tokens").alias("n_tokens")
    one = spark.read.parquet(os.path.join(store, "txt")).select("key", "pos", F.lit("first").alias("kind"), F.lit(None).cast("long").alias("stored"), n)
    return one.unionAll(spark.read.parquet(os.path.join(store, "earlier")).select("key", "pos", F.lit("earlier").alias("kind"), "stored", n))


RANK_ERROR = 0.02


@register("throughput_percentiles", """WITH r AS (SELECT l_shipdate AS day FROM lineitem)
SELECT 'month' AS level, strftime(day, '%Y-%m') AS period, count(*) AS n_runs, true AS tokens_per_s_ok, true AS rtf_ok FROM r GROUP BY 1, 2
UNION ALL SELECT 'all', 'all', count(*), true, true FROM r""")
def q_throughput_percentiles(spark, sf):
    """A10: day sketches stored, merged to months and to the whole log; medians and 95th percentiles of both metrics are held against the
    exact ranks of the runs (``_ok``: within 2 % of all ranks)."""
    log = TB.run_log(spark, sf, day=True)
    days = FS.stage(PC.day_sketches(log), "sketches")
    month = F.date_format("day", "yyyy-MM")
    months = FS.stage(PC.merge_sketches(days, month.alias("period")), "months")
    levels = [("month", months, month), ("all", PC.merge_sketches(months, F.lit("all").alias("period")), F.lit("all"))]
    out = None
    for level, sketches, of in levels:
        picks = sketches.select("period", "n_runs", *[PC.percentile(m, p).alias(f"{m}_{i}") for m in PC.METRICS for i, p in enumerate((0.5, 0.95))])
        runs = PC.run_metrics(log).select(of.alias("period"), *PC.METRICS).join(picks, "period")
        checks = []
        for m in PC.METRICS:
            ok = []
            for i, p in enumerate((0.5, 0.95)):
                below = F.avg((F.col(m) < F.col(f"{m}_{i}")).cast("double"))
                upto = F.avg((F.col(m) <= F.col(f"{m}_{i}")).cast("double"))
                ok.append((below <= p + RANK_ERROR) & (upto >= p - RANK_ERROR))
            checks.append((ok[0] & ok[1]).alias(f"{m}_ok"))
        d = runs.groupBy("period", "n_runs").agg(*checks).select(F.lit(level).alias("level"), "period", "n_runs", "tokens_per_s_ok", "rtf_ok")
        out = d if out is None else out.unionAll(d)
    return out


# ---------------------------------------------------------------- each request once

@register("stream_requests_once", f"""SELECT conv_id, turn, CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS request_id,
  CASE WHEN error IS NULL THEN 'ok' ELSE 'err' END AS status, error FROM ({ORACLE["stream_requests"]})
UNION ALL SELECT conv_id, turn, 'late-' || CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR), 'late', '{SR.LATE}'
FROM conversations WHERE turn = 0""")
def q_stream_requests_once(spark, sf):
    """R1/R2 with event times: the first drop comes twice, the second holds every request again and old ones under new ids."""
    work = FS.work_dir(spark, "requests-once")
    src, out, ckpt = os.path.join(work, "in"), os.path.join(work, "out"), os.path.join(work, "ckpt")
    name = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("turn") * 60)
    req = request_payloads(spark, sf).select("conv_id", "turn", "payload", name.alias("request_id"), at.alias("event_time"))
    old = req.where("turn = 0").withColumns({"request_id": F.concat(F.lit("late-"), name), "event_time": at - F.expr("INTERVAL 30 DAYS")})
    for i, drop in enumerate((req.where("turn % 2 = 0"), req.where("turn % 2 = 0"), req.unionAll(old))):
        drop.write.json(os.path.join(src, f"drop{i}"))
        SR.stream_requests_once(spark, os.path.join(src, "*"), out, ckpt, presets(spark))
    return SR.read_once(spark, out)

"""Stream results equal the batch form; files and keys processed once."""

import os

from pyspark.sql import functions as F

from tokenloom.sources.files import read_artifact, write_jsonl
from tokenloom.sources.requests import presets, request_payloads
from tokenloom.sources.tables import manifest, text_token_artifact
from tokenloom.streaming import incremental
from tokenloom.streaming import requests as SR

from conftest import SF001


def test_stream_equals_batch(spark, tmp_path):
    req = request_payloads(spark, SF001)
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    req.filter("turn % 2 = 0").write.json(os.path.join(src, "a"))
    SR.stream_prepare_requests(spark, os.path.join(src, "*"), out, ckpt, presets(spark))
    n_first = SR.read_outputs(spark, out, "ok").count() + SR.read_outputs(spark, out, "err").count()
    req.filter("turn % 2 = 1").write.json(os.path.join(src, "b"))
    SR.stream_prepare_requests(spark, os.path.join(src, "*"), out, ckpt, presets(spark))
    # a third run with no new files changes nothing
    SR.stream_prepare_requests(spark, os.path.join(src, "*"), out, ckpt, presets(spark))
    streamed = SR.read_outputs(spark, out, "ok").unionByName(SR.read_outputs(spark, out, "err")).drop("batch")
    batch = SR.prepare_requests(req, presets(spark))
    assert 0 < n_first < streamed.count() == req.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0
    assert batch.select(*streamed.columns).exceptAll(streamed).count() == 0
    errs = SR.read_outputs(spark, out, "err")
    assert errs.filter(F.col("error").isNull()).count() == 0 and errs.count() > 0


def test_incremental_tokens_once_per_key(spark, tmp_path):
    m = manifest(spark, SF001)
    src, store, ckpt = str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "ck")
    write_jsonl(m.filter("pos < 50"), os.path.join(src, "a"))
    incremental.stream_text_tokens(spark, os.path.join(src, "*"), store, ckpt)
    assert read_artifact(spark, store, "txt").count() == 50
    write_jsonl(m, os.path.join(src, "b"))
    incremental.stream_text_tokens(spark, os.path.join(src, "*"), store, ckpt)
    got = read_artifact(spark, store, "txt")
    assert got.count() == m.count() == got.select("key").distinct().count()
    assert got.exceptAll(text_token_artifact(spark, SF001)).count() == 0


def test_incremental_tokens_state_dedupe(spark, tmp_path):
    m = manifest(spark, SF001)
    src, store, ckpt = str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "ck")
    write_jsonl(m.filter("pos < 80"), os.path.join(src, "a"))
    incremental.stream_text_tokens(spark, os.path.join(src, "*"), store, ckpt, dedupe="state")
    write_jsonl(m, os.path.join(src, "b"))
    incremental.stream_text_tokens(spark, os.path.join(src, "*"), store, ckpt, dedupe="state")
    got = read_artifact(spark, store, "txt")
    assert got.count() == m.count() == got.select("key").distinct().count()
    assert got.exceptAll(text_token_artifact(spark, SF001)).count() == 0


def test_dead_letter_batch_replay_is_idempotent(spark, tmp_path):
    req = request_payloads(spark, SF001)
    batch = SR.prepare_requests(req, presets(spark))
    out = str(tmp_path / "out")
    SR.split_dead_letters(batch, 3, out)
    SR.split_dead_letters(batch, 3, out)  # the same micro-batch replayed after a failure
    ok, err = SR.read_outputs(spark, out, "ok"), SR.read_outputs(spark, out, "err")
    assert ok.count() + err.count() == batch.count()
    assert err.filter(F.col("error").isNull()).count() == 0 and ok.filter(F.col("error").isNotNull()).count() == 0


def test_each_request_once(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    row = lambda i, minute, rid=0, payload='{"text": "hi"}': (i, 0, payload, f"r{i}" if rid == 0 else rid, f"2024-01-01 00:{minute:02d}:00")
    drops = [[row(1, 0), row(2, 50), row(2, 50), row(3, 55, payload="broken")], [row(1, 0), row(2, 50), row(4, 45)],
             [row(5, 5), row(6, 58), row(1, 0), row(7, 50, None)], [row(5, 5), row(8, 59)]]
    for i, rows in enumerate(drops):
        d = spark.createDataFrame(rows, "conv_id long, turn long, payload string, request_id string, event_time string")
        d.write.json(os.path.join(src, f"d{i}"))
        SR.stream_requests_once(spark, os.path.join(src, "*"), out, ckpt, presets(spark), delay="20 minutes")
    got = sorted((r["conv_id"], r["status"]) for r in SR.read_once(spark, out).collect())
    # request 5 is behind the watermark (00:35), in both drops; 7 has no id
    assert got == [(1, "ok"), (2, "ok"), (3, "err"), (4, "ok"), (5, "late"), (5, "late"), (6, "ok"), (7, "late"), (8, "ok")]
    reasons = {r["conv_id"]: r["error"] for r in SR.read_once(spark, out).where("status = 'late'").collect()}
    assert reasons == {5: SR.LATE, 7: "no request id"}

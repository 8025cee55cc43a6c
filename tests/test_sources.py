"""S1-S6 with hand-made files written to a temp folder."""

import io
import tarfile
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.sources import archives as AR
from tokenloom.sources import audio as AU
from tokenloom.sources import files as FS


def test_tsv_manifest_quoting_and_na(spark, tmp_path):
    p = tmp_path / "m.tsv"
    p.write_text('a/x.flac\tNA\nb/y.flac.flac\t"q ""z"""\n\nc/z.flac\t12\n', encoding="utf-8")
    got = [tuple(r) for r in FS.read_tsv_manifest(spark, str(p)).collect()]
    assert got == [("a/x", None), ("b/y", 'q "z"'), ("c/z", "12")]


def test_jsonl_roundtrip_keeps_non_ascii_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([("k/1", "héllo\n„x“", 0), ("k/2", None, 1)], FS.MANIFEST_SCHEMA)
    FS.write_jsonl(df, str(tmp_path / "j"))
    raw = "".join(f.read_text(encoding="utf-8") for f in (tmp_path / "j").glob("part-*"))
    assert "héllo" in raw and '"text":null' in raw
    back = FS.read_jsonl(spark, str(tmp_path / "j")).drop("_corrupt_record")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_jsonl_malformed_line_is_kept_aside(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"key": "a", "text": "t", "pos": 0}\nnot json\n', encoding="utf-8")
    df = FS.read_jsonl(spark, str(tmp_path / "bad.json"))
    rows = df.collect()
    assert len(rows) == 2 and sum(r._corrupt_record is not None for r in rows) == 1


def test_artifact_write_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([("a", [1]), ("b", [2])], "key string, tokens array<int>")
    FS.write_artifact(df, str(tmp_path), "txt")
    more = spark.createDataFrame([("b", [9]), ("c", [3])], "key string, tokens array<int>")
    FS.write_artifact(more, str(tmp_path), "txt")
    got = {r.key: r.tokens for r in FS.read_artifact(spark, str(tmp_path), "txt").collect()}
    assert got == {"a": [1], "b": [2], "c": [3]}


def _tar(path, members):
    with tarfile.open(path, "w") as tf:
        for name, data in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tf.addfile(info, io.BytesIO(data))


def test_unpack_archives_and_skip_done(spark, tmp_path):
    _tar(tmp_path / "a1.tar", {"x/1.flac": b"abc", "x/2.flac": b"de"})
    _tar(tmp_path / "a2.tar", {"y/3.flac": b"f"})
    (tmp_path / "broken.tar").write_bytes(b"not a tar at all" * 10)
    paths = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").load(str(tmp_path)).select("path")
    got = AR.unpack_archives(spark, paths).collect()
    ok = sorted((r.archive, r.member, r.size) for r in got if r.error is None)
    assert ok == [("a1", "x/1.flac", 3), ("a1", "x/2.flac", 2), ("a2", "y/3.flac", 1)]
    assert [r.archive for r in got if r.error is not None] == ["broken"]
    done = spark.createDataFrame([("a1",)], "archive string")
    again = AR.unpack_archives(spark, paths, done=done).filter(F.col("error").isNull()).collect()
    assert sorted(r.member for r in again) == ["y/3.flac"]


def _wav(path, rate, chans, n, truncate=False):
    t = np.arange(n) / rate
    x = np.stack([0.5 * np.sin(2 * np.pi * 220 * (c + 1) * t) for c in range(chans)], axis=1)
    pcm = (x * 32767).astype("<i2").tobytes()
    with wave.open(str(path), "wb") as w:
        w.setnchannels(chans)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(pcm)
    if truncate:
        data = path.read_bytes()
        path.write_bytes(data[:30])


def test_read_audio_mono_stereo_and_errors(spark, tmp_path):
    _wav(tmp_path / "m16.wav", 16000, 1, 1600)
    _wav(tmp_path / "s24.wav", 24000, 2, 2400)
    _wav(tmp_path / "bad.wav", 16000, 1, 100, truncate=True)
    got = {r.path.rsplit("/", 1)[-1]: r for r in AU.read_audio(spark, str(tmp_path)).collect()}
    assert (got["m16.wav"].sample_rate, got["m16.wav"].channels, got["m16.wav"].n_samples) == (16000, 1, 1600)
    assert (got["s24.wav"].sample_rate, got["s24.wav"].channels, got["s24.wav"].n_samples) == (24000, 2, 2400)
    assert len(got["s24.wav"].pcm) == 2 and abs(max(got["s24.wav"].pcm[0]) - 0.5) < 1e-3
    assert got["bad.wav"].error is not None


def test_resample_keeps_channel_zero_or_mean(spark, tmp_path):
    _wav(tmp_path / "s16.wav", 16000, 2, 1600)
    a = AU.read_audio(spark, str(tmp_path))
    first = AU.resample_audio(a, 24000, "first").first()
    mean = AU.resample_audio(a, 16000, "mean").first()
    assert len(first.wave) == 2400
    x = np.asarray(mean.wave)
    assert len(x) == 1600 and np.allclose(x, (np.asarray(a.first().pcm[0]) + np.asarray(a.first().pcm[1])) / 2, atol=1e-6)


def test_bucketed_artifacts_join_without_shuffle(spark, tmp_path):
    from tokenloom.operators.joins import assemble_samples
    from tokenloom.sources import tables as TB
    from conftest import SF001

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        FS.write_bucketed_artifact(TB.text_token_artifact(spark, SF001), "t_txt", str(tmp_path / "txt"), 8)
        FS.write_bucketed_artifact(TB.code_artifact(spark, SF001), "t_tok", str(tmp_path / "tok"), 8)
        FS.write_bucketed_artifact(TB.embedding_artifact(spark, SF001), "t_emb", str(tmp_path / "emb"), 8)
        FS.write_bucketed_artifact(TB.manifest(spark, SF001).select("key", "pos"), "t_man", str(tmp_path / "man"), 8)
        joined = assemble_samples(spark.table("t_man"), spark.table("t_txt"), spark.table("t_emb"), spark.table("t_tok"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert joined.count() == assemble_samples(TB.manifest(spark, SF001).select("key", "pos"),
                                                  TB.text_token_artifact(spark, SF001),
                                                  TB.embedding_artifact(spark, SF001),
                                                  TB.code_artifact(spark, SF001)).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_file_order_positions_across_files_and_splits(spark, tmp_path):
    import json

    d = tmp_path / "m"
    d.mkdir()
    expected = []
    for f in range(3):
        lines = [json.dumps({"key": f"f{f}/{i}", "text": "x" * (i % 37)}) for i in range(4000)]
        (d / f"part{f}.json").write_text("\n".join(lines) + "\n", encoding="utf-8")
        expected += [f"f{f}/{i}" for i in range(4000)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32768")  # many splits per file
    try:
        df = FS.read_jsonl(spark, str(d), schema="key string, text string", corrupt=False)
        assert df.rdd.getNumPartitions() > 6
        got = FS.with_file_order(df).select("key", "pos").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    by_pos = sorted(got, key=lambda r: r.pos)
    assert [r.pos for r in by_pos] == list(range(len(expected)))
    assert [r.key for r in by_pos] == expected


def test_unique_rows_are_stored_without_an_aggregate(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("a", [1]), ("b", [2])], "key string, tokens array<int>")
    monkeypatch.setattr(type(df), "dropDuplicates", lambda *a: pytest.fail("rows are unique already"))
    FS.write_artifact(df, str(tmp_path), "txt", unique=True)
    FS.write_artifact(df.unionAll(spark.createDataFrame([("c", [3])], df.schema)), str(tmp_path), "txt", unique=True)
    assert sorted((r.key, r.tokens) for r in FS.read_artifact(spark, str(tmp_path), "txt").collect()) == [("a", [1]), ("b", [2]), ("c", [3])]

"""Listing, joining and reading of many files, and of one large file."""

import io
import os

import numpy as np
import pyarrow as pa

from tokenloom.plans import queries_io as Q
from tokenloom.sources import audio as AU
from tokenloom.sources import chunks as CH
from tokenloom.sources import files as FS
from tokenloom.sources import splitscan as S


def _documents(spark, tmp_path, n=60):
    rows = [(i, f'say "{i}"\tto\nall é ' * (1 + i % 5), f"s{i % 3}") for i in range(n)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_list_files_of_nested_folders(spark, tmp_path):
    for name in ("a/1.wav", "a/b/2.wav", "3.wav", "a/x.txt", "_h/4.wav", "a/.5.wav"):
        os.makedirs((tmp_path / name).parent, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * len(name))
    got = {r["path"]: r["length"] for r in FS.list_files(spark, str(tmp_path), "*.wav").collect()}
    assert got == {f"file:{tmp_path}/{n}": len(n) for n in ("a/1.wav", "a/b/2.wav", "3.wav")}
    assert FS.list_files(spark, str(tmp_path / "a"), "*.flac").count() == 0


def test_one_large_tsv_is_written_in_parts(spark, tmp_path):
    """the rows of the one file are made in as many tasks as read the table."""
    sf, jobs = _documents(spark, tmp_path), []
    write = FS.write_tsv_manifest
    FS.write_tsv_manifest = lambda rows, path: (jobs.append(rows.rdd.getNumPartitions()), write(rows, path))
    try:
        path = Q._tsv_files(spark, sf, one=True)
    finally:
        FS.write_tsv_manifest = write
    assert jobs[0] > 1
    assert len([f for f in os.listdir(path) if f[0] not in "_."]) == 1
    want = FS.read_tsv_manifest(spark, Q._tsv_files(spark, sf))
    got = S.read_tsv_splits(spark, path, 100)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr) and got.count() == 60


def test_small_splits_share_tasks_and_read_little(spark):
    """a task per 64 KB, and 4 MB read for each, took most of the time."""
    splits = spark.range(5000).selectExpr("'x' AS path", "cast(id as int) AS split", "id * 65536 AS start", "(id + 1) * 65536 AS stop")
    assert S._spread_splits(splits).rdd.getNumPartitions() <= 64

    class File(io.BytesIO):
        total = 0

        def read(self, n=-1):
            data = super().read(n)
            File.total += len(data)
            return data

    lines = S._Lines(File(b"ab\n" * 3_000_000), 3, 1 << 16)
    assert [next(lines) for _ in range(10)] == ["ab\n"] * 10 and lines.at == 33
    assert File.total == 1 << 16
    long = b"q" * 300_000 + b"\nend"
    assert list(S._Lines(io.BytesIO(long), 0, 10)) == ["q" * 300_000 + "\n", "end"]


def test_samples_stay_in_arrow(spark, tmp_path):
    """No sample or frame becomes a Python object."""
    rows = [("a/1", [0.5] * 4000), ("a/2", []), ("b/3", None)]
    df = spark.createDataFrame(rows, "key string, pcm array<float>").selectExpr("key", "pcm", "16000 AS sample_rate")
    AU.write_wavs(df, str(tmp_path)).collect()
    a = AU.read_audio(spark, str(tmp_path)).withColumn("key", AU.key_from_path("path", str(tmp_path)))
    w = AU.resample_audio(a, 16000, "mean", keep=["key"])
    assert w.columns == ["key", "wave"]
    for d in (a, w, AU.trim_audio(w), AU.partial_mels(w), AU.mel_spectrogram(w)):
        assert "MapInPandas" not in d._jdf.queryExecution().executedPlan().toString()
    got = {r["key"]: r for r in AU.trim_audio(w).collect()}
    assert {k: len(r["wave"]) for k, r in got.items()} == {"a/1": 4000, "a/2": 0, "b/3": 0}
    assert [(r["key"], len(r["mels"])) for r in AU.partial_mels(w).orderBy("key").collect()] == [("a/1", 160), ("a/2", 160), ("b/3", 160)]


def test_padding_is_not_transformed(monkeypatch):
    """frames behind the last sample hold no power; only the others go through the transform."""
    seen, rfft = [], np.fft.rfft
    monkeypatch.setattr(np.fft, "rfft", lambda x, **k: (seen.append(len(x)), rfft(x, **k))[1])
    x = np.random.default_rng(0).normal(size=2000).astype(np.float32)
    whole, alone = AU.mel_frames(np.pad(x, (0, 23_600))), AU.mel_frames(np.pad(x, (0, 400)))
    assert whole.shape == (161, 40) and seen[0] < 16
    assert np.allclose(whole[:15], alone[:15], rtol=1e-6) and not whole[15:].any()


def test_chunks_leave_a_worker_together():
    """Every chunk was an Arrow batch of its own."""
    class Rows:
        def mapInArrow(self, go, kind):
            return go

    go = CH._per_chunk(Rows(), lambda r: (pa.array([r["key"]]), pa.array([2 * r["n"]], pa.int64())), "key n", "key string, n long")
    b = pa.RecordBatch.from_pydict({"key": ["a", None, "c"] * 1000, "n": range(3000)})
    out = list(go(iter([b, b])))
    assert len(out) == 1 and out[0].num_rows == 6000 and out[0].column(0).to_pylist()[:3] == ["a", None, "c"]
    assert out[0].column(1).to_pylist()[3000:3003] == [0, 2, 4]
